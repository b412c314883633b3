"""Writers: delimited text in bounded parts or one file."""

from .csv import part_files, prepare_csv, text_options, write_csv, write_single_csv

__all__ = ["part_files", "prepare_csv", "text_options", "write_csv", "write_single_csv"]
