"""Readers: documents from any Spark source, hit JSON, raw CSV, part files."""

from .readers import hit_schema, lift_hits, read_csv, read_hits_json, read_parts, scan, write_hits_json

__all__ = ["hit_schema", "lift_hits", "read_csv", "read_hits_json", "read_parts", "scan",
           "write_hits_json"]
