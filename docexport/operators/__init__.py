"""DataFrame -> DataFrame operators; lazy, no action inside."""

from .aggregate import add_bucket, aggregate, count_rows, occurrences
from .dedup import dedup_by_fields, dedup_by_id, union_parts
from .order import first_last, sort_by_time, time_bounds, top_n, with_position
from .predicate import select_documents, time_range, where
from .project import falsy_to_null, field_column, rename_columns, resolve_path, select_fields
from .slices import assign_slices, slice_plan, slice_table

__all__ = [
    "add_bucket", "aggregate", "count_rows", "occurrences", "dedup_by_fields", "dedup_by_id",
    "union_parts", "first_last", "sort_by_time", "time_bounds", "top_n", "with_position",
    "select_documents", "time_range", "where", "falsy_to_null", "field_column",
    "rename_columns", "resolve_path", "select_fields", "assign_slices", "slice_plan",
    "slice_table",
]
