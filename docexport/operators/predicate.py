"""Filters: closed time range in a named zone, open bounds, user predicate.

Bounds are turned into literals of the time column's own type on the
driver, so the comparison reaches the Parquet scan as ``PushedFilters``; for
times kept as text these are wide text bounds, and the instants decide.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.timefn import between_instants
from ..spec import parse_instant
from .project import resolve_path


def time_column(df: DataFrame, time_field: str):
    hit = resolve_path(df.schema, time_field)
    if hit is None:
        raise ValueError(f"time field {time_field!r} is not in the data")
    return hit


def time_range(df: DataFrame, time_field: str,
               start: str | datetime | None = None, end: str | datetime | None = None,
               zone: str = "UTC") -> DataFrame:
    """Rows with ``start <= t <= end`` (both ends closed, F1).

    A missing side is open (F2); rows without a time value always drop out.
    Bound text without an offset is wall clock in ``zone`` (F5). The field may
    be a timestamp, a date (its midnight in UTC) or ISO-8601 text, whose own
    offset counts and which is UTC without one.
    """
    col, dtype = time_column(df, time_field)
    lo, hi = (None if b is None else parse_instant(b, zone) for b in (start, end))
    return df.filter(between_instants(col, dtype, lo, hi))


def where(df: DataFrame, predicate) -> DataFrame:
    """User predicate: SQL text or a Column; ``None`` or ``"*"`` match all."""
    if predicate is None or (isinstance(predicate, str) and predicate.strip() in ("", "*")):
        return df
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(cond)


def select_documents(df: DataFrame, predicate=None, time_field: str | None = None,
                     start=None, end=None, zone: str = "UTC") -> DataFrame:
    """Predicate AND time range, as one filter."""
    df = where(df, predicate)
    if time_field is not None:
        df = time_range(df, time_field, start, end, zone)
    return df
