"""Job specifications and the driver-side option checks (V1-V4).

Everything here runs on the driver before any Spark job and touches no data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timezone
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

# The metadata fields a hit may carry, the aggregate functions
# a column may take, and the length of a duration unit in seconds
# (a month is 30 days and a year 360 days).
METADATA_FIELDS = ("_index", "_type", "_id", "_score")
AGG_FUNCTIONS = ("sum", "count", "max", "min", "mean")
DURATION_UNITS = {"m": 60, "h": 3600, "d": 86400, "w": 604800,
                  "M": 2592000, "y": 31104000}
SHORT_UNITS = ("m", "h")


def parse_couples(text: str | None) -> dict[str, str]:
    """``"a--b,c--d"`` to ``{"a": "b", "c": "d"}`` (V1).

    A later couple for the same name wins; a piece that is not exactly two
    non-empty names joined by ``--`` is skipped.
    """
    out: dict[str, str] = {}
    if not text:
        return out
    for piece in text.split(","):
        parts = piece.strip().split("--")
        if len(parts) == 2 and parts[0] and parts[1]:
            out[parts[0]] = parts[1]
    return out


def parse_functions(text: str | None) -> dict[str, str]:
    """``"a--sum,b"`` to ``{"a": "sum", "b": "count"}``: a name alone is counted.

    Unlike renames, a malformed couple or an unknown function is an error.
    """
    out: dict[str, str] = {}
    if not text:
        return out
    for piece in text.split(","):
        parts = piece.strip().split("--")
        if len(parts) == 1 and parts[0]:
            out[parts[0]] = "count"
        elif len(parts) == 2 and parts[0] and parts[1].strip().lower() in AGG_FUNCTIONS:
            out[parts[0]] = parts[1].strip().lower()
        else:
            raise ValueError(f"bad aggregation couple {piece!r}: expected field--function")
    return out


def parse_list(text: str | list[str] | tuple[str, ...] | None) -> list[str]:
    if text is None:
        return []
    if isinstance(text, (list, tuple)):
        return [t for t in text if t]
    return [t.strip() for t in text.split(",") if t.strip()]


def parse_duration(text: str, allow_short: bool = False) -> int:
    """Duration text such as ``3d`` or ``4M`` to seconds (V2)."""
    m = re.fullmatch(r"\s*(\d+)\s*([mhdwMy])\s*", text or "")
    if not m:
        raise ValueError(f"not a duration: {text!r} (expected <integer><m|h|d|w|M|y>)")
    amount, unit = int(m.group(1)), m.group(2)
    if unit in SHORT_UNITS and not allow_short:
        raise ValueError(f"duration {text!r}: minutes and hours need allow_short=True")
    if amount <= 0:
        raise ValueError(f"duration {text!r} must be positive")
    return amount * DURATION_UNITS[unit]


def check_step_below_span(span_seconds: float, step_seconds: int) -> None:
    """The load-balance step must be smaller than the whole span (V3)."""
    if step_seconds >= span_seconds:
        raise ValueError(
            f"step of {step_seconds}s is not smaller than the span of {span_seconds}s")


def check_zone(zone: str) -> str:
    try:
        ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError) as e:
        raise ValueError(f"unknown time zone {zone!r}") from e
    return zone


def parse_instant(text: str | datetime, zone: str = "UTC") -> datetime:
    """An ISO-8601 bound to an aware UTC instant.

    Text without an offset is wall clock in ``zone``; an explicit offset wins.
    """
    if isinstance(text, datetime):
        dt = text
    else:
        s = text.strip()
        if s.endswith("Z"):
            s = s[:-1] + "+00:00"
        try:
            dt = datetime.fromisoformat(s)
        except ValueError as e:
            raise ValueError(f"not an ISO-8601 date: {text!r}") from e
    if dt.tzinfo is None:
        dt = dt.replace(tzinfo=ZoneInfo(check_zone(zone)))
    return dt.astimezone(timezone.utc)


@dataclass(frozen=True)
class ExportSpec:
    """What to export: fields, metadata, range, predicate, output shape."""

    fields: tuple[str, ...]
    metadata: tuple[str, ...] = ()
    time_field: str | None = None
    start: str | datetime | None = None
    end: str | datetime | None = None
    zone: str = "UTC"
    predicate: object = None  # SQL text or Column, ANDed with the range
    dedup: str = "id"  # "id": on _id and all fields; "fields": on fields only
    rename: dict[str, str] = field(default_factory=dict)
    rounding: int | None = 2
    sep: str = ","
    decimal: str = "."
    max_rows_per_file: int | None = 10_000_000  # rows per part file at most
    single_file: bool = False
    keep_parts: bool = False
    overwrite: bool = False
    falsy: str = "keep"  # "keep" or "null" (flattening drops falsy leaves)
    order: bool = True
    slices: "SliceSpec | None" = None  # write one folder of parts per time slice
    bool_text: tuple[str, str] | None = None  # e.g. ("True", "False"); default true/false

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(parse_list(self.fields)))
        object.__setattr__(self, "metadata", tuple(parse_list(self.metadata)))
        if isinstance(self.rename, str):
            object.__setattr__(self, "rename", parse_couples(self.rename))
        if not self.fields:
            raise ValueError("no field to export")
        unknown = [m for m in self.metadata if m not in METADATA_FIELDS]
        if unknown:
            raise ValueError(f"unknown metadata field(s) {unknown}; allowed: {METADATA_FIELDS}")
        check_zone(self.zone)
        if (self.start is not None or self.end is not None) and not self.time_field:
            raise ValueError("start/end dates need a time_field")
        lo, hi = self.bounds()
        if lo is not None and hi is not None and not hi > lo:
            raise ValueError("end date must be after start date")
        if self.dedup not in ("id", "fields"):
            raise ValueError("dedup must be 'id' or 'fields'")
        if self.falsy not in ("keep", "null"):
            raise ValueError("falsy must be 'keep' or 'null'")
        if self.max_rows_per_file is not None and self.max_rows_per_file <= 0:
            raise ValueError("max_rows_per_file must be positive")
        if self.rounding is not None and self.rounding < 0:
            raise ValueError("rounding must be >= 0")
        if self.slices is not None and (not self.time_field or self.single_file):
            raise ValueError("slices need a time_field and part files (not single_file)")

    def bounds(self) -> tuple[datetime | None, datetime | None]:
        lo = parse_instant(self.start, self.zone) if self.start is not None else None
        hi = parse_instant(self.end, self.zone) if self.end is not None else None
        return lo, hi

    @property
    def columns(self) -> tuple[str, ...]:
        """Output columns: metadata first, then fields, each name once."""
        seen: list[str] = []
        for c in (*self.metadata, *self.fields):
            if c not in seen:
                seen.append(c)
        return tuple(seen)


@dataclass(frozen=True)
class AggSpec:
    """Group-by over keys and/or an n-day calendar bucket."""

    keys: tuple[str, ...] = ()
    functions: dict[str, str] = field(default_factory=dict)  # column -> function
    names: dict[str, str] = field(default_factory=dict)  # column -> output name
    bool_columns: tuple[str, ...] = ()
    time_field: str | None = None
    days: int = 1
    zone: str = "UTC"
    rounding: int | None = 2
    name_prefix: str = "agg"
    keep_null_keys: bool = False

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(parse_list(self.keys)))
        object.__setattr__(self, "bool_columns", tuple(parse_list(self.bool_columns)))
        if isinstance(self.functions, str):
            object.__setattr__(self, "functions", parse_functions(self.functions))
        if isinstance(self.names, str):
            object.__setattr__(self, "names", parse_couples(self.names))
        bad = {c: f for c, f in self.functions.items() if f not in AGG_FUNCTIONS}
        if bad:
            raise ValueError(f"unknown aggregate function(s) {bad}; allowed: {AGG_FUNCTIONS}")
        if not self.keys and not self.time_field:
            raise ValueError("aggregation needs keys or a time_field")
        if self.days < 1:
            raise ValueError("days must be >= 1")
        check_zone(self.zone)


@dataclass(frozen=True)
class SliceSpec:
    """Cut a time range into n slices, by equal width or by load."""

    n: int
    step: str | None = None  # duration text; None = equal width
    allow_short: bool = False

    def __post_init__(self):
        if self.n < 1:
            raise ValueError("n must be >= 1")
        if self.step is not None:
            parse_duration(self.step, self.allow_short)

    @property
    def step_seconds(self) -> int | None:
        return None if self.step is None else parse_duration(self.step, self.allow_short)
