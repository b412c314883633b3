"""Time expressions: epoch microseconds, zone conversion, local calendar dates.

Every time value has one canonical instant, whatever its type: zone-less
timestamps (``timestamp_ntz``) and time texts without an offset are UTC wall
clock, an offset in a text is honoured, a date is its midnight in UTC. All
arithmetic is on integer microseconds or on dates, never on the session zone,
so results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

_EPOCH_NTZ = "1970-01-01 00:00:00"
# The ISO-8601 form a time text must have to be one (a date, and
# a time of day behind "T" or a blank); a zone or offset behind the time of
# day; the widest offset from UTC that a text can name.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d.*)?$"
ZONED_TIME = r"^.{10}[T ].*[A-Za-z+-]"
WIDEST_OFFSET = timedelta(hours=18)


def _epoch() -> Column:
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz")


def as_utc_ntz(col: Column, dtype: DataType) -> Column:
    """The instant of ``col`` as UTC wall clock (``timestamp_ntz``)."""
    if isinstance(dtype, TimestampNTZType):
        return col
    if isinstance(dtype, TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(col), _epoch())
    if isinstance(dtype, DateType):
        return col.cast("timestamp_ntz")
    if not isinstance(dtype, StringType):
        raise ValueError(f"a {dtype.simpleString()} column holds no times")
    # A text with an offset is an instant in any session; one without is wall
    # clock, which a zone-less timestamp keeps as it is.
    zoned = as_utc_ntz(col.try_cast("timestamp"), TimestampType())
    return F.when(col.rlike(ISO_TIME), F.when(col.rlike(ZONED_TIME), zoned).otherwise(col.try_cast("timestamp_ntz")))


def epoch_micros(col: Column, dtype: DataType) -> Column:
    """Microseconds since 1970-01-01 UTC, as ``bigint``."""
    if isinstance(dtype, TimestampType):
        return F.unix_micros(col)
    t = as_utc_ntz(col, dtype)
    # By calendar day and time of day: differences of timestamps go through the session zone.
    seconds = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400 + F.hour(t) * 3_600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")


def micros_to_ntz(us: Column) -> Column:
    """Inverse of :func:`epoch_micros`, as UTC wall clock."""
    return F.timestamp_add("MICROSECOND", us, _epoch())


def local_wall_clock(col: Column, dtype: DataType, zone: str) -> Column:
    """Wall clock of the instant in ``zone`` (``timestamp_ntz``)."""
    if zone in ("UTC", "Etc/UTC", "Z"):
        return as_utc_ntz(col, dtype)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_utc_ntz(col, dtype))


def local_date(col: Column, dtype: DataType, zone: str) -> Column:
    """Calendar date of the instant in ``zone`` (X3 + X4)."""
    return F.to_date(local_wall_clock(col, dtype, zone))


def instant_literal(value: datetime, dtype: DataType) -> Column:
    """A bound as a literal of the column's own type, so Parquet gets it pushed.

    ``value`` must be timezone-aware; for a ``timestamp_ntz`` column it is
    turned into UTC wall clock.
    """
    utc = value.astimezone(timezone.utc)
    if isinstance(dtype, TimestampType):
        return F.lit(utc)
    naive = utc.replace(tzinfo=None)
    return F.lit(naive.isoformat(sep=" ")).cast("timestamp_ntz")


def order_key(col: Column, dtype: DataType) -> Column:
    """What a time column is ordered by: itself, or for texts their instant."""
    return as_utc_ntz(col, dtype) if isinstance(dtype, StringType) else col


def between_instants(col: Column, dtype: DataType, start: datetime | None, end: datetime | None) -> Column:
    """``start <= t <= end`` on instants, with rows without a time left out.

    Timestamps and dates are compared with literals of their own type. Texts are
    cut in two steps: plain text bounds, wide enough for any offset, that the
    scan can use, then the exact instants.
    """
    if isinstance(dtype, DateType):
        lo = None if start is None else _utc(start)
        first = None if lo is None else lo.date() + timedelta(days=int(lo.time() != datetime.min.time()))
        cond = col.isNotNull()
        cond = cond if first is None else cond & (col >= F.lit(first))
        return cond if end is None else cond & (col <= F.lit(_utc(end).date()))
    cond, t = col.isNotNull(), col
    if isinstance(dtype, StringType):
        for bound, step in ((start, -WIDEST_OFFSET), (end, WIDEST_OFFSET + timedelta(days=1))):
            try:
                day = None if bound is None else (_utc(bound) + step).date().isoformat()
            except OverflowError:  # at the ends of the calendar the exact step alone decides
                continue
            if day is not None:
                cond = cond & (col >= F.lit(day) if bound is start else col < F.lit(day))
        t, dtype = as_utc_ntz(col, dtype), TimestampNTZType()
        cond = cond & t.isNotNull()
    if start is not None:
        cond = cond & (t >= instant_literal(start, dtype))
    if end is not None:
        cond = cond & (t <= instant_literal(end, dtype))
    return cond


def _utc(value: datetime) -> datetime:
    return value.astimezone(timezone.utc).replace(tzinfo=None)
