"""Union of parts and deduplication."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

from ..functions.timefn import epoch_micros, micros_to_ntz
from .project import qcol
from .types import comparable, has_map, unite


def union_parts(*frames: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept; missing columns become NULL, types that differ their common type."""
    if not frames:
        raise ValueError("no frame to union")
    return unite(list(frames))


def dedup_by_id(df: DataFrame, columns, id_col: str = "_id") -> DataFrame:
    """One row per equal (``_id``, columns...) (U2); NULLs equal each other.

    The frame is projected to exactly those columns first, so every column is
    a grouping key and Spark plans a partial + final HashAggregate. A column
    that holds maps is grouped by its entries in order and kept as it is.
    """
    cols = [id_col] + [c for c in columns if c != id_col]
    rows = df.select([qcol(c) for c in cols])
    mapped = [c for c in cols if has_map(df.schema[c].dataType)]
    if not mapped:
        return rows.dropDuplicates()
    forms = {c: f"__form{i}" for i, c in enumerate(mapped)}
    rows = rows.withColumns({forms[c]: comparable(qcol(c), df.schema[c].dataType) for c in mapped})
    return rows.dropDuplicates([forms.get(c, c) for c in cols]).drop(*forms.values())


# Bits that hold every value of a type and, as 0, NULL. Times are
# held in microseconds within 2^60 of 1970 (the years -34,000 to 38,000).
_CODE_BITS = {BooleanType: 2, ByteType: 9, ShortType: 17, IntegerType: 33, DateType: 33, LongType: 65,
              TimestampType: 62, TimestampNTZType: 62}
#: Bits of a wide decimal.
_WIDE_BITS = 126


def _ordinal(col: Column, dtype: DataType) -> Column:
    """A whole number >= 1 in the order of ``col``, 0 for NULL, as a wide decimal."""
    if isinstance(dtype, BooleanType):
        n = col.cast("int")
    elif isinstance(dtype, DateType):
        n = F.datediff(col, F.lit("1970-01-01").cast("date"))
    elif isinstance(dtype, (TimestampType, TimestampNTZType)):
        us = epoch_micros(col, dtype)
        n = F.when(F.abs(us) < F.lit(1 << 60), us).otherwise(F.when(us.isNotNull(), F.raise_error(F.lit("a time beyond the year 38,000"))).cast("long"))
    else:
        n = col
    shift = 1 << (_CODE_BITS[type(dtype)] - 2)
    return F.coalesce(n.cast("decimal(20,0)") + F.lit(Decimal(shift + 1)), F.lit(Decimal(0))).cast("decimal(38,0)")


def _value(ordinal: Column, dtype: DataType) -> Column:
    """Inverse of :func:`_ordinal`."""
    shift = 1 << (_CODE_BITS[type(dtype)] - 2)
    n = F.when(ordinal > 0, (ordinal - F.lit(Decimal(shift + 1))).cast("long"))
    if isinstance(dtype, BooleanType):
        return n.cast("int").cast("boolean")
    if isinstance(dtype, DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), n.cast("int"))
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(n)
    return micros_to_ntz(n) if isinstance(dtype, TimestampNTZType) else n.cast(dtype)


def _order_code(df: DataFrame, order_cols: list[str]) -> tuple[Column, list[Column]] | None:
    """One fixed-width number in the order of ``order_cols``, and the columns out of ``__w``; None where they don't fit one."""
    types = [df.schema[c].dataType for c in order_cols]
    if not types or any(type(t) not in _CODE_BITS for t in types) or sum(_CODE_BITS[type(t)] for t in types) > _WIDE_BITS + len(types):
        return None
    code, back, rest = None, [], F.col("__w")
    for c, t in zip(order_cols, types):
        part = _ordinal(qcol(c), t)
        code = part if code is None else (code * _power(t) + part).cast("decimal(38,0)")
    for t in reversed(types):
        back.insert(0, _value((rest % _power(t)).cast("decimal(38,0)"), t))
        rest = ((rest - rest % _power(t)) / _power(t)).cast("decimal(38,0)")
    return code, back


def _power(dtype: DataType) -> Column:
    return F.lit(Decimal((1 << (_CODE_BITS[type(dtype)] - 1)) + 2))


def dedup_by_fields(df: DataFrame, fields, order_cols) -> DataFrame:
    """One row per equal ``fields``; the first row by ``order_cols`` wins.

    Written as an aggregation rather than a window: each map task pre-aggregates
    its share of a group, so a group holding a large part of the rows is cut
    down before the shuffle, and no group is ever gathered whole into one task.
    Where the order columns (times, dates, whole numbers) are all that the
    winner adds, they are packed into one wide decimal whose minimum a hash
    aggregate keeps in place; otherwise the winner is the minimum of a struct,
    in a sort aggregate. Columns with maps compare by their entries in order.
    """
    fields = list(fields)
    others = [c for c in df.columns if c not in fields]
    order_cols = [c for c in order_cols if c not in fields]
    rest = [c for c in others if c not in order_cols]
    mapped = [c for c in fields if has_map(df.schema[c].dataType)]
    keys = [comparable(qcol(c), df.schema[c].dataType).alias(f"__key{i}") for i, c in enumerate(fields)]
    kept = [F.first(qcol(c)).alias(f"__map{i}") for i, c in enumerate(mapped)]
    value = {c: F.col(f"__map{mapped.index(c)}") if c in mapped else F.col(f"__key{i}") for i, c in enumerate(fields)}
    packed = _order_code(df, order_cols) if not rest else None
    if not others:
        best = df.groupBy(*keys).agg(*kept) if kept else df.groupBy(*keys).agg(F.lit(0).alias("__w"))
    elif packed is not None:
        code, back = packed
        best = df.groupBy(*keys).agg(F.min(code).alias("__w"), *kept)
        value |= dict(zip(order_cols, back))
    else:
        if any(isinstance(df.schema[c].dataType, StringType) for c in fields):
            # Leading the keys with a hash of the fields makes most comparisons
            # of long texts a comparison of two longs. The fields stay keys, so
            # a hash collision merges nothing.
            plain = [qcol(c) for c in fields if c not in mapped]
            keys = [F.xxhash64(*plain).alias("__h")] + keys
        names = [*order_cols, *rest]
        winner = F.struct(*[qcol(c).alias(f"o{i}") for i, c in enumerate(names)])
        best = df.groupBy(*keys).agg(F.min(winner).alias("__w"), *kept)
        value |= {c: F.col("__w").getField(f"o{i}") for i, c in enumerate(names)}
    return best.select([value[c].alias(c) for c in df.columns])
