"""Aggregation: group-by with one function per column and n-day calendar buckets (A1-A10).

Plan shape: ``prune -> booleans to 0/1 -> round -> bucket -> drop null keys ->
groupBy.agg (partial + final hash aggregate, one exchange) -> round -> sort``.
The bucket origin is a one-row aggregate read as a scalar subquery; the dense
calendar (bucket as the only key) is generated from that row, so its size is
bounded by the time span divided by the bucket width, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, FloatType,
                               IntegralType, LongType, NumericType, StringType)

from ..functions.fmt import round_half_even
from ..functions.timefn import local_date
from ..spec import AggSpec
from .project import qcol

BUCKET_ORIGIN = "__d0"
#: Buckets of a dense calendar that one task makes.
CALENDAR_CHUNK = 10_000


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    """Count of the rows that match (A1), as one row."""
    return df.agg(F.count(F.lit(1)).alias(name))


@dataclass(frozen=True)
class ResolvedAgg:
    keys: list[str]  # in the data's column order (A3d)
    functions: dict[str, str]  # in the order given
    names: dict[str, str]
    bool_columns: list[str]
    time_field: str | None


def resolve(df: DataFrame, spec: AggSpec) -> ResolvedAgg:
    """Drop names that are not columns of the data (A9) and fill defaults.

    With no function given, the last key given is counted; a name given for
    a column without a function names nothing.
    """
    cols = df.columns
    functions = dict(spec.functions)
    if not functions and spec.keys:
        functions = {spec.keys[-1]: "count"}
    functions = {c: f for c, f in functions.items() if c in cols}
    names = {c: spec.names.get(c, f"{spec.name_prefix}__{c}__{f}") for c, f in functions.items()}
    time_field = spec.time_field if spec.time_field in cols else None
    keys = [c for c in cols if c in spec.keys and c != time_field]
    bools = [c for c in spec.bool_columns if c in cols]
    if not keys and time_field is None:
        raise ValueError("no grouping key is a column of the data")
    if not functions:
        raise ValueError("no aggregated column is a column of the data")
    return ResolvedAgg(keys, functions, names, bools, time_field)


def occurrences(col: Column, dtype: DataType) -> Column:
    """1 where the value is true, else 0; NULL counts as 0."""
    if isinstance(dtype, BooleanType):
        cond = col
    elif isinstance(dtype, NumericType):
        cond = col == F.lit(1)
    elif isinstance(dtype, StringType):
        cond = F.lower(col) == F.lit("true")
    else:
        raise ValueError(f"cannot count boolean occurrences of a {dtype.simpleString()} column")
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long")


def _exact_scaled(dtype: DataType, rounding: int | None) -> bool:
    return isinstance(dtype, (DoubleType, FloatType)) and rounding is not None


#: Values of a low limb of a sum; scaled values below 2 ** 53 are exact in a double.
LIMB = 1 << 24
EXACT = float(1 << 53)
#: From here on a double has no digits that a wide decimal could add.
HUGE = 1e24


def _agg_exprs(fn: str, col: Column, dtype: DataType, rounding: int | None) -> list[Column]:
    """Spark aggregate expressions for one function; see ``_finish``."""
    if fn == "count":
        return [F.count(col)]
    if fn in ("min", "max"):
        return [F.min(col) if fn == "min" else F.max(col)]
    if not isinstance(dtype, NumericType):
        raise ValueError(f"{fn} needs a numeric column, got {dtype.simpleString()}")
    if _exact_scaled(dtype, rounding):
        # Values already have ``rounding`` decimals. They are summed as whole
        # multiples of 10^-rounding in three limbs, each a sum of longs: exact,
        # independent of the partitioning, without a wide decimal in the
        # aggregate buffer, and with room for 2^39 rows. Multiples beyond the
        # whole numbers of a double are cut into limbs as decimals, value by
        # value; where a double has no such digits left, it is summed as it is.
        scale = F.lit(float(10 ** rounding))
        size = F.abs(col)
        small = F.rint(col * scale).cast("long")
        wide = (col.cast(f"decimal(38,{rounding})") * F.lit(Decimal(10) ** rounding)).cast("decimal(38,0)")
        fits, huge = size * scale < F.lit(EXACT), size * scale >= F.lit(HUGE)
        high = (F.when(fits, F.call_function("div", small, F.lit(LIMB)))
                .when(~huge, F.call_function("div", wide, F.lit(LIMB).cast("decimal(38,0)"))))
        low = F.when(fits, small % F.lit(LIMB)).when(~huge, (wide % F.lit(LIMB).cast("decimal(38,0)")).cast("long"))
        return [F.sum(F.call_function("div", high, F.lit(LIMB))), F.sum(high % F.lit(LIMB)), F.sum(low),
                F.sum(F.when(huge, col.cast("double"))), F.count(col)]
    return [F.sum(col), F.count(col)]


def _finish(fn: str, parts: list[Column], dtype: DataType, rounding: int | None) -> Column:
    if fn == "count":
        return F.coalesce(parts[0], F.lit(0).cast("long"))
    if fn in ("min", "max"):
        return parts[0]
    if _exact_scaled(dtype, rounding):
        huge, n = parts[3:]
        top, mid, low = (F.coalesce(p, F.lit(0).cast("long")).cast("decimal(20,0)") for p in parts[:3])
        whole = ((top * F.lit(LIMB) + mid) * F.lit(LIMB) + low).cast("double") / F.lit(float(10 ** rounding))
        value = F.when(n > 0, whole + F.coalesce(huge, F.lit(0.0)))
    else:
        total, n = parts
        value = total if isinstance(dtype, IntegralType) else total.cast("double")
    if fn == "sum":
        zero = F.lit(0).cast("long") if isinstance(dtype, IntegralType) else F.lit(0.0)
        return F.coalesce(value, zero)
    # mean: NULL for a group without values
    return F.when(n > 0, value.cast("double") / n.cast("double"))


def _n_parts(fn: str, dtype: DataType, rounding: int | None) -> int:
    if fn in ("count", "min", "max"):
        return 1
    return 5 if _exact_scaled(dtype, rounding) else 2


def _is_double_result(fn: str, dtype: DataType) -> bool:
    if fn == "mean":
        return True
    if fn == "sum":
        return not isinstance(dtype, IntegralType)
    return fn in ("min", "max") and isinstance(dtype, (DoubleType, FloatType))


def date_bounds(df: DataFrame, time_field: str, zone: str) -> DataFrame:
    """One row: the first and last local dates over all rows (``__d0``, ``__d1``)."""
    d = local_date(qcol(time_field), df.schema[time_field].dataType, zone)
    return df.agg(F.min(d).alias(BUCKET_ORIGIN), F.max(d).alias("__d1"))


def add_bucket(df: DataFrame, time_field: str, days: int, zone: str,
               name: str | None = None, bounds: DataFrame | None = None,
               dtype: DataType | None = None) -> DataFrame:
    """Add the first local date of the ``days``-day bucket holding each row (A4).

    The grid starts at the local date of the earliest row (over all rows).
    Calendar arithmetic on dates keeps buckets aligned to local midnight
    across clock changes. The origin is a scalar subquery over one small
    aggregate, so no join is needed to attach it.
    """
    name = name or time_field
    dtype = dtype or df.schema[time_field].dataType
    d = local_date(qcol(time_field), dtype, zone)
    if days == 1:
        return df.withColumn(name, d)
    if bounds is None:
        bounds = date_bounds(df, time_field, zone)
    # One value, computed once; the whole bounds row is read so the same
    # aggregate serves the dense calendar and can be reused.
    packed = bounds.select(F.struct(*bounds.columns).alias("b")).scalar()
    origin = F.col("__b").getField(BUCKET_ORIGIN)
    idx = F.floor(F.datediff(d, origin) / F.lit(days)).cast("int")
    return (df.withColumn("__b", packed)
            .withColumn(name, F.date_add(origin, idx * F.lit(days))).drop("__b"))


def aggregate(df: DataFrame, spec: AggSpec, sort: bool = True, pre_round: bool = True) -> DataFrame:
    """Group-by with one function per column, optionally by n-day bucket (A3-A10).

    Output: the bucket (named after the time field, a date), the keys in the
    data's column order, then one column per function in the order given.
    Rows with a NULL key are dropped. With the bucket as the only key every
    bucket from first to last appears (count and sum 0 when empty).
    """
    r = resolve(df, spec)
    schema = {f.name: f.dataType for f in df.schema.fields}
    used = list(dict.fromkeys([*r.keys, *r.functions, *r.bool_columns]
                              + ([r.time_field] if r.time_field else [])))
    rounding = spec.rounding if pre_round else None
    # One projection: pruning (P5), booleans to 0/1 (A7), rounding (A10).
    cols, types = [], {}
    for c in used:
        dt = schema[c]
        if c in r.bool_columns:
            col, dt = occurrences(qcol(c), dt), LongType()
        elif rounding is not None and isinstance(dt, (DoubleType, FloatType)):
            col, dt = round_half_even(qcol(c).cast("double"), rounding), DoubleType()
        else:
            col = qcol(c)
        if isinstance(dt, (DoubleType, FloatType)):
            col = F.when(~F.isnan(col), col)  # NaN is a missing value
        cols.append(col.alias(c))
        types[c] = dt
    work = df.select(cols)
    group_cols = list(r.keys)
    dense = False
    bounds = None
    if r.time_field is not None:
        dense = not r.keys
        if dense or spec.days > 1:
            # One small aggregate gives both the grid origin and the calendar.
            bounds = date_bounds(work, r.time_field, spec.zone)
        work = add_bucket(work, r.time_field, spec.days, spec.zone, bounds=bounds,
                          dtype=types[r.time_field])
        types[r.time_field] = DateType()
        group_cols = [r.time_field] + group_cols
    if not spec.keep_null_keys and group_cols:
        work = work.filter(reduce(lambda a, b: a & b, [qcol(k).isNotNull() for k in group_cols]))

    exprs: list[Column] = []
    plan: list[tuple[str, str, int, DataType]] = []
    for c, fn in r.functions.items():
        dtype = types[c]
        parts = _agg_exprs(fn, qcol(c), dtype, spec.rounding)
        base = len(exprs)
        for j, p in enumerate(parts):
            exprs.append(p.alias(f"__p{base + j}"))
        plan.append((c, fn, base, dtype))
    grouped = work.groupBy(*[qcol(k) for k in group_cols]).agg(*exprs)

    if dense:
        grouped = _densify(grouped, r.time_field, spec.days, bounds)

    out = [qcol(k) for k in group_cols]
    for c, fn, base, dtype in plan:
        parts = [F.col(f"__p{base + j}") for j in range(_n_parts(fn, dtype, spec.rounding))]
        value = _finish(fn, parts, dtype, spec.rounding)
        if spec.rounding is not None and _is_double_result(fn, dtype):
            value = round_half_even(value.cast("double"), spec.rounding)  # A10: round again
        out.append(value.alias(r.names[c]))
    result = grouped.select(out)
    if sort:
        result = result.orderBy(*[F.asc_nulls_first(qcol(k)) for k in group_cols])
    return result


def _densify(grouped: DataFrame, bucket: str, days: int, bounds: DataFrame) -> DataFrame:
    """Every bucket from the first to the last, empty ones included.

    The calendar is generated from the one-row date bounds, so it holds
    span / width rows whatever the size of the data. Starts of chunks are made
    first and dealt out, then each is spread into its buckets.
    """
    lo = F.col(BUCKET_ORIGIN)
    n = bounds.filter(lo.isNotNull()).select(lo, F.floor(F.datediff(F.col("__d1"), lo) / F.lit(days)).cast("int").alias("__last"))
    chunks = n.select("*", F.explode(F.sequence(F.lit(0), F.col("__last"), F.lit(CALENDAR_CHUNK))).alias("__from"))
    chunks = chunks.repartition("__from")
    until = F.least(F.col("__from") + F.lit(CALENDAR_CHUNK - 1), F.col("__last"))
    calendar = (chunks.select(lo, F.explode(F.sequence(F.col("__from"), until)).alias("__i"))
                .select(F.date_add(lo, F.col("__i") * F.lit(days)).alias(bucket)))
    return calendar.join(grouped, bucket, "left")
