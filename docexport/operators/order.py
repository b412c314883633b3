"""Ordering: sorted export, first/last document, top-n, visible positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timefn import order_key
from .project import qcol


def _time_key(df: DataFrame, time_field: str):
    return order_key(qcol(time_field), df.schema[time_field].dataType)


def sort_by_time(df: DataFrame, time_field: str, id_col: str = "_id") -> DataFrame:
    """Ascending by time, nulls last, ``_id`` as tie-break (T1); time texts by their instants.

    A global sort range-partitions the rows, so part files written in
    partition order are in time order.
    """
    keys = [F.asc_nulls_last(_time_key(df, time_field))]
    if id_col in df.columns and id_col != time_field:
        keys.append(F.asc_nulls_last(qcol(id_col)))
    return df.orderBy(*keys)


def time_bounds(df: DataFrame, time_field: str) -> DataFrame:
    """One row: first and last time and the count of rows with a time.

    Of time texts the earliest and the latest instant are taken, as UTC wall clock.
    """
    t = _time_key(df, time_field)
    return df.agg(F.min(t).alias("first_time"), F.max(t).alias("last_time"),
                  F.count(t).alias("n_docs"))


def first_last(df: DataFrame, time_field: str, id_col: str = "_id") -> DataFrame:
    """One row: the ids of the first and the last document in time.

    Ties on time are broken by the smaller id for the first and the larger
    id for the last document; a single aggregation pass, no sort.
    """
    t, i = _time_key(df, time_field), qcol(id_col)
    rows = df.filter(t.isNotNull())
    return rows.agg(
        F.min_by(i, F.struct(t, i)).alias("first_id"),
        F.max_by(i, F.struct(t, i)).alias("last_id"),
        F.min(t).alias("first_time"),
        F.max(t).alias("last_time"))


def top_n(df: DataFrame, order_cols, n: int, descending: bool = False) -> DataFrame:
    """The first ``n`` rows by ``order_cols`` (T3); planned as TakeOrderedAndProject."""
    if n < 0:
        raise ValueError("n must be >= 0")
    keys = [(F.desc_nulls_last(qcol(c)) if descending else F.asc_nulls_last(qcol(c)))
            for c in order_cols]
    return df.orderBy(*keys).limit(n)


def with_position(df: DataFrame, order_cols, name: str = "rn") -> DataFrame:
    """Add the 1-based position of each row in the global order (T1 made visible).

    Distributed: a range-partitioned sort, the id of each row within its
    sorted partition, a checkpoint that fixes the layout (and cuts lineage),
    per-partition counts (one row per partition), and running offsets over
    those counts, broadcast back. No single-partition window over the rows.
    """
    keys = [F.asc_nulls_last(qcol(c)) for c in order_cols]
    sorted_df = (df.orderBy(*keys)
                 .withColumn("__pid", F.spark_partition_id())
                 .withColumn("__mid", F.monotonically_increasing_id()))
    fixed = sorted_df.checkpoint(eager=True)
    counts = fixed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per partition: the table is bounded by the partition count.
    offsets = counts.select(
        "__pid",
        (F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    offsets = offsets.select("__pid", F.coalesce("__off", F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (fixed.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + local + F.lit(1))
            .drop("__pid", "__mid", "__off"))
