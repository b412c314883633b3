"""Time slicing: equal-width and load-balanced slices of a time range.

A slice plan is a one-row DataFrame (bounds in epoch microseconds, grid
step, cut points, remainder start) that reaches the rows as a scalar subquery
(computed once, inlined as a value) to label each row with its slice. Equal
widths need the bounds only. Load-balanced cuts are found by a walk over a
written histogram on the step grid: totals of wide blocks of steps first, then
only the blocks that hold a cut, down to single steps. The driver sees at most
``FAN`` totals for a block, whatever the number of steps in the span.

Slice membership: slices are half-open ``[start, end)``, the last one is
closed at the last document, so every row with a time is in exactly one
slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timefn import epoch_micros, micros_to_ntz
from ..session import scratch_table
from ..spec import SliceSpec, check_step_below_span
from .predicate import time_column

_US = 1_000_000
#: Blocks that a block of steps is split into, and blocks fetched by one job at most.
FAN = 1024
AHEAD = 32


def _with_us(df: DataFrame, time_field: str) -> DataFrame:
    col, dtype = time_column(df, time_field)
    return df.withColumn("__us", epoch_micros(col, dtype))


def with_scalars(df: DataFrame, one_row: DataFrame, names=None) -> DataFrame:
    """``df`` plus the columns of a one-row frame, read as one scalar subquery.

    The subquery runs once; its row is one struct column per row of ``df``
    (kept as a column, not re-evaluated per field), then spread out. No join.
    """
    names = list(names or one_row.columns)
    packed = one_row.select(F.struct(*names).alias("s")).scalar()
    cols = df.columns
    return (df.select("*", packed.alias("__one"))
            .select(*[F.col(f"`{c}`") for c in cols],
                    *[F.col("__one").getField(c).alias(c) for c in names]))


def _bounds(rows_us: DataFrame) -> DataFrame:
    return rows_us.agg(F.min("__us").alias("__lo"), F.max("__us").alias("__hi"),
                       F.count("__us").alias("__total"))


class _Histogram:
    """Counts of steps ``k`` of a written histogram, fetched in blocks of blocks."""

    def __init__(self, table: DataFrame, steps: int):
        self.table, self.width = table, FAN
        while self.width < steps:
            self.width *= FAN
        self.known: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def parts(self, width: int, starts: list[int]) -> list[tuple[int, int]]:
        """(start, count) of the non-empty parts of the first of the blocks; the others are fetched with it."""
        if (width, starts[0]) not in self.known:
            wanted = [s for s in starts if (width, s) not in self.known]
            k, part = F.col("k"), width // FAN
            cond = reduce(lambda a, b: a | b, [k.between(s, s + width - 1) for s in wanted])
            rows = (self.table.filter(cond).groupBy(F.expr(f"k div {part}").alias("p"))
                    .agg(F.sum("c").alias("c")).orderBy("p").collect())
            self.known.update({(width, s): [] for s in wanted})
            for r in rows:
                start = r["p"] * part
                self.known[(width, start // width * width)].append((start, r["c"]))
        return self.known.pop((width, starts[0]))


def load_cuts(table: DataFrame, n: int, total: int, steps: int, last: int) -> list[int]:
    """Steps at which slices end: after a step with which the slice holds at least ``total / n`` rows.

    ``table`` holds ``k, c``: the rows of every non-empty step. There are at
    most ``n - 1`` cuts, none after step ``last``. A block that can't fill the
    slice is added whole; only one that can is opened, and with it those that
    the next cuts will probably need.
    """
    hist = _Histogram(table, steps)
    cuts: list[int] = []
    held = 0

    def probable(parts, i, have):
        found = []
        for start, c in parts[i:]:
            have += c
            if n * have >= total:
                found.append(start)
                have = max(0, have - total // n)
                if len(found) == AHEAD:
                    break
        return found

    def walk(width, starts):
        nonlocal held
        parts = hist.parts(width, starts)
        for i, (start, c) in enumerate(parts):
            if len(cuts) == n - 1:
                return
            if n * (held + c) < total:
                held += c
            elif width > FAN:
                walk(width // FAN, probable(parts, i, held))
            elif start + 1 <= last:
                cuts.append(start + 1)
                held = 0
            else:
                held += c

    if n > 1 and total:
        walk(hist.width, [0])
    return cuts


def _plan_row(df: DataFrame, lo, hi, total, n, cuts, step_us, r0) -> DataFrame:
    def num(v):
        return F.lit(v).cast("bigint")
    return df.sparkSession.range(1).select(
        num(lo).alias("__lo"), num(hi).alias("__hi"), num(total).alias("__total"), F.lit(n).alias("__n"),
        F.array(*map(F.lit, cuts)).cast("array<bigint>").alias("__cuts"), num(step_us).alias("__step"),
        num(r0).alias("__r0"), F.lit(len(cuts)).alias("__m"))


def slice_plan(df: DataFrame, time_field: str, spec: SliceSpec) -> DataFrame:
    """One row describing the slices of ``df`` over ``time_field``.

    Columns: ``__lo``, ``__hi`` (first and last document, epoch micros),
    ``__n``, ``__cuts`` (grid indices of the cuts), ``__step`` (micros),
    ``__r0`` (start of the equal-width remainder), ``__m`` (number of cuts).
    With a step the cuts are found here, by jobs over the time column.
    """
    n = spec.n
    rows = _with_us(df, time_field).select("__us").filter(F.col("__us").isNotNull())
    bounds = _bounds(rows)
    if spec.step is None:
        return bounds.select(
            "__lo", "__hi", "__total", F.lit(n).alias("__n"),
            F.array().cast("array<bigint>").alias("__cuts"),
            F.lit(None).cast("bigint").alias("__step"),
            F.col("__lo").alias("__r0"), F.lit(0).alias("__m"))

    step_us = spec.step_seconds * _US
    lo, hi, total = bounds.first()
    if lo is None or hi == lo:
        return _plan_row(df, lo, hi, total, n, [], step_us, lo)
    check_step_below_span((hi - lo) / _US, spec.step_seconds)
    hist = (rows.groupBy(F.expr(f"(__us - ({lo})) div {step_us}").alias("k"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("__us").alias("mn")))
    with scratch_table(hist.repartitionByRange("k").sortWithinPartitions("k"), "slice-histogram") as steps:
        cuts = load_cuts(steps, n, total, (hi - lo) // step_us + 1, (hi - lo) // step_us)
        # The remainder starts at the first document at or after the last cut.
        r0 = steps.filter(F.col("k") >= cuts[-1]).agg(F.min("mn")).first()[0] if cuts else lo
    return _plan_row(df, lo, hi, total, n, cuts, step_us, r0)


# Slice of a time in micros ``__us``, with the plan columns in scope: before
# the last cut, the number of cuts at or below its grid step; after it, its
# share of the equal-width remainder [__r0, __hi].
SLICE_OF_SQL = """
    CAST(CASE
        WHEN __us IS NULL THEN NULL
        WHEN __m > 0 AND __us < __lo + try_element_at(__cuts, -1) * __step
            THEN size(filter(__cuts, c -> c <= (__us - __lo) div __step))
        WHEN __hi = __r0 THEN __m
        ELSE __m + least(__n - __m - 1, ((__us - __r0) * (__n - __m)) div (__hi - __r0))
    END AS INT)"""


def _slice_of() -> Column:
    return F.expr(SLICE_OF_SQL)


def assign_slices(df: DataFrame, time_field: str, spec: SliceSpec,
                  name: str = "slice_id", plan: DataFrame | None = None) -> DataFrame:
    """Label every row with its slice (I1 without a step, I2 with one).

    ``plan`` (from :func:`slice_plan`) may come from another frame holding
    the same times, e.g. the filtered documents before deduplication.
    """
    plan = plan if plan is not None else slice_plan(df, time_field, spec)
    labelled = with_scalars(_with_us(df, time_field), plan)
    return labelled.withColumn(name, _slice_of()).drop(*plan.columns, "__us")


def slice_table(df: DataFrame, time_field: str, spec: SliceSpec) -> DataFrame:
    """One row per slice: id, start, end and the number of documents (A2).

    ``slice_end`` is exclusive except for the last slice, which ends at the
    last document inclusive. Rows -> count per slice (at most n groups) ->
    one row of counts, beside the plan -> one row per slice.
    """
    plan = slice_plan(df, time_field, spec)
    rows = _with_us(df, time_field).select("__us").filter(F.col("__us").isNotNull())
    labelled = with_scalars(rows, plan).withColumn("slice_id", _slice_of())
    per_slice = labelled.groupBy("slice_id").agg(F.count(F.lit(1)).alias("n"))
    counts = per_slice.agg(  # at most n entries
        F.map_from_entries(F.collect_list(F.struct("slice_id", "n"))).alias("__counts"))
    one = with_scalars(counts, plan).filter(F.col("__n").isNotNull() & F.col("__lo").isNotNull())
    ids = one.select("*", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("slice_id"))
    # Grid slices start and end at cut points; remainder slices at
    # __r0 + ceil(j * (__hi - __r0) / w), j counted within the remainder.
    start = """
        CASE WHEN slice_id < __m THEN
                 CASE WHEN slice_id = 0 THEN __lo
                      ELSE __lo + try_element_at(__cuts, slice_id) * __step END
             ELSE __r0 + ((slice_id - __m) * (__hi - __r0) + (__n - __m) - 1)
                         div (__n - __m) END"""
    end = """
        CASE WHEN slice_id < __m THEN __lo + try_element_at(__cuts, slice_id + 1) * __step
             WHEN slice_id = __n - 1 THEN __hi
             ELSE __r0 + ((slice_id - __m + 1) * (__hi - __r0) + (__n - __m) - 1)
                         div (__n - __m) END"""
    return ids.select(
        "slice_id",
        micros_to_ntz(F.expr(start)).alias("slice_start"),
        micros_to_ntz(F.expr(end)).alias("slice_end"),
        F.coalesce(F.try_element_at("__counts", F.col("slice_id")), F.lit(0).cast("long"))
        .alias("n_docs"))
