"""Sharding by a minimax contiguous partition (DataFrame operations only).

Groups of equal texts are atoms, ordered by the digest of their text. The
smallest capacity is searched for with which a greedy walk over the atoms, a
new shard whenever the next atom doesn't fit, needs no more than the wanted
number of shards; the atoms are cut where that walk cuts.

The walk doesn't need all atoms on the driver. Sizes are first summed by the
leading digits of the digest; with these sums a walk gives a lower and an upper
position for every cut, and a capacity is known to be feasible or not unless
the two differ. Only the ranges that still hold a cut are then read again,
summed by more digits, until the smallest capacity and its cuts are exact. The
driver holds a bounded number of sums at any size of the corpus.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize

FIRST_DIGITS = 3
#: Slices of a shard in which rows are numbered, each by a task of its own.
SLICES = 1024


class Ranges:
    """Sizes of consecutive ranges of atoms; a range of one atom can't be cut."""

    def __init__(self, parts: list[tuple[str, int, int]]):
        self.parts = sorted(parts)
        self.at = [0]
        for _, size, _ in self.parts:
            self.at.append(self.at[-1] + size)
        self.total = self.at[-1]

    def low_walk(self, capacity: int, shards: int) -> list[int]:
        """Positions that the greedy walk reaches at least."""
        out = [0]
        for _ in range(shards):
            out.append(self.at[bisect_right(self.at, out[-1] + capacity) - 1])
        return out

    def high_walk(self, capacity: int, shards: int) -> list[int]:
        """Positions that it reaches at most."""
        out = [0]
        for _ in range(shards):
            to = out[-1] + capacity
            k = bisect_right(self.at, to) - 1
            whole = k >= len(self.parts) or self.parts[k][2] == 1
            out.append(self.at[k] if whole else to)
        return out

    def smallest(self, walk, shards: int, low: int) -> int:
        """Smallest capacity from ``low`` on with which ``walk`` takes all."""
        high = max(low, self.total)
        while low < high:
            mid = (low + high) // 2
            if walk(mid, shards)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Smallest capacity for ``groups`` (``gid`` hex text, ``w`` size) and the first digits of each further shard.

    No groups: capacity 0 and no cuts.
    """
    def sums(df: DataFrame, digits: int) -> list[tuple[str, int, int]]:
        got = (df.groupBy(F.substring("gid", 1, digits).alias("p"))
               .agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect())
        return [(r.p, r.w, r.n) for r in got]

    largest = groups.agg(F.max("w")).first()[0]
    if largest is None:
        return 0, []
    digits = FIRST_DIGITS
    ranges = Ranges(sums(groups, digits))
    while True:
        floor = max(largest, -(-ranges.total // shards))
        low = ranges.smallest(ranges.high_walk, shards, floor)
        high = ranges.smallest(ranges.low_walk, shards, low)
        first, last = ranges.low_walk(low, shards), ranges.high_walk(high, shards)
        open_ranges = [p for k, (p, _, n) in enumerate(ranges.parts) if n > 1 and any(
            ranges.at[k] < b and a < ranges.at[k + 1] and not (a == b == ranges.at[k]) for a, b in zip(first[1:], last[1:], strict=True))]
        if low == high and first == last or not open_ranges:
            break
        more = 2 if len(open_ranges) <= 256 else 1
        digits += more
        # ranges that stay closed keep their shorter name
        lengths = sorted({len(p) for p in open_ranges})
        inside = F.lit(False)
        for n in lengths:
            inside |= F.substring("gid", 1, n).isin([p for p in open_ranges if len(p) == n])
        finer = sums(groups.filter(inside), digits)
        gone = set(open_ranges)
        ranges = Ranges([x for x in ranges.parts if x[0] not in gone] + finer)
    cuts, walk = [], ranges.low_walk(high, shards)
    for at in walk[1:]:
        if at < ranges.total:
            cuts.append(ranges.parts[bisect_right(ranges.at, at) - 1][0])
    return high, cuts


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, text_sha256, shard, slot`` of every row.

    The size is the UTF-8 bytes of the text (null: none) plus 1; null and empty
    texts are equal. Slots number the rows of a shard without a gap, in an
    order given by a hash of the row, so that a much-copied text is spread over
    the tasks that number them; rows with the same id and text take slots in
    any order among themselves. An empty table gives an empty result.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                                   F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("text_sha256")), "shard-rows")
    groups = materialize(rows.groupBy(F.col("text_sha256").alias("gid")).agg(F.sum("size").alias("w")), "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + F.when(F.col("text_sha256") >= cut, 1).otherwise(0)
    placed = rows.withColumn("shard", shard).withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_sha256"), F.lit(SLICES)))
    counts = materialize(placed.groupBy("shard", "slice").agg(F.count("*").alias("n")), "shard-slices")
    before = counts.select("shard", "slice", (F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_sha256"))
    return (placed.withColumn("number", number).join(before, ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", "text_sha256", "shard", (F.col("before") + F.col("number") - 1).alias("slot")))
