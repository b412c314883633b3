"""Shared helpers: written intermediate tables, row blocks, key exchange between blocks.

The block pattern serves operators that need to know something about every
key of a document (a word, a shingle, a window) over the whole corpus:

1. ``to_blocks`` writes the documents in blocks of consecutive rows;
2. each block sends its *distinct* keys, packed per bucket into one binary
   cell (so a key that a third of the corpus holds is sent once per block);
3. one task per bucket adds up and answers each block;
4. documents and answers meet again, cogrouped on the block.

A task never holds more than one block or one bucket, and the number of
buckets grows with the corpus. Blocks are bounded in rows and bytes.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path

#: Rows in a block at most, and bytes of text, about (a longer text is a block alone); the widest unit a task holds at once.
BLOCK_ROWS = 2048
BLOCK_BYTES = 32 << 20
#: Bytes of text for which one bucket is made.
BUCKET_BYTES = 8 << 20


#: Rows and bytes that Spark hands to Python at once, at most (a longer row is a batch alone).
BATCH_ROWS = 2048
BATCH_BYTES = 8 << 20


def bounded_batches(spark) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes.

    Texts are long, and both sides hold whole batches.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system: Python workers live on and serve the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def materialize(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The copy cuts the lineage: a lost executor costs the tasks that read it,
    and ids made by position stay what they were. With ``clean`` the shuffle
    files that only the written table needed go at once: Spark drops them when
    the driver's collector finds no plan that uses them, and the plan of the
    last job is held, so a small job comes between.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if clean:
        spark.range(1).count()
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def to_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              name: str = "blocks", rows: int = BLOCK_ROWS, row_id: str | None = None) -> DataFrame:
    """``rid, block, doc_id, text`` of every row, written; null texts are empty.

    ``rid`` names the row (ids may repeat or be null); ``block`` holds at most
    ``rows`` consecutive rows of one input partition; where these have more than
    ``BLOCK_BYTES`` bytes, they are dealt out into several blocks. With
    ``row_id``, a column of such ids in a table that is already written,
    nothing is written unless blocks have to be dealt out.
    """
    bounded_batches(docs.sparkSession)
    df = docs.select((F.monotonically_increasing_id() if row_id is None else F.col(row_id)).alias("rid"),
                     F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = df.withColumn("block", F.expr(f"rid div {rows}"))
    df = materialize(df, name) if row_id is None else df
    heavy = df.groupBy("block").agg(F.sum(F.octet_length("text")).alias("bytes")).filter(F.col("bytes") > BLOCK_BYTES)
    if heavy.isEmpty():
        return df
    # twice as many as the bytes ask for, since rows are dealt by hash
    parts = heavy.select("block", F.least(F.ceil(2 * F.col("bytes") / BLOCK_BYTES), F.lit(rows)).alias("parts"))
    dealt = (df.join(materialize(parts, f"{name}-heavy"), "block", "left")
             .withColumn("block", F.col("block") * rows + F.coalesce(F.pmod(F.xxhash64("rid"), "parts"), F.lit(0))))
    return materialize(dealt.select(*df.columns).repartition("block").sortWithinPartitions("block", "rid"), name)


def bucket_bits(blocks: DataFrame, least: int = 6, each: int = BUCKET_BYTES) -> int:
    """Bits of a bucket number: one bucket for about ``each`` bytes of text, ``2 ** least`` at least."""
    total = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, int(total // each).bit_length())


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offsets


def pieces(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each; a longer row is a range alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if len(values):
        cuts = np.flatnonzero(np.diff(values)) + 1
        yield from zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(values)].tolist(), strict=True)


def table_runs(batch, column: str = "block"):
    """The block number and the rows of each run of one block in an Arrow batch."""
    values = batch.column(column).to_numpy(zero_copy_only=False)
    for lo, hi in runs(values):
        yield int(values[lo]), batch.slice(lo, hi - lo)


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def to_planes(a: np.ndarray) -> bytes:
    """Whole numbers >= 0 as their width in bytes, then all lowest bytes, all next, and so on: like bytes lie together and compress."""
    size = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    return bytes([size]) + np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def from_planes(cell: bytes) -> np.ndarray:
    """The numbers of ``to_planes``, as 64 bits."""
    size = cell[0]
    n = (len(cell) - 1) // size
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(cell, np.uint8, n * size, 1).reshape(size, n).T
    return out.view("<u8").ravel()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that any bits of the result can name a bucket."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _byte_codes() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


BYTE_CODE = _byte_codes()
_ODD = 0xD1342543DE82EF95
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64, kept between calls up to a bound."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        a = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        a[0] = 1
        have = np.multiply.accumulate(a)
        if len(have) <= 1 << 22:
            _powers[base] = have
    return have[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums by which ``span_hash`` gives the hash of any span."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * powers(_ODD, len(codes)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, the same wherever the span lies."""
    return mix64((sums[end] - sums[start]) * powers(_ODD_INVERSE, len(sums))[start])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased (A-Z) word ``[^\\x20\\x09-\\x0D]+`` and the row it belongs to."""
    base, end = int(offsets[0]), int(offsets[-1])
    data = _LOWER[raw[base:end]]
    off = offsets - base
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    sums = prefix_sums(BYTE_CODE[data])
    return span_hash(sums, starts, ends), np.searchsorted(off, starts, side="right") - 1

