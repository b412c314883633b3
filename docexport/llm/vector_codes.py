"""Vector codes: product quantisation with exact integers over Hilbert-sorted blocks.

Vectors are cut into equal parts; every part position has a small codebook
that is refined in rounds. The parts of a position are sorted once along a
Hilbert curve and cut into flat blocks of near neighbours, each stored with
its smallest box and its sums:

* In a round, the least and the greatest distance of every entry from a
  block's box give the block a shortlist: an entry whose least distance is
  above some entry's greatest distance can't be the nearest of any part.
* A block with one entry on its list is assigned as a whole, by its stored
  count and sums; for the others an integer kernel tries the listed entries.

The curve decides only which parts share a block. Distances, sums and ties are
exact: 64-bit integers where a bound on the components proves that they are
enough, Python integers otherwise. A round sends back one sum for each entry
and component, whatever the number of vectors; blocks are a written table.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_batches, materialize, release

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Parts in a block.
BLOCK = 64
#: Components of a part that the curve runs through, at most, and bits of a key.
AXES = 16
KEY_BITS = 62
#: Integers of at most this size in floats of 64 bits.
LIMIT = 1 << 62


# -- the curve -------------------------------------------------------------

def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of points of a grid with ``bits`` bits an axis (the transposed form, bit by bit)."""
    x = [grid[:, k].astype(np.int64).copy() for k in range(grid.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of each level: reflect or swap the lower bits
        low = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] ^ turn) >> b & 1
    return key


def _grid(part: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, int]:
    """The widest axes of a part, cut into even steps over three deviations on both sides of the mean."""
    axes = np.sort(np.argsort(-spread, kind="stable")[:AXES])
    bits = max(1, min(8, KEY_BITS // max(1, len(axes))))
    step = np.where(spread[axes] > 0, 6 * spread[axes] / (1 << bits), 1.0)
    cell = np.floor((part[:, axes] - mean[axes]) / step) + (1 << (bits - 1))
    return np.clip(cell, 0, (1 << bits) - 1).astype(np.int64), bits


# -- blocks ----------------------------------------------------------------

_PART_TYPE = "position int, key long, rid long, part binary"
_BLOCK_TYPE = "position int, n int, rids binary, parts binary, low binary, high binary, sums array<decimal(38,0)>"


def _matrix(column, width: int) -> np.ndarray:
    """Rows of numbers of an Arrow list column."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), width)


def _cut(width: int, mean: np.ndarray, spread: np.ndarray):
    schema = pa.schema([("position", pa.int32()), ("key", pa.int64()), ("rid", pa.int64()), ("part", pa.binary())])
    size = width // PARTS

    def cut(batches):
        for batch in batches:
            rows = _matrix(batch.column("q"), width).astype(np.int64)
            for p in range(PARTS):
                at = slice(p * size, (p + 1) * size)
                part = np.ascontiguousarray(rows[:, at])
                grid, bits = _grid(part, mean[at], spread[at])
                data = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(np.arange(len(part) + 1, dtype=np.int32) * np.int32(8 * size)), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), p, np.int32)), pa.array(hilbert_keys(grid, bits)), batch.column("rid"), data], schema=schema)
    return cut


def _decimals(rows) -> pa.Array:
    return pa.array([[Decimal(int(x)) for x in r] for r in rows], pa.list_(pa.decimal128(38, 0)))


def _blocks(size: int):
    schema = pa.schema([("position", pa.int32()), ("n", pa.int32()), ("rids", pa.binary()), ("parts", pa.binary()), ("low", pa.binary()),
                        ("high", pa.binary()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def full(position: np.ndarray, rid: np.ndarray, part: np.ndarray, all_of_it: bool):
        """Blocks of the rows, and from where rows are left that may still fill a block."""
        edge = np.r_[0, np.flatnonzero(position[1:] != position[:-1]) + 1, len(position)]
        cuts = [(lo, min(lo + BLOCK, b)) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) for lo in range(a, b, BLOCK)]
        if not all_of_it and cuts[-1][1] - cuts[-1][0] < BLOCK:
            cuts.pop()
        out = [(int(position[a]), b - a, rid[a:b].tobytes(), part[a:b].tobytes(), part[a:b].min(axis=0).tobytes(), part[a:b].max(axis=0).tobytes()) for a, b in cuts]
        sums = [part[a:b].astype(object).sum(axis=0) if LIMIT // BLOCK <= int(np.abs(part[a:b]).max(initial=0)) else part[a:b].sum(axis=0) for a, b in cuts]
        return out, sums, cuts[-1][1] if cuts else 0

    def blocks(batches):
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:  # rows come sorted by position and key
            part = np.frombuffer(b"".join(batch.column("part").to_pylist()), np.int64).reshape(batch.num_rows, size)
            held.append((batch.column("position").to_numpy(), batch.column("rid").to_numpy(), part))
            rows = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            if not len(rows[0]):
                continue
            out, sums, done = full(*rows, False)
            held = [tuple(x[done:] for x in rows)]
            if out:
                yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], f.type) for i, f in enumerate(list(schema)[:-1])), _decimals(sums)], schema=schema)
        if held and len(held[0][0]):
            out, sums, _ = full(*held[0], True)
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], f.type) for i, f in enumerate(list(schema)[:-1])), _decimals(sums)], schema=schema)
        release()
    return blocks


# -- rounds ----------------------------------------------------------------

def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whether each entry (last axis but one: entries) may be the nearest of a point in each box."""
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    gap = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    least, most = (gap * gap).sum(axis=2), (far * far).sum(axis=2)
    return least <= most.min(axis=1)[:, None]


def nearest(parts: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest listed entry of every part (ties: the first) and its squared distance."""
    apart = parts[:, None, :] - entries[listed][None, :, :]
    apart = (apart * apart).sum(axis=2)
    best = apart.argmin(axis=1)
    return listed[best], apart[np.arange(len(parts)), best]


def _each_block(batch, size: int, books: np.ndarray):
    """Position, count, stored sums, parts and the shortlist of every block of a batch."""
    position = batch.column("position").to_numpy()
    low, high = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64).reshape(-1, size).astype(books.dtype) for c in ("low", "high"))
    for at in range(0, len(position), 1024):
        few = slice(at, at + 1024)
        listed = shortlists(low[few], high[few], books[position[few]])
        for i, p in enumerate(position[few].tolist()):
            yield at + i, p, np.flatnonzero(listed[i])


def _parts(batch, i: int, size: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column("parts")[i].as_buffer(), np.int64).reshape(-1, size).astype(kind)


_SUM_TYPE = "position int, entry int, n long, sums array<decimal(38,0)>"


def _round(size: int, books: np.ndarray):
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def assign(batches):
        n = np.zeros(books.shape[:2], np.int64)
        sums = np.zeros(books.shape, object)
        for batch in batches:
            counts = batch.column("n").to_numpy()
            for i, p, listed in _each_block(batch, size, books):
                if len(listed) == 1:
                    n[p, listed[0]] += int(counts[i])
                    sums[p, listed[0]] += np.array([int(x) for x in batch.column("sums")[i].as_py()], object)
                    continue
                parts = _parts(batch, i, size, books.dtype)
                code, _ = nearest(parts, books[p], listed)
                for e in np.unique(code).tolist():
                    mine = parts[code == e]
                    n[p, e] += len(mine)
                    sums[p, e] += mine.sum(axis=0).astype(object)
        some = np.argwhere(n > 0)
        yield pa.RecordBatch.from_arrays([pa.array(some[:, 0].astype(np.int32)), pa.array(some[:, 1].astype(np.int32)), pa.array(n[n > 0]),
                                          _decimals(sums[n > 0]) if len(some) else pa.array([], schema.field("sums").type)], schema=schema)
    return assign


def _codes(size: int, books: np.ndarray):
    schema = pa.schema([("rid", pa.int64()), ("code", pa.int64()), ("error", pa.int64())])

    def code(batches):
        for batch in batches:
            out = []
            for i, p, listed in _each_block(batch, size, books):
                rid = np.frombuffer(batch.column("rids")[i].as_buffer(), np.int64)
                index, error = nearest(_parts(batch, i, size, books.dtype), books[p], listed)
                shifted = index.astype(np.uint64) << np.uint64(8 * (PARTS - 1 - p))
                out.append((rid, shifted.view(np.int64), error))
            if out:
                rid, index, error = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(index), pa.array(error.tolist() if error.dtype == object else error, pa.int64())], schema=schema)
        release()
    return code


def _measure(width: int):
    """Count, sum and sum of squares of every component, as doubles, and the greatest size."""
    schema = pa.schema([("k", pa.int32()), ("n", pa.int64()), ("s", pa.float64()), ("ss", pa.float64()), ("top", pa.int64())])

    def measure(batches):
        n, s, ss, top = 0, np.zeros(width), np.zeros(width), 0
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("q"), width).astype(np.int64)
                n += len(rows)
                s += rows.sum(axis=0, dtype=np.float64)
                ss += np.square(rows, dtype=np.float64).sum(axis=0)
                top = max(top, int(np.abs(rows).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, n)), pa.array(s), pa.array(ss),
                                          pa.array(np.full(width, top, np.int64))], schema=schema)
    return measure


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``rid, vec_id, label, q`` of the rows whose vector has finite components only, as integers."""
    x = F.col(vector_col)
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.when(F.abs(v.cast("double")) < float(LIMIT // SCALE), F.floor(v.cast("double") * SCALE))
                        .otherwise(F.raise_error(F.lit(f"a vector component of {LIMIT // SCALE} or more")).cast("long")))
    return (vectors.filter(fine).select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), whole.alias("q")))


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes, error, label_error`` of every kept row, and the codebooks (part, entry, component).

    ``codes`` holds the entry indexes, a byte for each part, the first highest.
    Rows whose vector is null or has a null, NaN or infinite component are left
    out. The codebooks start from the ``ENTRIES`` rows with the smallest ids
    (null ids come last, equal ids go by their components; fewer rows give
    fewer entries). Ids and labels may repeat or be null; ``label_error`` adds up
    the errors of equal labels, nulls together. An empty table gives an empty
    result. Vectors of unequal lengths, of a length that ``PARTS`` doesn't
    divide, or with components from 2 ** 50 on raise.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kept = materialize(kept_vectors(vectors, id_col, vector_col, label_col), "vector-kept")
    lengths = kept.agg(F.min(F.size("q")).alias("least"), F.max(F.size("q")).alias("most")).first()
    empty = kept.select("vec_id", "label", F.lit(0).cast("long").alias("codes"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
    if lengths["most"] is None:
        return empty, np.zeros((PARTS, 0, 0), np.int64)
    width = lengths["most"]
    if lengths["least"] != width or width % PARTS:
        raise ValueError(f"vectors of {lengths['least']} to {width} components can't be cut into {PARTS} equal parts")
    size = width // PARTS
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "q").limit(ENTRIES).select("q").collect()
    start = np.array([r["q"] for r in first], np.int64).reshape(len(first), PARTS, size).transpose(1, 0, 2)
    if not width:
        return empty, start
    stats = (kept.select("q").mapInArrow(_measure(width), "k int, n long, s double, ss double, top long").groupBy("k")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.max("top").alias("top")).orderBy("k").collect())
    n, s, ss = (np.array([r[c] for r in stats], np.float64) for c in ("n", "s", "ss"))
    mean, spread = s / n, np.sqrt(np.maximum(ss / n - np.square(s / n), 0))
    top = max(r["top"] for r in stats)
    # squared distances of a part stay below size * (2 top) ** 2; a block's sums are far smaller
    books = start.copy() if size * (2 * top) ** 2 < 1 << 63 else start.astype(object)
    cut = kept.select("rid", "q").mapInArrow(_cut(width, mean, spread), _PART_TYPE)
    sorted_parts = materialize(cut, "vector-parts").repartitionByRange("position", "key", "rid").sortWithinPartitions("position", "key", "rid")
    blocks = materialize(sorted_parts.mapInArrow(_blocks(size), _BLOCK_TYPE), "vector-blocks")
    for _ in range(rounds):
        found = (blocks.select("position", "n", "parts", "low", "high", "sums").mapInArrow(_round(size, books.copy()), _SUM_TYPE)
                 .groupBy("position", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(size))).collect())
        for r in found:
            books[r["position"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(size)]
    coded = blocks.select("position", "rids", "parts", "low", "high").mapInArrow(_codes(size, books.copy()), "rid long, code long, error long")
    whole = coded.groupBy("rid").agg(F.bit_or("code").alias("codes"), F.sum("error").alias("error"))
    out = materialize(kept.select("rid", "vec_id", "label").join(whole, "rid").select("vec_id", "label", "codes", "error"), "vector-codes")
    by_label = materialize(out.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels").withColumnRenamed("label", "of")
    return out.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()
