"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per document and a column per word n-gram. Its product
with its transpose holds the overlap of every two documents; only entries that
can reach the similarity are ever formed:

* Columns are ordered from rare to common (counts over the whole corpus, found
  by the block exchange). Two documents that are similar enough share a column
  among the rarest few of each, whose number follows from the document's size;
  a column that no other document has takes up one of these places, so most
  documents drop out here.
* Documents with equal sets are one row of the matrix (the class).
* The remaining columns are multiplied block by block: within a column, rows
  sorted by size meet in tiles of bounded size. Entries whose sizes are too far
  apart, or whose parity bitmaps differ in more bits than the size-derived bound
  allows (the difference of two sets is at least the number of differing parity
  bits), are discarded inside the tile; no pair is emitted for them.
* What is left is counted exactly and compared with the bound.
* Columns of more than ``DENSE`` rows come from large groups of near copies.
  The rows that such columns connect form clusters, whose square is taken in
  tiles of whole rows, in the order of size and of columns that a row has
  alone: pairs of tiles that these bounds rule out, as among texts of one
  template with too many words of their own, are never formed. Every entry of
  a tile is counted exactly, a tile gives each row's number of links and, in
  place of all its pairs, the links of a spanning forest of its rows. Rows of
  one cluster need no further pairs from other columns.

Links are joined into components by rounds of contraction in Spark; no link or
component passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import (bucket_bits, materialize, mix64, pack, pieces, release, runs, table_runs, text_buffers, to_blocks,
                     word_hashes)

N = 4
PERCENT = 85
#: Rows of a tile side; a tile holds at most its square of entries.
TILE = 1024
#: Rows and bytes of columns of a tile side in a cluster, about.
CLUSTER_TILE = 2048
CLUSTER_TILE_BYTES = 8 << 20
#: Rows of a column from which it is multiplied by clusters.
DENSE = 32
#: Words of columns, as bits, that a cluster tile counts at once, and words of its pairs.
COUNT_WORDS = 1024
PAIR_WORDS = 1 << 21
#: Bits of the parity bitmap.
BITMAP = 1024


def ngram_sets(column, n: int = N):
    """For each text its distinct n-gram hashes, sorted; a text of fewer words is one n-gram."""
    raw, off = text_buffers(column)
    for lo, hi in pieces(off):
        words, row = word_hashes(raw, off[lo:hi + 1])
        row = row.astype(np.int64)
        bounds = np.searchsorted(row, np.arange(hi - lo + 1))
        gram = np.zeros(len(words), np.uint64)
        for k in range(n):
            shifted = np.zeros(len(words), np.uint64)
            if k < len(words):
                shifted[:len(words) - k] = words[k:]
            gram = mix64(gram * np.uint64(0x9FB21C651E98DF25) + shifted + np.uint64(k + 1))
        for d in range(hi - lo):
            a, b = int(bounds[d]), int(bounds[d + 1])
            if b - a >= n:
                yield np.unique(gram[a:b - n + 1])
            elif b > a:
                h = np.uint64(b - a)
                for w in words[a:b]:
                    h = mix64(np.array([h], np.uint64) * np.uint64(0x9FB21C651E98DF25) + w + np.uint64(77))[0]
                yield np.array([h], np.uint64)
            else:
                yield np.empty(0, np.uint64)


def _column_keys(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram and its 32-bit name there; names only order the columns."""
    return (h >> np.uint64(64 - bits)).astype(np.int64), ((h >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def least_overlap(size_a, size_b, percent: int = PERCENT):
    """Smallest intersection for which 100 * i >= percent * union."""
    return -((-percent * (size_a + size_b)) // (100 + percent))


def prefix_length(size, percent: int = PERCENT):
    """Rarest columns among which a row must meet any row similar to it."""
    return size - -((-percent * size) // 100) + 1


def index_length(size, percent: int = PERCENT):
    """The same for the smaller row of the two."""
    return size - -((-2 * percent * size) // (100 + percent)) + 1


def _send(bits: int, n: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def send(batches):
        for batch in batches:
            for block, part in table_runs(batch):
                sets = list(ngram_sets(part.column("text"), n))
                if not sets:
                    continue
                h, c = np.unique(np.concatenate(sets), return_counts=True)
                bucket, key = _column_keys(h, bits)
                rows = []
                for a, b in runs(bucket):
                    k, first = np.unique(key[a:b], return_index=True)
                    total = np.minimum(np.add.reduceat(c[a:b], first), 65535).astype(np.uint16)
                    rows.append((int(bucket[a]), block, pack(k), pack(total)))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
        release()
    return send


def _answer(table: pa.Table) -> pa.Table:
    """Total count of every key that several documents have, for each block that has it."""
    keys = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
    counts = [np.frombuffer(x, np.uint16) for x in table.column("counts").to_pylist()]
    all_keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts), minlength=len(all_keys))
    total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
    out_k, out_c, at = [], [], 0
    for k in keys:
        t = total[place[at:at + len(k)]]
        at += len(k)
        out_k.append(pack(k[t > 1]))
        out_c.append(pack(t[t > 1]))
    del keys, counts, all_keys, place, total
    release()
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "keys": pa.array(out_k, pa.binary()), "counts": pa.array(out_c, pa.binary())})


def _rows(bits: int, n: int, percent: int):
    """Matrix rows of a block: size, set signature and the shared columns from rare to common."""
    def rows(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names, counts = [], []
        for bucket, k, c in zip(*(answers.column(x).to_pylist() for x in ("bucket", "keys", "counts")), strict=True):
            names.append(np.frombuffer(k, np.uint32).astype(np.uint64) + (np.uint64(bucket) << np.uint64(32)))
            counts.append(np.frombuffer(c, np.uint32))
        known, first = np.unique(np.concatenate(names or [np.empty(0, np.uint64)]), return_index=True)
        common = np.concatenate(counts or [np.empty(0, np.uint32)])[first]
        out = {k: [] for k in ("size", "sig_a", "sig_b", "alone", "cols")}
        for h in ngram_sets(docs.column("text"), n):
            size = len(h)
            bucket, key = _column_keys(h, bits)
            name = (bucket.astype(np.uint64) << np.uint64(32)) + key.astype(np.uint64)
            at = np.minimum(np.searchsorted(known, name), max(len(known) - 1, 0))
            shared = known[at] == name if len(known) else np.zeros(size, bool)
            alone = size - int(shared.sum())
            candidate = size > 0 and alone < prefix_length(size, percent)
            out["size"].append(size)
            out["alone"].append(alone)
            if candidate:
                order = np.lexsort((h[shared], name[shared], common[at[shared]]))
                out["cols"].append(pack(h[shared][order]))
                out["sig_a"].append(int(np.bitwise_xor.reduce(mix64(h + np.uint64(1))).view(np.int64)))
                out["sig_b"].append(int(np.add.reduce(mix64(h ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)))
            else:
                for k in ("cols", "sig_a", "sig_b"):
                    out[k].append(None)
        del names, counts, known, common
        release()
        return pa.table({"rid": docs.column("rid"), "doc_id": docs.column("doc_id"),
                         "size": pa.array(out["size"], pa.int64()), "alone": pa.array(out["alone"], pa.int64()),
                         "sig_a": pa.array(out["sig_a"], pa.int64()), "sig_b": pa.array(out["sig_b"], pa.int64()),
                         "cols": pa.array(out["cols"], pa.binary())})
    return rows


def _bitmap(cols: np.ndarray) -> bytes:
    """Parity of the shared columns by bit; columns of one row alone are counted apart."""
    bit = (mix64(cols) & np.uint64(BITMAP - 1)).astype(np.int64)
    return pack(np.packbits(np.bincount(bit, minlength=BITMAP) & 1))


def _entries(percent: int):
    """Non-zero entries among the rarest columns of every class."""
    schema = pa.schema([("col", pa.int64()), ("rep", pa.int64()), ("size", pa.int64()), ("alone", pa.int64()),
                        ("indexed", pa.bool_()), ("bits", pa.binary())])

    def entries(batches):
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            bits: list[bytes] = []
            for rid, size, alone, cols in zip(*(batch.column(c).to_pylist() for c in ("rid", "size", "alone", "cols")), strict=True):
                a = np.frombuffer(cols, np.uint64)
                probe = a[:prefix_length(size, percent) - alone]
                m = len(probe)
                parts.append([probe.view(np.int64), np.full(m, rid), np.full(m, size), np.full(m, alone),
                              np.arange(m) < index_length(size, percent) - alone])
                bits += [_bitmap(a)] * m
                if len(bits) > 50_000:
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)), pa.array(bits, pa.binary())], schema=schema)
                    parts, bits = [], []
            if bits:
                yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)), pa.array(bits, pa.binary())], schema=schema)
    return entries, schema


def _pair_chunks(size: np.ndarray, alone: np.ndarray, indexed: np.ndarray, bits: np.ndarray, percent: int, part: np.ndarray | None = None):
    """Bounded chunks of the pairs of rows, sorted by size, that tiles can't rule out; with ``part``, of unequal parts only."""
    first = np.flatnonzero(indexed)
    for lo in range(0, len(first), TILE):
        x = first[lo:lo + TILE]
        for at in range(int(x[0]) + 1, len(size), TILE):
            y = np.arange(at, min(at + TILE, len(size)))
            if 100 * int(size[x[-1]]) < percent * int(size[y[0]]):
                break
            if int(alone[x].min()) + int(alone[y].min()) > spare(int(size[x[-1]]), int(size[y[-1]]), percent):
                continue
            fits = (y[None, :] > x[:, None]) & (100 * size[x][:, None] >= percent * size[y][None, :])
            if part is not None:
                fits &= part[x][:, None] != part[y][None, :]
            i, j = np.nonzero(fits)
            for k in range(0, len(i), 1 << 17):
                a, b = x[i[k:k + (1 << 17)]], y[j[k:k + (1 << 17)]]
                apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) + alone[a] + alone[b]
                both = size[a] + size[b]
                ok = apart <= both - 2 * least_overlap(size[a], size[b], percent)
                if ok.any():
                    yield a[ok], b[ok]


def column_pairs(rep: np.ndarray, size: np.ndarray, alone: np.ndarray, indexed: np.ndarray, bits: np.ndarray,
                 percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one column that its tiles can't rule out; rows are sorted by (size, rep)."""
    left, right = [], []
    for a, b in _pair_chunks(size, alone, indexed, bits, percent):
        left.append(rep[a])
        right.append(rep[b])
    none = np.empty(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _tiles(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def tiles(batches):
        held: list[pa.Table] = []
        seen: set[int] = set()

        def finish():
            table = pa.concat_tables(held).combine_chunks()
            rep, size, alone, indexed = (table.column(c).to_numpy() for c in ("rep", "size", "alone", "indexed"))
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(rep), -1)
            a, b = column_pairs(rep, size, alone, indexed, bits, percent)
            fresh = [(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if (key := hash((x, y))) not in seen and not seen.add(key)]
            if len(seen) > 200_000:
                seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in fresh], pa.int64()) for k in (0, 1)], schema=schema)

        now = None
        for batch in batches:  # rows come sorted by column, size and class
            for lo, hi in runs(batch.column("col").to_numpy()):
                col = batch.column("col")[lo].as_py()
                if held and col != now:
                    if sum(t.num_rows for t in held) > 1:
                        yield finish()
                    held = []
                now = col
                held.append(pa.Table.from_batches([batch.slice(lo, hi - lo)]))
        if held and sum(t.num_rows for t in held) > 1:
            yield finish()
    return tiles, schema


#: A link and what it adds to the numbers of links of its ends; a degree alone has no ``b``.
_LINKS_TYPE = "a long, b long, n_a long, n_b long"


def _verify(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64())])

    def verify(batches):
        for batch in batches:
            a, b, sa, sb, ca, cb = (batch.column(c).to_numpy() for c in ("a", "b", "size_a", "size_b", "copies_a", "copies_b"))
            need = least_overlap(sa, sb, percent)
            ok = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) >= m
                  for x, y, m in zip(batch.column("cols_a").to_pylist(), batch.column("cols_b").to_pylist(), need.tolist(), strict=True)]
            ok = np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in (a, b, cb, ca)], schema=schema)
        release()
    return verify, schema


class _Overlaps:
    """Exact overlaps of rows of a tile, counted on bits of the columns that several of its rows have."""

    def __init__(self, sets: list[np.ndarray]):
        entries = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(entries, kind="stable")
        entries, row = entries[order], row[order]
        new = np.ones(len(entries), bool)
        new[1:] = entries[1:] != entries[:-1]
        name = np.cumsum(new) - 1
        shared = np.bincount(name)[name] > 1
        self.row = row[shared]
        self.col = np.cumsum(new[shared]) - 1
        self.rows, self.words = len(sets), int(self.col[-1]) // 64 + 1 if len(self.col) else 0
        self.first = self._bits(0) if self.words <= COUNT_WORDS else None

    def _bits(self, at: int) -> np.ndarray:
        """Bits of the columns from word ``at``; columns ascend, so a range of entries holds them."""
        width = min(COUNT_WORDS, self.words - at)
        lo, hi = np.searchsorted(self.col, [64 * at, 64 * (at + width)])
        bits = np.zeros((self.rows, width), np.uint64)
        col = self.col[lo:hi] - 64 * at
        np.bitwise_or.at(bits, (self.row[lo:hi], col >> 6), np.uint64(1) << (col & 63).astype(np.uint64))
        return bits

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        for at in range(0, self.words, COUNT_WORDS):
            bits = self._bits(at) if self.first is None else self.first
            step = max(1, PAIR_WORDS // bits.shape[1])
            for k in range(0, len(a), step):
                total[k:k + step] += np.bitwise_count(bits[a[k:k + step]] & bits[b[k:k + step]]).sum(axis=1, dtype=np.int64)
        return total


def _cluster_links(percent: int):
    """Links of a tile of a cluster: how many each of its rows has, and a forest that connects all rows that links connect."""
    def links(key, table):
        across = key[1].as_py() != key[2].as_py()
        rid, size, alone, copies, tile = (table.column(c).to_numpy() for c in ("rid", "size", "alone", "copies", "tile"))
        order = np.lexsort((rid, alone, size))
        cols = table.column("cols").combine_chunks()
        sets = [np.frombuffer(cols[i].as_buffer(), np.uint64) for i in order]
        rid, size, alone, copies, tile = rid[order], size[order], alone[order], copies[order], tile[order]
        bits = np.frombuffer(b"".join(map(_bitmap, sets)), np.uint64).reshape(len(rid), -1)
        overlaps = _Overlaps(sets)
        degree = np.zeros(len(rid), np.int64)
        up = np.arange(len(rid))
        out = []
        for a, b in _pair_chunks(size, alone, np.ones(len(rid), bool), bits, percent, tile if across else None):
            ok = overlaps.count(a, b) >= least_overlap(size[a], size[b], percent)
            a, b = a[ok], b[ok]
            np.add.at(degree, a, copies[b])
            np.add.at(degree, b, copies[a])
            while (up != up[up]).any():
                up = up[up]
            fresh = up[a] != up[b]
            for x, y in zip(a[fresh].tolist(), b[fresh].tolist(), strict=True):
                rx, ry = x, y
                while up[rx] != rx:
                    up[rx] = rx = up[up[rx]]
                while up[ry] != ry:
                    up[ry] = ry = up[up[ry]]
                if rx != ry:
                    up[rx] = ry
                    out.append((x, y))
        got = np.array(out, np.int64).reshape(-1, 2)
        linked = np.flatnonzero(degree)
        del sets, cols, bits, overlaps
        release()
        n_a = np.zeros(len(got) + len(linked), np.int64)
        n_a[len(got):] = degree[linked]
        return pa.table({"a": pa.array(np.concatenate([rid[got[:, 0]], rid[linked]])),
                         "b": pa.concat_arrays([pa.array(rid[got[:, 1]], pa.int64()), pa.nulls(len(linked), pa.int64())]),
                         "n_a": pa.array(n_a), "n_b": pa.array(np.zeros(len(n_a), np.int64))})
    return links


def _clusters(entries: DataFrame, columns: DataFrame) -> DataFrame:
    """``rid, cluster`` of the rows that dense columns connect."""
    dense = columns.filter(F.col("n") > DENSE).select("col", "hub")
    star = entries.select("col", "rep").join(dense, "col").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    return components(star).select(F.col("node").alias("rid"), F.col("root").alias("cluster"))


def spare(size_a, size_b, percent: int = PERCENT):
    """Columns by which two similar rows differ at most; columns of one row alone are such."""
    both = size_a + size_b
    return both - 2 * least_overlap(size_a, size_b, percent)


def _cluster_tiles(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rid, cluster, tile`` of the rows of clusters, and ``cluster, tile, least, most, alone`` of the tiles.

    A tile holds neighbours in the order of size and then of lonely columns, so
    that bounds rule out whole tiles. The order is taken over the (size, alone)
    that occur; rows that share both are dealt among the tiles they fill.
    """
    load = F.greatest(F.count("*") / CLUSTER_TILE, F.sum("width") / CLUSTER_TILE_BYTES)
    kinds = materialize(members.groupBy("cluster", "size", "alone").agg(load.alias("load")), "join-cluster-kinds")
    before = F.sum("load").over(Window.partitionBy("cluster").orderBy("size", "alone").rowsBetween(Window.unboundedPreceding, -1))
    at = F.coalesce(before, F.lit(0.0))
    kinds = kinds.select("cluster", "size", "alone", F.floor(at).cast("int").alias("first"),
                         (F.ceil(at + F.col("load") - 1e-9) - F.floor(at)).cast("int").alias("over"))
    dealt = materialize(members.join(materialize(kinds, "join-cluster-order"), ["cluster", "size", "alone"])
                        .select("rid", "cluster", "size", "alone", (F.col("first") + F.pmod(F.xxhash64("rid"), F.greatest("over", F.lit(1)))).cast("int").alias("tile")),
                        "join-cluster-tiles")
    tiles = dealt.groupBy("cluster", "tile").agg(F.min("size").alias("least"), F.max("size").alias("most"), F.min("alone").alias("alone"))
    return dealt.select("rid", "cluster", "tile"), materialize(tiles, "join-tiles")


def _tile_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """``cluster, low, high`` of the pairs of tiles that may hold a link: near enough in size, with few enough lonely columns."""
    a, b = (tiles.select(*[F.col(c).alias(f"{c}_{side}") for c in tiles.columns]) for side in "ab")
    both = F.col("most_a") + F.col("most_b")
    differ = both - 2 * F.ceil(F.lit(percent) * both / (100 + percent)).cast("long")
    near = (F.lit(100) * F.col("most_a") >= F.lit(percent) * F.col("least_b")) & (F.lit(100) * F.col("most_b") >= F.lit(percent) * F.col("least_a"))
    pairs = a.join(b, (F.col("cluster_a") == F.col("cluster_b")) & (F.col("tile_a") <= F.col("tile_b")) & near & (F.col("alone_a") + F.col("alone_b") <= differ))
    return pairs.select(F.col("cluster_a").alias("cluster"), F.col("tile_a").alias("low"), F.col("tile_b").alias("high"))


def _links_in_clusters(reps: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    members = reps.select("rid", "size", "alone", F.octet_length("cols").alias("width")).join(clusters, "rid")
    dealt, tiles = _cluster_tiles(members)
    pairs = materialize(_tile_pairs(tiles, percent), "join-tile-pairs")
    sides = (pairs.select("cluster", F.col("low").alias("tile"), "low", "high")
             .unionAll(pairs.filter("low != high").select("cluster", F.col("high").alias("tile"), "low", "high")))
    rows = (reps.join(dealt, "rid").join(sides, ["cluster", "tile"])
            .select("cluster", "low", "high", "tile", "rid", "size", "alone", "copies", "cols"))
    return rows.groupBy("cluster", "low", "high").applyInArrow(_cluster_links(percent), _LINKS_TYPE)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the smallest node it can reach.

    Rounds of contraction: every node points at its smallest neighbour, links
    are drawn between what their ends point at, until none is left; then the
    pointers are followed back. Each round's tables are written.
    """
    edges = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
        point = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to")), "pointers")
        while True:  # follow the pointers of this round to their ends, doubling the steps
            up = point.select(F.col("to").alias("via"), F.col("u").alias("m"))
            nxt = materialize(point.join(up, F.col("to") == F.col("m"))
                              .select("u", F.col("via").alias("to"), (F.col("via") != F.col("to")).alias("moved")), "pointers")
            point = nxt.select("u", "to")
            if nxt.filter("moved").isEmpty():
                break
        rounds.append(point)
        pa_, pb = (point.select(F.col("u").alias(c), F.col("to").alias(f"to_{c}")) for c in ("a", "b"))
        edges = materialize(edges.join(pa_, "a").join(pb, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                            .filter("a < b").distinct(), "links")
    if not rounds:
        return links.sparkSession.createDataFrame([], "node long, root long")
    root = None
    for point in reversed(rounds):
        if root is None:
            root = point.select(F.col("u").alias("node"), F.col("to").alias("root"))
            continue
        up = root.select(F.col("node").alias("to"), F.col("root").alias("top"))
        root = materialize(point.join(up, "to", "left").select(F.col("u").alias("node"), F.coalesce("top", "to").alias("root")), "roots")
    return root


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT,
                      row_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows and links of the join.

    The first frame has ``rid, doc_id, n_ngrams, class, n_links`` for every row
    (rows of a class have equal sets; the class is the smallest rid). ``n_links``
    is the number of all other rows similar to the row, those of its class
    included. The second frame has links ``a, b`` between classes that connect
    every component: all links of classes that no column of more than ``DENSE``
    classes connects, but within the clusters of such columns only a spanning
    forest per tile, whose other links are counted in ``n_links``, not listed.
    Rows without words have no n-gram, a null class and no link. Ids may repeat
    or be null; each row counts for itself.
    """
    blocks = to_blocks(docs, id_col, text_col, "join-blocks", row_id=row_id)
    bits = bucket_bits(blocks)
    sent = blocks.select("block", "text").mapInArrow(_send(bits, n), "bucket int, block long, keys binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer, "block long, bucket int, keys binary, counts binary")
    rows = materialize(
        blocks.select("block", "rid", "doc_id", "text").groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_rows(bits, n, percent), "rid long, doc_id long, size long, alone long, sig_a long, sig_b long, cols binary"),
        "join-rows")
    live = rows.filter("cols is not null")
    classes = materialize(live.groupBy("size", "sig_a", "sig_b").agg(F.min("rid").alias("class"), F.count("*").alias("copies")), "join-classes")
    member = live.select("rid", "size", "sig_a", "sig_b").join(classes, ["size", "sig_a", "sig_b"]).select("rid", "class", "copies")
    reps = materialize(live.select("rid", "size", "alone", "cols").join(classes.select(F.col("class").alias("rid"), "copies"), "rid"), "join-reps")
    make, schema = _entries(percent)
    entry_type = "col long, rep long, size long, alone long, indexed boolean, bits binary"
    entries = materialize(reps.mapInArrow(make, entry_type), "join-entries")
    columns = materialize(entries.groupBy("col").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).filter("n > 1"), "join-columns")
    clusters = materialize(_clusters(entries, columns), "join-clusters")
    tile, _ = _tiles(percent)
    pairs = (entries.join(columns.filter(F.col("n") <= DENSE).select("col"), "col").select(*entries.columns)
             .repartition("col").sortWithinPartitions("col", "size", "rep").mapInArrow(tile, "a long, b long").distinct())
    in_cluster = {c: clusters.select(F.col("rid").alias(c), F.col("cluster").alias(f"cluster_{c}")) for c in "ab"}
    pairs = materialize(pairs.join(in_cluster["a"], "a", "left").join(in_cluster["b"], "b", "left")
                        .filter("cluster_a is null or cluster_b is null or cluster_a != cluster_b").select("a", "b"), "join-pairs")
    side = {c: reps.select(F.col("rid").alias(c), F.col("size").alias(f"size_{c}"), F.col("copies").alias(f"copies_{c}"),
                       F.col("cols").alias(f"cols_{c}")) for c in "ab"}
    check, _ = _verify(percent)
    links = pairs.join(side["a"], "a").join(side["b"], "b").mapInArrow(check, _LINKS_TYPE)
    links = materialize(links.unionAll(_links_in_clusters(reps, clusters, percent)), "join-links")
    degrees = (links.select(F.col("a").alias("class"), F.col("n_a").alias("n"))
               .unionAll(links.filter("b is not null").select("b", "n_b")).groupBy("class").agg(F.sum("n").alias("far")))
    out = rows.select("rid", "doc_id", F.col("size").alias("n_ngrams")).join(member, "rid", "left").join(degrees, "class", "left")
    out = out.select("rid", "doc_id", "n_ngrams", F.when(F.col("n_ngrams") > 0, F.coalesce("class", "rid")).alias("class"),
                     (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    return out, links.filter("b is not null").select("a", "b")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``rid, doc_id, n_ngrams, n_links, component, first_rid`` of every row.

    ``n_links`` is the number of rows similar to the row. ``component`` is the
    smallest id that links reach from the row, its own included; rows without
    words are alone. ``first_rid`` is the smallest row of the component.
    """
    rows, links = similar_documents(docs, id_col, text_col, **options)
    roots = components(links)
    rows = rows.join(roots, F.col("class") == F.col("node"), "left")
    rows = materialize(rows.select("rid", "doc_id", "n_ngrams", "n_links", F.coalesce("root", "class", "rid").alias("root")), "join-members")
    groups = materialize(rows.groupBy("root").agg(F.min("doc_id").alias("component"), F.min("rid").alias("first_rid"), F.count("*").alias("m"))
                         .filter("m > 1"), "join-groups")
    out = rows.join(groups, "root", "left")
    alone = F.col("m").isNull()
    return out.select("rid", "doc_id", "n_ngrams", "n_links", F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component"),
                      F.coalesce("first_rid", "rid").alias("first_rid"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the first with the smallest id; all columns."""
    held = "joined_row_id"
    while held in docs.columns:
        held += "_"
    copy = materialize(docs.withColumn(held, F.monotonically_increasing_id()), "join-copy")
    found = similar_components(copy, id_col, text_col, row_id=held, **options)
    # the row that stays: smallest id, then first row
    marks = found.select(F.col("rid").alias(held), F.col("doc_id").alias("own_id"), "first_rid")
    marks = materialize(marks, "join-marks")
    stay = marks.groupBy("first_rid").agg(F.coalesce(F.min_by(held, "own_id"), F.min(held)).alias("stay"), F.count("*").alias("m")).filter("m > 1")
    stay = materialize(stay, "join-stay")
    gone = marks.join(stay, "first_rid").filter(F.col(held) != F.col("stay")).select(held)
    return copy.join(gone, held, "left_anti").select(*docs.columns)
