"""SimHash near-duplicates by a binary trie self-join.

The distinct fingerprints are the leaves of a binary trie whose unbranched
paths are contracted. Two nodes are traversed together: their labels' differing
bits are accumulated as far as both are known, and a pair over the error
budget is pruned with all that lies below it. All pairs of leaves that survive
are links; no pair is emitted, a traversal gives every leaf its number of
links and a spanning forest of what it has linked.

The trie is dealt out by its own bits: 64 bits with at most three errors fall
into four parts one of which has none, so the self-join runs once for each
part, over the subtrees in which that part is equal, and counts a link only at
the first such part. A subtree with more than ``LARGE`` fingerprints is dealt
out again in the same way by the bits it has left, so no task gets a subtree
that grows with the corpus; copies of a text are one leaf from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import bounded_batches, materialize, pieces, release, text_buffers
from .ngram_join import components

WORDS = 3
SEED = 42
BITS = 64
ERRORS = 3
#: Fingerprints of a subtree that one task traverses, at most.
LARGE = 1 << 14
#: Node pairs that a traversal holds at once, and rows gathered before it starts, about.
PAIRS = 1 << 18
ROWS = 1 << 17
#: Shingle hashes whose bits are counted at once.
HASHES = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


# -- fingerprints ----------------------------------------------------------

def fingerprints(column, n: int = WORDS) -> np.ndarray:
    """The fingerprint of every text: a bit is 1 if it is set in over half the shingles' hashes; without words 0."""
    raw, off = text_buffers(column)
    out = np.zeros(len(off) - 1, np.uint64)
    for lo, hi in pieces(off):
        base = int(off[lo])
        data = _LOWER[raw[base:int(off[hi])]]
        edges = off[lo:hi + 1] - base
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[edges] = True
        before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        # the words once more, each behind one space, so that a shingle is one run of bytes
        width = ends - starts + 1
        place = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(width, out=place[1:])
        spaced = np.full(int(place[-1]), 0x20, np.uint8)
        inside = np.ones(len(spaced), dtype=bool)
        inside[place[1:] - 1] = False
        spaced[inside] = data[word]
        view = memoryview(spaced)
        bounds = np.searchsorted(starts, edges)
        for d in range(hi - lo):
            a, b = int(bounds[d]), int(bounds[d + 1])
            if b > a:
                m = min(n, b - a)
                out[lo + d] = _majority(view, place[a:b - m + 1], place[a + m:b + 1] - 1)
    return out


def _majority(view: memoryview, start: np.ndarray, end: np.ndarray) -> np.uint64:
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(start), HASHES):
        hashes = np.array([digest(view[a:b], SEED) for a, b in zip(start[at:at + HASHES].tolist(), end[at:at + HASHES].tolist(), strict=True)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(start)).view(">u8")[0]


def _prints(n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def prints(batches):
        for batch in batches:
            fp = fingerprints(batch.column("text"), n).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], schema=schema)
        release()
    return prints


# -- the trie --------------------------------------------------------------

class Trie:
    """Contracted binary tries over sorted distinct keys, one for every run of equal ``groups``.

    Nodes are numbered; node ``i < len(keys)`` is the leaf of key ``i``. ``key``
    is one key below a node, ``known`` how many leading bits all keys below it
    share, ``left`` and ``right`` its children.
    """

    def __init__(self, keys: np.ndarray, starts: np.ndarray):
        n = len(keys)
        lo, hi = starts, np.r_[starts[1:], n]
        self.key, self.known = [keys], [np.full(n, BITS, np.int64)]
        child = [np.full((n, 2), -1, np.int64)]
        self.roots = np.where(hi - lo == 1, lo, -1)
        inner = np.flatnonzero(hi - lo > 1)
        self.roots[inner] = n + np.arange(len(inner))
        lo, hi, count = lo[inner], hi[inner], n
        while len(lo):
            top = _leading_zeros(keys[lo] ^ keys[hi - 1])
            bit = np.uint64(1) << (BITS - 1 - top).astype(np.uint64)
            # the first key of a node with its branching bit set
            mid = _first_with(keys, lo, hi, bit)
            self.key.append(keys[lo])
            self.known.append(top)
            sons = np.empty((len(lo), 2), np.int64)
            count += len(lo)
            nxt_lo, nxt_hi = [], []
            for k, (a, b) in enumerate(((lo, mid), (mid, hi))):
                leaf = b - a == 1
                sons[leaf, k] = a[leaf]
                sons[~leaf, k] = count + sum(map(len, nxt_lo)) + np.arange(int((~leaf).sum()))
                nxt_lo.append(a[~leaf])
                nxt_hi.append(b[~leaf])
            child.append(sons)
            lo, hi = np.concatenate(nxt_lo), np.concatenate(nxt_hi)
        self.key, self.known = np.concatenate(self.key), np.concatenate(self.known)
        self.left, self.right = np.concatenate(child).T
        self.leaves = n

    def self_join(self, errors: int):
        """Pairs of leaves of one trie with at most ``errors`` differing bits, in bounded chunks."""
        stack = [(self.roots, self.roots)]
        while stack:
            a, b = stack.pop()
            if len(a) > PAIRS:
                half = len(a) // 2
                stack += [(a[:half], b[:half]), (a[half:], b[half:])]
                continue
            both = np.minimum(self.known[a], self.known[b])
            hidden = np.where(both > 0, (BITS - both), 0).astype(np.uint64)
            apart = np.where(both > 0, np.bitwise_count((self.key[a] ^ self.key[b]) >> hidden), 0)
            ok = apart <= errors
            a, b = a[ok], b[ok]
            done = (a < self.leaves) & (b < self.leaves)
            pair = done & (a != b)
            if pair.any():
                yield a[pair], b[pair]
            a, b = a[~done], b[~done]
            twin = a == b
            t = a[twin]
            a, b = a[~twin], b[~twin]
            swap = self.known[a] > self.known[b]  # the node of which less is known is opened
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            nxt_a = np.concatenate([self.left[t], self.right[t], self.left[t], self.left[a], self.right[a]])
            nxt_b = np.concatenate([self.left[t], self.right[t], self.right[t], b, b])
            if len(nxt_a):
                stack.append((nxt_a, nxt_b))


def _leading_zeros(x: np.ndarray) -> np.ndarray:
    for s in (1, 2, 4, 8, 16, 32):
        x = x | x >> np.uint64(s)
    return BITS - np.bitwise_count(x).astype(np.int64)


def _first_with(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while (lo < hi).any():
        mid = (lo + hi) // 2
        has = (keys[np.minimum(mid, len(keys) - 1)] & bit) != 0
        open_ = lo < hi
        hi = np.where(open_ & has, mid, hi)
        lo = np.where(open_ & ~has, mid + 1, lo)
    return lo


# -- dealing out -----------------------------------------------------------

def parts(left: int, errors: int = ERRORS) -> list[int]:
    """The bits of ``left`` in ``errors + 1`` masks of nearly equal numbers of bits, from the top."""
    places = [p for p in range(BITS - 1, -1, -1) if left >> p & 1]
    cuts = [len(places) * k // (errors + 1) for k in range(errors + 2)]
    return [sum(1 << p for p in places[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks_of(path: str) -> tuple[int, list[int]]:
    """The bits that are equal in the subtrees of a path (digits: the parts chosen), and the parts before that must differ."""
    left, differ = (1 << BITS) - 1, []
    for digit in path:
        split = parts(left)
        differ += split[:int(digit)]
        left &= ~split[int(digit)]
    return (1 << BITS) - 1 & ~left, differ


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _traverse():
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def join(held: list[pa.RecordBatch], path: str):
        t = pa.Table.from_batches(held)
        fixed, fp, copies = t.column("fixed").to_numpy(), t.column("fp").to_numpy().view(np.uint64), t.column("copies").to_numpy()
        # rows come sorted by subtree; within one, keys go in unsigned order
        group = np.zeros(len(fp), np.int64)
        group[1:] = np.cumsum(fixed[1:] != fixed[:-1])
        order = np.lexsort((fp, group))
        fp, copies, group = fp[order], copies[order], group[order]
        trie = Trie(fp, np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))
        differ = [np.uint64(m) for m in masks_of(path)[1]]
        links, up, out = np.zeros(len(fp), np.int64), np.arange(len(fp)), []
        for a, b in trie.self_join(ERRORS):
            z = fp[a] ^ fp[b]
            ok = np.ones(len(a), dtype=bool)
            for m in differ:
                ok &= (z & m) != 0
            a, b = a[ok], b[ok]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
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
        some = np.flatnonzero(links)
        ids = fp.view(np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([ids[got[:, 0]], ids[some]])),
            pa.concat_arrays([pa.array(ids[got[:, 1]]), pa.nulls(len(some), pa.int64())]),
            pa.array(np.concatenate([np.zeros(len(got), np.int64), links[some]]))], schema=schema)

    def traverse(batches):
        """Subtrees come sorted by path and fixed bits; whole subtrees are gathered to about ``ROWS`` rows."""
        held, size, path, last = [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            p, f = batch.column("path").to_pylist(), batch.column("fixed").to_numpy()
            cuts = [0, *(i for i in range(1, len(p)) if p[i] != p[i - 1] or f[i] != f[i - 1]), len(p)]
            lo = 0
            for i in cuts[:-1]:
                if (p[i] != path) or (size + i - lo >= ROWS and f[i] != last):
                    if i > lo:
                        held.append(batch.slice(lo, i - lo))
                    if held:
                        yield from join(held, path)
                    held, size, lo = [], 0, i
                path, last = p[i], f[i]
            held.append(batch.slice(lo))
            size += batch.num_rows - lo
        if held:
            yield from join(held, path)
        release()
    return traverse


def _deal(leaves: DataFrame) -> DataFrame:
    """``path, fixed, fp, copies``: every fingerprint in all subtrees it is joined in."""
    rows, paths, dealt = leaves.select(F.lit("").alias("path"), "fp", "copies"), [""], None
    while True:
        masks = F.create_map(*(F.lit(x) for p in paths for d in range(ERRORS + 1) for x in (f"{p}{d}", _signed(masks_of(f"{p}{d}")[0]))))
        spread = (rows.select("path", "fp", "copies", F.explode(F.array(*(F.lit(str(d)) for d in range(ERRORS + 1)))).alias("digit"))
                  .select(F.concat("path", "digit").alias("path"), "fp", "copies")
                  .select("path", F.col("fp").bitwiseAND(F.element_at(masks, F.col("path"))).alias("fixed"), "fp", "copies"))
        large = materialize(spread.groupBy("path", "fixed").agg(F.count("*").alias("m")).filter(F.col("m") > LARGE).select("path", "fixed"), "simhash-large")
        paths = [r["path"] for r in large.select("path").distinct().collect()]  # at most four times those of the level before
        small = spread.join(large, ["path", "fixed"], "left_anti") if paths else spread
        dealt = small if dealt is None else dealt.unionByName(small)
        if not paths:
            return dealt
        rows = materialize(spread.join(large, ["path", "fixed"], "left_semi").select("path", "fp", "copies"), "simhash-dealt")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """``doc_id, fp, n_links, component`` of every row; ``fp`` is the fingerprint as a signed long.

    Two rows link when their fingerprints differ in at most ``ERRORS`` bits;
    ``n_links`` counts all rows a row links with, its copies included.
    ``component`` is the smallest id that links reach, the row's own included.
    Texts are lower-cased (A-Z) and cut into words at white space; of fewer than
    ``n`` words the whole sequence is the one shingle. Null texts are empty and,
    like all texts without words, have fingerprint 0. Ids must be whole numbers
    or null; they may repeat, each row counts for itself, and a component without
    any id has a null one. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    prints = materialize(texts.mapInArrow(_prints(n), "doc_id long, fp long"), "simhash-prints")
    leaves = materialize(prints.groupBy("fp").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")), "simhash-leaves")
    dealt = _deal(leaves).repartition("path", "fixed").sortWithinPartitions("path", "fixed")
    links = materialize(dealt.mapInArrow(_traverse(), "a long, b long, n long"), "simhash-links")
    roots = components(links.filter("b is not null").select("a", "b"))
    far = links.filter("b is null").groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("far"))
    rooted = leaves.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "copies", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted.join(far, "fp", "left").filter("copies > 1 or far > 0"), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = materialize(rooted.join(least, "root").select("fp", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), "component"), "simhash-known")
    out = prints.join(known, "fp", "left")
    alone = F.col("n_links").isNull()
    return out.select("doc_id", "fp", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component"))
