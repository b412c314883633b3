"""Phrase collocations by weighted acyclic automata.

A phrase of several words is scored by how much oftener its parts meet than
their own counts would let expect; the counts come from automata whose paths
are word windows and whose weights are counts:

* Shards of text are cut into words once. Words that fall below the count are
  barriers, since no phrase with one of them can reach it; the others get
  global numbers.
* Every shard sorts its windows of up to ``MAX_WORDS`` words (one per start)
  and builds a count transducer from them: shared prefixes are one path
  (front coding), equal unbranched suffixes with equal weights are one chain.
* The transducers are cut at common prefix bounds into ranges and within them
  into pieces; a range's pieces come sorted, and a sweep unions them, adding
  weights. The weight of a prefix is the sum below it, so one window per word
  counts the phrases of all lengths. A sweep holds ``SWEEP`` windows about,
  however many shards or rows meet in a range.
* The counts that remain form a transducer per range, with which the parts of
  all candidates are composed; ranges asked very often are given several
  copies.

Counts, parts and scores are exact at every size. Only the place of the range
bounds, which decides nothing but the balance, comes from a bounded sample.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from .common import bounded_batches, materialize, pieces, release, text_buffers

MIN_COUNT = 100
MAX_WORDS = 5
PER_LANG = 2000
#: Bytes of text in a shard, about, and in all shards that a task holds.
SHARD_BYTES = 16 << 20
HELD_BYTES = 32 << 20
#: Windows that a sweep holds, about.
SWEEP = 1 << 19
#: Windows for which one prefix range is made, and most ranges.
RANGE_WINDOWS = 1 << 19
MAX_RANGES = 4096
#: Windows that the bounds of the ranges are chosen from, of each shard and at most.
SHARD_SAMPLE = 256
CUT_SAMPLE = 65_536
#: Lookups that one copy of a range's transducer answers, about.
LOOKUPS = 1 << 19

#: Bytes that end a piece, bytes that part words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b"\x20\x09"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(WORD_ENDS)] = 1
_KIND[list(PIECE_ENDS)] = 2


# -- words of shards -------------------------------------------------------

def split_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of texts, and for each whether a piece begins with it."""
    base, end = int(offsets[0]), int(offsets[-1])
    data = _LOWER[raw[base:end]]
    off = offsets - base
    kind = _KIND[data]
    word = kind == 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    piece = np.cumsum((kind == 2).astype(np.int64))[starts] + np.searchsorted(off, starts, side="right")
    first = np.ones(len(starts), dtype=bool)
    first[1:] = piece[1:] != piece[:-1]
    places = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=places[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[word])))
    return words, first


def _shard(words: list[pa.Array], firsts: list[np.ndarray]):
    """Dictionary, counts and tokens of a shard; token 0 stands between pieces."""
    coded = pa.chunked_array(words).dictionary_encode().combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate(firsts)
    counts = np.bincount(index, minlength=len(coded.dictionary))
    at = np.arange(len(index)) + np.cumsum(first)
    tokens = np.zeros(len(index) + int(first.sum()) + 1, np.int32)
    tokens[at] = index + 1
    return coded.dictionary, counts, tokens


_SHARD_TYPE = "shard long, lang string, words array<string>, counts array<long>, tokens binary"
_SHARD_SCHEMA = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
                           ("counts", pa.list_(pa.int64())), ("tokens", pa.binary())])


def _shards(batches):
    number = TaskContext.get().partitionId() << 32
    held: dict[str, tuple[list, list]] = {}
    size: dict[str, int] = {}

    def flush(lang):
        nonlocal number
        dictionary, counts, tokens = _shard(*held.pop(lang))
        del size[lang]
        number += 1
        yield pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([lang]),
            pa.ListArray.from_arrays(pa.array([0, len(dictionary)], pa.int32()), dictionary.cast(pa.string())),
            pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int64())),
            pa.array([tokens.tobytes()], pa.binary())], schema=_SHARD_SCHEMA)

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        index = langs.indices.to_numpy(zero_copy_only=False)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            raw, off = text_buffers(batch.filter(pa.array(index == k)).column("text"))
            for lo, hi in pieces(off):
                words, first = split_words(raw, off[lo:hi + 1])
                if len(words):
                    mine = held.setdefault(lang, ([], []))
                    mine[0].append(words)
                    mine[1].append(first)
                    size[lang] = size.get(lang, 0) + int(off[hi] - off[lo])
                    if size[lang] >= SHARD_BYTES:
                        yield from flush(lang)
                    while sum(size.values()) >= HELD_BYTES:
                        yield from flush(max(size, key=size.get))
    for lang in sorted(held):
        yield from flush(lang)
    release()


# -- transducers -----------------------------------------------------------

def sort_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a matrix of numbers >= 0, and where, in that order, a new row begins."""
    cols = [rows[:, k] for k in range(rows.shape[1])]
    if int(rows.max(initial=0)) < 1 << 31:
        cols = [cols[k].astype(np.int64) << 32 | cols[k + 1] if k + 1 < len(cols) else cols[k] for k in range(0, len(cols), 2)]
    order = np.lexsort(cols[::-1])
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for c in cols:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


def sum_windows(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows in order, and the sums of their weights."""
    order, new = sort_rows(rows)
    first = np.flatnonzero(new)
    return rows[order[first]], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


def windows_of(numbers: np.ndarray, width: int) -> np.ndarray:
    """Windows of at least two words from every start; a number of 0 ends them, unused places are 0."""
    n = len(numbers)
    padded = np.concatenate([numbers, np.zeros(width, numbers.dtype)])
    start = np.flatnonzero((padded[:n] > 0) & (padded[1:n + 1] > 0))
    rows = np.zeros((len(start), width), numbers.dtype)
    alive = np.ones(len(start), dtype=bool)
    for k in range(width):
        w = padded[start + k]
        alive &= w > 0
        rows[:, k] = np.where(alive, w, 0)
    return rows


def build(rows: np.ndarray, weights: np.ndarray) -> bytes:
    """A count transducer of sorted distinct windows.

    A window leaves the path of the one before it after the words both share.
    What it adds ends in a final state for its weight; going back from there,
    equal (word, next state) are one state for all windows.
    """
    m, width = rows.shape
    same = np.zeros((m, width), dtype=bool)
    same[1:] = rows[1:] == rows[:-1]
    shared = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    length = (rows > 0).sum(axis=1)
    loads, state = np.unique(weights, return_inverse=True)
    words, targets, count = [], [], len(loads)
    for back in range(1, width + 1):
        at = np.flatnonzero(length - shared >= back)
        arcs = np.column_stack([state[at], rows[at, length[at] - back]])
        order, new = sort_rows(arcs)
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(new) - 1
        state[at] = count + number
        count += int(new.sum())
        targets.append(arcs[order[new], 0])
        words.append(arcs[order[new], 1])
    parts = [shared, state, np.concatenate(words), np.concatenate(targets), loads]
    planes = [_planes(p) for p in parts]
    head = np.array([width, *(x for p, (_, size) in zip(parts, planes, strict=True) for x in (len(p), size))], np.int64)
    return b"".join([head.tobytes(), *(p for p, _ in planes)])


def _kind(top: int):
    return np.int32 if top < 1 << 31 else np.int64


def _planes(a: np.ndarray) -> tuple[bytes, int]:
    """Numbers >= 0 as their lowest bytes, then the next, as many as the greatest needs; like bytes lie together and compress."""
    size = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(a.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes(), size


def paths(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a transducer and their weights."""
    head = np.frombuffer(blob, np.int64, 11)
    width, at, parts = int(head[0]), 88, []
    for n, size in head[1:].reshape(-1, 2).tolist():
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :size] = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n).T
        parts.append(whole.view("<i8").ravel())
        at += n * size
    shared, state, words, targets, loads = parts
    m, finals = len(shared), len(loads)
    words = words.astype(_kind(int(words.max(initial=0))))
    chain = np.zeros((m, width), words.dtype)
    for k in range(width):
        on = np.flatnonzero(state >= finals)
        arc = state[on] - finals
        chain[on, k] = words[arc]
        state[on] = targets[arc]
    rows = np.zeros((m, width), words.dtype)
    for k in range(width):
        own = np.maximum.accumulate(np.where(shared <= k, np.arange(m), 0))  # the window that last set word k
        rows[:, k] = chain[own, k - shared[own]]
    return rows, loads[state]


class Transducer:
    """Counts of phrases by a walk of arcs: (state, word) to the next state, in steps of one word."""

    def __init__(self, rows: np.ndarray, weights: np.ndarray):
        self.levels, state = [], np.zeros(len(rows), np.int64)
        for k in range(rows.shape[1]):
            live = rows[:, k] > 0
            arcs = np.zeros((int(live.sum()), 2), np.int64)
            arcs[:, 0], arcs[:, 1] = state[live], rows[live, k]
            order, new = sort_rows(arcs)
            to = np.empty(len(arcs), np.int64)
            to[order] = np.cumsum(new) - 1
            load = np.full(int(new.sum()), -1, np.int64)
            state = np.where(live, -1, state)
            state[live] = to
            ends = live & (rows[:, k + 1] == 0 if k + 1 < rows.shape[1] else True)
            load[state[ends]] = weights[ends]
            self.levels.append((arcs[order[new]], load))

    def compose(self, rows: np.ndarray) -> np.ndarray:
        """The weight of every row's phrase, -1 where there is none."""
        out = np.full(len(rows), -1, np.int64)
        state = np.zeros(len(rows), np.int64)
        alive = np.ones(len(rows), dtype=bool)
        for k, (arcs, load) in enumerate(self.levels):
            alive &= rows[:, k] > 0
            if not len(arcs) or not alive.any():
                break
            ask = np.flatnonzero(alive)
            lo = np.searchsorted(arcs[:, 0], state[ask], side="left")
            hi = np.searchsorted(arcs[:, 0], state[ask], side="right")
            word = rows[ask, k]
            while True:  # the arcs of a state are sorted by word
                open_ = lo < hi
                if not open_.any():
                    break
                mid = (lo + hi) // 2
                less = open_ & (arcs[np.minimum(mid, len(arcs) - 1), 1] < word)
                lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
            at = np.minimum(lo, len(arcs) - 1)
            found = (arcs[at, 0] == state[ask]) & (arcs[at, 1] == word)
            alive[ask[~found]] = False
            state[ask] = at
            last = ask[found & (rows[ask, k + 1] == 0 if k + 1 < rows.shape[1] else True)]
            out[last] = load[state[last]]
        return out


def _place_of(rows: np.ndarray, key: np.ndarray) -> int:
    """The first of sorted windows that is not below ``key``."""
    return bisect.bisect_left(range(len(rows)), key.tolist(), key=lambda i: rows[i].tolist())


def as_keys(rows: np.ndarray) -> np.ndarray:
    """Windows as byte strings in the same order (eight bytes a word)."""
    return np.ascontiguousarray(rows.astype(">i8")).view(f"S{8 * rows.shape[1]}").ravel()


def as_rows(keys: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">i8").reshape(-1, width).astype(np.int64)


def key_bytes(rows: np.ndarray) -> pa.Array:
    width = 8 * rows.shape[1]
    data = np.ascontiguousarray(rows.astype(">i8"))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(data)])


# -- counting --------------------------------------------------------------

_BUILT = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("sample", pa.list_(pa.binary())), ("machine", pa.binary())])


def _build_shard(width: int, frequent: int):
    def make(shards: pa.Table, numbers: pa.Table) -> pa.Table:
        out = []
        for shard, tokens in zip(shards.column("shard").to_pylist(), shards.column("tokens").to_pylist(), strict=True):
            tokens = np.frombuffer(tokens, np.int32)
            number = np.zeros(int(tokens.max()) + 1 if len(tokens) else 1, np.int64)
            number[numbers.column("pos").to_numpy() + 1] = numbers.column("number").to_numpy()
            number[number > frequent] = 0
            number = number.astype(_kind(frequent))
            rows = windows_of(number[tokens], width)
            rows, weights = sum_windows(rows, np.ones(len(rows), np.int64))
            if len(rows):
                step = np.unique(np.linspace(0, len(rows) - 1, SHARD_SAMPLE).astype(np.int64))
                out.append((shard, len(rows), key_bytes(rows[step]).to_pylist(), build(rows, weights)))
        release()
        return pa.table({f.name: pa.array([r[i] for r in out], f.type) for i, f in enumerate(_BUILT)}, schema=_BUILT)
    return make


def _cut(bounds: bytes, width: int, piece: int):
    """Transducers cut at the bounds of the ranges, and into pieces of at most ``piece`` windows."""
    schema = pa.schema([("range", pa.int32()), ("first", pa.binary()), ("machine", pa.binary())])

    def cut(batches):
        marks = np.frombuffer(bounds, np.int64).reshape(-1, width)
        for batch in batches:
            for blob in batch.column("machine").to_pylist():
                rows, weights = paths(blob)
                at = [0, *(_place_of(rows, m) for m in marks), len(rows)]
                out = []
                for r in range(len(at) - 1):
                    for lo in range(at[r], at[r + 1], piece):
                        hi = min(lo + piece, at[r + 1])
                        out.append((r, rows[lo:lo + 1].astype(">i8").tobytes(), build(rows[lo:hi], weights[lo:hi])))
                for lo in range(0, len(out), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out[lo:lo + 4096]], f.type) for i, f in enumerate(schema)], schema=schema)
        release()
    return cut


def prefix_counts(rows: np.ndarray, weights: np.ndarray, least: int):
    """Prefixes of two words and more with their sums: those that reach ``least``, and those at the edges, which may go on elsewhere."""
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for k in range(rows.shape[1]):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        if k == 0:
            continue
        first = np.flatnonzero(new)
        total = np.add.reduceat(weights, first)
        keep = total >= least
        keep[[0, -1]] = True
        keep &= rows[first, k] > 0
        out = rows[first[keep]].copy()
        out[:, k + 1:] = 0
        yield out, total[keep]


def _sweep(width: int, least: int):
    schema = pa.schema([("phrase", pa.binary()), ("f", pa.int64())])

    def emit(rows, weights):
        for phrases, total in prefix_counts(rows, weights, least):
            if len(phrases):
                yield pa.RecordBatch.from_arrays([key_bytes(phrases), pa.array(total)], schema=schema)

    def union(batches):
        held, size, now = [], 0, None
        for batch in batches:
            for r, first, blob in zip(batch.column("range").to_pylist(), batch.column("first").to_pylist(), batch.column("machine").to_pylist(), strict=True):
                if held and (r != now or size >= SWEEP):
                    rows, weights = sum_windows(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    done = len(rows) if r != now else _place_of(rows, as_rows([first], width)[0])
                    if done:  # no later piece reaches below its first window
                        yield from emit(rows[:done], weights[:done])
                    held = [(rows[done:], weights[done:])] if done < len(rows) else []
                    size = 0
                now = r
                held.append(paths(blob))
                size += len(held[-1][0])
        if held:
            yield from emit(*sum_windows(*(np.concatenate(x) for x in zip(*held, strict=True))))
        release()
    return union


# -- part lookups ----------------------------------------------------------

_ASK_TYPE = "range int, part binary, phrase binary, cut int, rest boolean"


def _ask(bounds: bytes, width: int):
    """Both parts of every cut of every candidate, with the range that knows them."""
    schema = pa.schema([("range", pa.int32()), ("part", pa.binary()), ("phrase", pa.binary()), ("cut", pa.int32()), ("rest", pa.bool_())])

    def ask(batches):
        marks = as_keys(np.frombuffer(bounds, np.int64).reshape(-1, width))
        for batch in batches:
            rows = as_rows(batch.column("phrase").to_pylist(), width)
            for k in range(1, width):
                whole = rows[rows[:, k] > 0]
                head, rest = whole.copy(), np.zeros_like(whole)
                head[:, k:] = 0
                rest[:, :width - k] = whole[:, k:]
                for side, part in ((False, head), (True, rest)):
                    if len(part):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.searchsorted(marks, as_keys(part), side="right").astype(np.int32)), key_bytes(part), key_bytes(whole),
                            pa.array(np.full(len(part), k, np.int32)), pa.array(np.full(len(part), side))], schema=schema)
    return ask


def _place(bounds: bytes, width: int):
    def place(batches):
        marks = as_keys(np.frombuffer(bounds, np.int64).reshape(-1, width))
        for batch in batches:
            keys = as_keys(as_rows(batch.column("part").to_pylist(), width)) if batch.num_rows else np.empty(0, "S8")
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(marks, keys, side="right").astype(np.int32)), *batch.columns],
                                             names=["range", *batch.schema.names])
    return place


def _compose(width: int):
    schema = pa.schema([("phrase", pa.binary()), ("cut", pa.int32()), ("rest", pa.bool_()), ("f", pa.int64())])

    def compose(counts: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not counts.num_rows:
            return schema.empty_table()
        machine = Transducer(as_rows(counts.column("part").to_pylist(), width), counts.column("f").to_numpy())
        f = machine.compose(as_rows(asked.column("part").to_pylist(), width))
        out = asked.select(["phrase", "cut", "rest"]).append_column("f", pa.array(f))
        return out.cast(schema)
    return compose


def _bounds(built: DataFrame, ranges: int, width: int) -> bytes:
    """At most ``ranges - 1`` windows that part the sample into even ranges."""
    rows = (built.select("shard", F.explode("sample").alias("key")).orderBy(F.xxhash64("key", "shard"), "key").limit(CUT_SAMPLE)
            .select("key").collect())
    keys = sorted(bytes(r[0]) for r in rows)
    cuts = sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []
    return as_rows(cuts, width).tobytes() if cuts else b""


def _number(frame: DataFrame) -> DataFrame:
    """Rows numbered from 1 in their order, without gaps; the driver sees one count per part file."""
    marked = materialize(frame.withColumn("mark", F.monotonically_increasing_id()), "phrase-words")
    part = F.shiftright("mark", 33)
    sizes = {r["p"]: r["n"] for r in marked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    start, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        start.append(total)
        total += sizes.get(p, 0)
    before = F.element_at(F.array(*map(F.lit, start or [0])).cast("array<long>"), part.cast("int") + 1)
    return marked.withColumn("number", before + F.col("mark").bitwiseAND((1 << 33) - 1) + 1).drop("mark")


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT,
                  width: int = MAX_WORDS) -> tuple[DataFrame, DataFrame, bytes]:
    """Frequent words, frequent phrases and the bounds of the prefix ranges.

    The first frame has ``number, lang, word, f, n`` for every word that occurs
    at least ``least`` times in a language (``n``: all words of the language),
    the second ``phrase, f`` for every phrase of 2 to ``width`` words that
    does, as word numbers of eight bytes each.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shards = materialize(texts.mapInArrow(_shards, _SHARD_TYPE), "phrase-shards")
    listed = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w"))
    totals = materialize(listed.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")), "phrase-totals", clean=True)
    sums = materialize(totals.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-sums")
    numbered = _number(totals.orderBy(F.desc("f"), "lang", "word"))  # common words have small numbers
    frequent = numbered.filter(F.col("f") >= least).agg(F.max("number")).first()[0] or 0
    words = numbered.filter(F.col("number") <= frequent).join(sums, "lang")
    numbers = (listed.select("shard", "pos", "lang", F.col("w.words").alias("word")).join(numbered.select("lang", "word", "number"), ["lang", "word"])
               .select(F.col("shard").alias("home"), "pos", "number"))
    built = materialize(shards.select("shard", "tokens").groupBy("shard").cogroup(numbers.groupBy("home"))
                        .applyInArrow(_build_shard(width, frequent), "shard long, n long, sample array<binary>, machine binary"), "phrase-machines", clean=True)
    size = built.agg(F.count("*").alias("shards"), F.sum("n").alias("windows")).first()
    ranges = min(MAX_RANGES, max(16, (size["windows"] or 0) // RANGE_WINDOWS))
    bounds = _bounds(built, ranges, width)
    piece = max(1, SWEEP // max(1, size["shards"]))
    cells = built.select("machine").mapInArrow(_cut(bounds, width, piece), "range int, first binary, machine binary")
    swept = (cells.repartition("range").sortWithinPartitions("range", "first")
             .mapInArrow(_sweep(width, least), "phrase binary, f long"))
    found = materialize(swept.groupBy("phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrase-counts", clean=True)
    return words, found, bounds


def look_up_parts(words: DataFrame, found: DataFrame, bounds: bytes, width: int = MAX_WORDS) -> DataFrame:
    """``phrase, cut, rest, f`` for both parts of every cut of every phrase."""
    asked = materialize(found.select("phrase").mapInArrow(_ask(bounds, width), _ASK_TYPE), "phrase-asked")
    copies = {r["range"]: -(-r["n"] // LOOKUPS) for r in asked.groupBy("range").agg(F.count("*").alias("n")).collect()}
    many_list = F.array(*(F.lit(copies.get(r, 1)) for r in range(len(bounds) // (8 * width) + 1))).cast("array<int>")
    many = F.element_at(many_list, F.col("range") + 1)
    pad = F.expr(f"rpad(unhex(lpad(hex(number), 16, '0')), {8 * width}, x'00')")
    counts = (words.select(pad.alias("part"), "f").unionByName(found.select(F.col("phrase").alias("part"), "f"))
              .mapInArrow(_place(bounds, width), "range int, part binary, f long")
              .select("range", F.explode(F.sequence(F.lit(0), many - 1)).alias("copy"), "part", "f"))
    asked = asked.select(F.col("range").alias("asked"), F.pmod(F.xxhash64("phrase"), F.element_at(many_list, F.col("range") + 1)).cast("int").alias("which"),
                         "part", "phrase", "cut", "rest")
    return (counts.groupBy("range", "copy").cogroup(asked.groupBy("asked", "which"))
            .applyInArrow(_compose(width), "phrase binary, cut int, rest boolean, f long"))


_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, width: int = MAX_WORDS,
                 per_lang: int = PER_LANG) -> DataFrame:
    """The first ``per_lang`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and
    into words at spaces and tabs. ``a`` is the count of the phrase, ``l`` and
    ``r`` those of its two parts at the cut with the lowest score ``floor(1000
    a n / (l r))`` (ties: the shortest first part). A phrase inside a longer
    one that occurs as often is left out. Order: score and ``a`` descending,
    phrase ascending by bytes. Null texts are empty, a null language is
    ``und``; repeated rows count each time; without phrases the result is empty.
    """
    spark = docs.sparkSession
    words, found, bounds = count_phrases(docs, text_col, lang_col, least, width)
    if found.isEmpty():
        return spark.createDataFrame([], _RESULT)
    parts = look_up_parts(words, found, bounds, width)
    sides = [F.max(F.when((F.col("cut") == k) & (F.col("rest") == rest), F.col("f"))).alias(f"{'r' if rest else 'l'}{k}")
             for k in range(1, width) for rest in (False, True)]
    whole = parts.groupBy("phrase").agg(*sides, F.max("cut").alias("m")).join(found.withColumnRenamed("f", "a"), "phrase")
    whole = whole.withColumn("first_number", F.conv(F.hex(F.substring("phrase", 1, 8)), 16, 10).cast("long"))
    whole = materialize(whole, "phrase-parts")
    size = 8 * width
    head = F.expr(f"rpad(substring(phrase, 1, 8 * m), {size}, x'00')")
    tail = F.expr(f"rpad(substring(phrase, 9), {size}, x'00')")
    last_l = F.coalesce(*(F.when(F.col("m") == k, F.col(f"l{k}")) for k in range(1, width)))
    inside = (whole.filter((F.col("m") > 1) & (last_l == F.col("a"))).select(head.alias("phrase"))
              .unionAll(whole.filter((F.col("m") > 1) & (F.col("r1") == F.col("a"))).select(tail.alias("phrase"))).distinct())
    known = words.select(F.col("number").alias("first_number"), "lang", "n")
    scored = whole.join(inside, "phrase", "left_anti").join(known, "first_number")

    def cut(k: int):
        product = f"(cast(l{k} as decimal(19,0)) * cast(r{k} as decimal(19,0)))"
        score = f"(cast(a as decimal(19,0)) * cast(1000 as decimal(4,0)) * cast(n as decimal(19,0))) div {product}"
        return f"if(l{k} is null, null, struct({score} as score, {k} as k, l{k} as l, r{k} as r))"

    best = F.expr(f"array_min(filter(array({', '.join(cut(k) for k in range(1, width))}), x -> x is not null))")
    scored = scored.select("phrase", "lang", "n", "a", best.alias("best")).select("phrase", "lang", "n", "a", "best.score", "best.l", "best.r")
    order = [F.desc("score"), F.desc("a")]
    # a phrase within the first per_lang of all is within them in its part, too
    top = (scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
           .withColumn("place", F.rank().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= per_lang)
           .withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= per_lang))
    top = materialize(top.drop("part", "place"), "phrase-top")
    spelled = (top.select("phrase", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("j"))
               .withColumn("number", F.conv(F.hex(F.expr("substring(phrase, 8 * j + 1, 8)")), 16, 10).cast("long")).filter("number > 0")
               .join(words.select("number", "word"), "number")
               .groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("j", "word"))).alias("w"))
               .select("phrase", F.concat_ws(" ", "w.word").alias("text")))
    out = (top.join(spelled, "phrase")
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.asc("text"))).cast("long"))
           .filter(F.col("rank") <= per_lang))
    return out.select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
