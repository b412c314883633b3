"""Code lengths by prediction by partial matching over a pretrained byte-context trie.

A text is its words, lower-cased (A-Z), each followed by one space, and an end
symbol; it is coded byte by byte as it runs, across spaces, behind one space.
A byte is predicted from the trie node of its longest context (up to ``ORDER``
bytes back). A node that has not seen the byte escapes to the next shorter
context; the escape probability is estimated by the number of different bytes
the node has seen (method C), and bytes seen in the longer context are excluded
in the shorter one, since they would have been coded there. Below the empty
context stand all remaining byte values alike.

The trie is trained on all training rows and never gathered in one place:

1. Documents are packed into units of bounded bytes. Each unit counts its
   (context, byte) grams: training rows count, the others only ask.
2. The grams go to the task that holds the subtree of the context's last three
   bytes. There, the nodes' totals, their distinct bytes and what exclusion
   takes away are counted, and every gram gets its code length. Only the counts
   for contexts of two bytes and less (at most 256 ** 3 numbers, whatever the
   corpus) are sent to every task.
3. Code lengths go back to the units in the order in which these asked, and
   documents add them up.

The smoothed word counts beside it take the same way: units send their distinct
words to buckets of the vocabulary and get the training counts back.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import bounded_batches, from_planes, materialize, mix64, release, runs, to_planes, word_hashes

#: Bytes of the longest context; a gram and its length fit in 64 bits.
ORDER = 6
#: Context bytes whose counts every task has.
SHORT = 2
_SYMBOLS = 256
#: Bytes of text and rows in a unit, about (a longer text is a unit alone).
UNIT_BYTES = 8 << 20
UNIT_ROWS = 1 << 16
#: Bytes of text for which a bucket of the vocabulary and a part of the subtrees are made.
VOCABULARY_BYTES = 64 << 20
SUBTREE_BYTES = 8 << 20
#: Steps of a code length of 1 (log10).
STEPS = float(1 << 18)

#: Bytes of a unit that are cut into words or gram windows at a time. Of a whole unit a task holds its text, one number of 64 bits a byte and its distinct grams and words.
CHUNK = 1 << 19

_UNIT_TYPE = "unit long, bytes long, learned int, doc_ids array<long>, sizes binary, words binary, data binary"
_WORDS = pa.schema([("bucket", pa.int32()), ("unit", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
_WORDS_TYPE = "bucket int, unit long, words binary, counts binary"
_GRAMS = pa.schema([("subtree", pa.int32()), ("unit", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_GRAMS_TYPE = "subtree int, unit long, keys binary, counts binary"
_ANSWER = "unit long, subtree int, words binary, found binary"


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, without the end."""
    return text.encode().lower().split()


def held_out(doc_id: int | None, fold: int = 2, folds: int = 7) -> bool:
    """Whether a row is kept from learning; rows without an id are learned from."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def running(words: list[bytes]) -> bytes:
    """The bytes that are coded, behind the space that is given."""
    return b" ".join([b"", *words, b"\n"])


#: What stands between two texts of a unit; nothing of it is coded or context.
_GAP = b" " * ORDER


@dataclass(frozen=True)
class Unit:
    """Running texts in one piece (compressed in its row), those to learn from first, each behind a gap; with their sizes and numbers of words."""

    unit: int
    doc_ids: list[int | None]
    learned: int
    sizes: np.ndarray
    words: np.ndarray
    data: bytes

    def learned_bytes(self) -> int:
        return int(self.sizes[:self.learned].sum()) + len(_GAP) * self.learned


def _units(batches):
    """Rows packed into units; a unit is one row, so all passes see it alike."""
    number = TaskContext.get().partitionId() << 32
    held: list[tuple[bool, int | None, int, bytes]] = []
    size = 0

    def unit():
        nonlocal number
        number += 1
        rows = sorted(held, key=lambda r: r[0])  # stable
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([size]), pa.array([sum(not r[0] for r in rows)], pa.int32()), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
            pa.array([np.array([len(r[3]) for r in rows], np.int64).tobytes()], pa.binary()), pa.array([np.array([r[2] for r in rows], np.int32).tobytes()], pa.binary()),
            pa.array([pa.compress(_GAP.join([b"", *(r[3] for r in rows)]), codec="zstd", asbytes=True)], pa.binary())],
            names=["unit", "bytes", "learned", "doc_ids", "sizes", "words", "data"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ws = tokens(text)
            raw = running(ws)
            if held and (size + len(raw) > UNIT_BYTES or len(held) == UNIT_ROWS):
                yield unit()
                held, size = [], 0
            held.append((held_out(doc_id), doc_id, len(ws), raw))
            size += len(raw)
    if held:
        yield unit()


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            unit, ids, learned, sizes, words, data = (batch.column(c)[i] for c in ("unit", "doc_ids", "learned", "sizes", "words", "data"))
            sizes = np.frombuffer(sizes.as_py(), np.int64)
            yield Unit(unit.as_py(), ids.as_py(), learned.as_py(), sizes, np.frombuffer(words.as_py(), np.int32),
                       pa.decompress(data.as_buffer(), int(sizes.sum()) + len(_GAP) * len(sizes), codec="zstd", asbytes=True))


def _owners(ends: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The text of each of the items ``lo`` to ``hi``; ``ends``: items up to the end of each text."""
    return np.repeat(np.arange(len(ends)), np.diff(np.clip(ends, lo, hi), prepend=lo))


# -- words -----------------------------------------------------------------

def _spans(data: bytes, lo: int, hi: int):
    """Bounds of pieces of whole words, of about ``CHUNK`` bytes each."""
    while lo < hi:
        at = data.find(b" ", lo + CHUNK, hi)
        at = hi if at < 0 else at
        yield lo, at
        lo = at


def _word_pieces(data: bytes, lo: int, hi: int):
    """The words from ``lo`` to ``hi`` in lists."""
    return (data[a:b].split() for a, b in _spans(data, lo, hi))


def _buckets(words: list[bytes], bits: int) -> np.ndarray:
    out = np.empty(len(words), np.int64)
    done = 0
    joined = b" ".join(words)
    for lo, hi in _spans(joined, 0, len(joined)):
        h, _ = word_hashes(np.frombuffer(joined, np.uint8), np.array([lo, hi]))
        out[done:done + len(h)] = h >> np.uint64(64 - bits)
        done += len(h)
    return out


def _unit_words(u: Unit, bits: int) -> pa.RecordBatch:
    cut = u.learned_bytes()
    seen: Counter = Counter()
    for piece in _word_pieces(u.data, 0, cut):
        seen.update(piece)
    words = list(set(seen).union(*_word_pieces(u.data, cut, len(u.data))))
    bucket = _buckets(words, bits)
    order = np.argsort(bucket, kind="stable")
    counts = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    rows = []
    for a, b in runs(bucket[order]):
        at = order[a:b]
        rows.append({"bucket": int(bucket[at[0]]), "unit": u.unit, "words": b" ".join([words[i] for i in at.tolist()]),
                     "counts": to_planes(counts[at])})
    return pa.RecordBatch.from_pylist(rows, schema=_WORDS)


def _send_words(bits: int):
    def send(batches):
        for u in _rows(batches):
            yield _unit_words(u, bits)
        release()
    return send


def _answer_words(table: pa.Table) -> pa.Table:
    """For each unit its words of this bucket with their training counts, and, once, what the bucket adds to the totals."""
    total: Counter = Counter()
    for words, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
        for w, c in zip(words.split(b" "), from_planes(counts).tolist(), strict=True):
            total[w] += c
    found = [to_planes(np.fromiter(map(total.__getitem__, words.split(b" ")), np.uint64)) for words in table.column("words").to_pylist()]
    n, known = sum(total.values()), sum(c > 0 for c in total.values())
    once = [0] * (len(found) - 1)
    return pa.table({"unit": table.column("unit"), "words": table.column("words"), "found": pa.array(found, pa.binary()),
                     "n": pa.array([n, *once], pa.int64()), "known": pa.array([known, *once], pa.int64())})


# -- grams -----------------------------------------------------------------

def _lengths(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(56)).astype(np.int64)


def _at_order(key: np.ndarray, k: int) -> np.ndarray:
    """Context of ``k`` bytes and the byte."""
    return key & np.uint64((1 << (8 * (k + 1))) - 1)


def _subtree(key: np.ndarray, bits: int) -> np.ndarray:
    three = (key >> np.uint64(8)) & np.uint64((1 << 8 * (SHORT + 1)) - 1)
    return (mix64(three + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64)


class Grams:
    """Every coded byte of running texts with its context, as one number.

    The bytes that occur are numbered from 1; 0 stands before a text. So a gram
    takes ``ORDER + 1`` times ``bits`` bits, and grams sort as numbers. The first
    byte of a text is given, all others are coded; ``ends`` are the coded bytes up
    to the end of each text.
    """

    def __init__(self, data: bytes, sizes: np.ndarray):
        raw = np.frombuffer(data, np.uint8)
        start = np.cumsum(sizes + ORDER) - sizes
        self.alphabet = np.flatnonzero(sum(np.bincount(raw[lo:lo + CHUNK], minlength=_SYMBOLS) for lo in range(0, len(raw), CHUNK)))
        self.bits = len(self.alphabet).bit_length()
        number = np.zeros(_SYMBOLS, np.uint8)  # UTF-8 has no 0xFF, so there are at most 255
        number[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        self.code = np.frombuffer(bytearray(data).translate(number.tobytes()), np.uint8)
        gap = (start[:, None] - 1 - np.arange(ORDER)[None, :]).ravel()
        self.code[gap] = 0
        self.coded = self.code > 0
        self.coded[start] = False
        self.ends = np.cumsum(sizes - 1)

    def chunks(self):
        """The grams in the order of the text, a chunk at a time."""
        for lo in range(0, len(self.code), CHUNK):
            yield self._windows(self.code[max(0, lo - ORDER):lo + CHUNK])[min(lo, ORDER):][self.coded[lo:lo + CHUNK]]

    def grams(self) -> np.ndarray:
        out = np.empty(int(self.ends[-1]), np.uint64)
        done = 0
        for part in self.chunks():
            out[done:done + len(part)] = part
            done += len(part)
        return out

    def _windows(self, code: np.ndarray) -> np.ndarray:
        b = self.bits
        one = code.astype(np.uint64)
        two = one.copy()
        two[1:] |= one[:-1] << np.uint64(b)
        out = two.copy()
        out[2:] |= two[:-2] << np.uint64(2 * b)
        out[4:] |= two[:-4] << np.uint64(4 * b)
        out[6:] |= one[:-6] << np.uint64(6 * b)
        return out if (ORDER + 1) * b >= 64 else out & np.uint64((1 << (ORDER + 1) * b) - 1)

    def keys(self, gram: np.ndarray) -> np.ndarray:
        """Grams as keys that mean the same in every unit: the number of context bytes, the context (latest byte lowest) and the byte."""
        byte = np.r_[0, self.alphabet].astype(np.uint64)
        key, room = np.zeros(len(gram), np.uint64), np.zeros(len(gram), np.uint64)
        for k in range(ORDER + 1):
            c = (gram >> np.uint64(self.bits * k)) & np.uint64((1 << self.bits) - 1)
            key |= byte[c.astype(np.int64)] << np.uint64(8 * k)
            if k:
                room += c > 0
        return key | room << np.uint64(56)


_THREE, _LOW = np.uint64((1 << 24) - 1), np.uint64((1 << 56) - 1)


def to_sent(key: np.ndarray) -> np.ndarray:
    """The key with the bytes next to the coded one in front, so that grams of one subtree are near each other."""
    older, near, symbol = (key & _LOW) >> np.uint64(32), (key >> np.uint64(8)) & _THREE, key & np.uint64(255)
    missing = np.uint64(ORDER) - (key >> np.uint64(56))
    return missing << np.uint64(56) | near << np.uint64(32) | older << np.uint64(8) | symbol


def from_sent(sent: np.ndarray) -> np.ndarray:
    near, older, symbol = (sent >> np.uint64(32)) & _THREE, (sent >> np.uint64(8)) & _THREE, sent & np.uint64(255)
    room = np.uint64(ORDER) - (sent >> np.uint64(56))
    return room << np.uint64(56) | older << np.uint64(32) | near << np.uint64(8) | symbol


def _in_order(g: Grams, gram: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of distinct grams by subtree and within it, with the subtrees and what is sent in that order."""
    sent, tree = np.empty(len(gram), np.uint64), np.empty(len(gram), np.uint16 if bits <= 16 else np.int64)
    for lo in range(0, len(gram), CHUNK):
        key = g.keys(gram[lo:lo + CHUNK])
        sent[lo:lo + CHUNK], tree[lo:lo + CHUNK] = to_sent(key), _subtree(key, bits)
    order = np.argsort(sent)
    order = order[np.argsort(tree[order], kind="stable")]
    return order, tree[order], sent[order]


def _first_of_each(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _unit_grams(u: Unit, bits: int) -> pa.RecordBatch:
    g = Grams(u.data, u.sizes)
    cut = int(u.sizes[:u.learned].sum()) - u.learned
    gram = g.grams()
    counted, asked = gram[:cut], gram[cut:]
    counted.sort()
    asked.sort()
    first = np.flatnonzero(_first_of_each(counted))
    count = np.diff(np.r_[first, len(counted)])
    counted, asked = counted[first], asked[_first_of_each(asked)]
    del gram, first
    if len(counted):
        at = np.minimum(np.searchsorted(counted, asked), len(counted) - 1)
        asked = asked[counted[at] != asked]
    count = np.concatenate([count, np.zeros(len(asked), np.int64)])
    order, tree, sent = _in_order(g, np.concatenate([counted, asked]), bits)
    rows = [{"subtree": int(tree[a]), "unit": u.unit, "keys": to_planes(np.diff(sent[a:b], prepend=np.uint64(0))),
             "counts": to_planes(count[order[a:b]])} for a, b in runs(tree)]
    return pa.RecordBatch.from_pylist(rows, schema=_GRAMS)


def _send_grams(bits: int):
    def send(batches):
        for u in _rows(batches):
            yield _unit_grams(u, bits)
        release()
    return send


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, weights=n, minlength=len(distinct)).astype(np.int64)


def _short_counts(batches):
    """Training counts of bytes after contexts of one and of two bytes, by task: ``length, gram, n``."""
    total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for u in _rows(batches):
        if not u.learned:
            continue
        g = Grams(u.data[:u.learned_bytes()], u.sizes[:u.learned])
        found = [np.unique((part & np.uint64((1 << (SHORT + 1) * g.bits) - 1)).astype(np.uint32), return_counts=True) for part in g.chunks()]
        short, times = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
        for k in range(1, SHORT + 1):
            key = g.keys(short.astype(np.uint64) & np.uint64((1 << (k + 1) * g.bits) - 1))
            more = _at_order(key[_lengths(key) >= k], k), times[_lengths(key) >= k]
            total[k] = _summed(*(np.concatenate(x) for x in zip(more, *([total[k]] if k in total else []), strict=True)))
    for k, (g, n) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), k, np.int32)), pa.array(g.astype(np.int64)), pa.array(n)], names=["length", "gram", "n"])
    release()


class _Level:
    """Nodes of one order: counts by (context, byte), and by context total, distinct bytes and what they take from the parent."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        seen = counts > 0
        self.pairs, self.counts = pairs[seen], counts[seen].astype(np.float64)
        self.contexts, first = np.unique(self.pairs >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(self.counts, first) if len(first) else np.empty(0)
        self.distinct = np.diff(np.r_[first, len(self.pairs)]).astype(np.float64)
        self.first, self.taken = first, np.zeros(len(first))

    def take_from(self, parent: "_Level", k: int) -> None:
        """``taken``: counts in the parent of the bytes that this node has seen."""
        if len(self.first):
            self.taken = np.add.reduceat(parent.count(_at_order(self.pairs, k - 1)), self.first)

    def count(self, pairs: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.zeros(len(pairs))
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.counts[at], 0.0)

    def node(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Total, distinct bytes and taken counts; zero for a context never seen."""
        if not len(self.contexts):
            none = np.zeros(len(contexts))
            return none, none, none
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        hit = self.contexts[at] == contexts
        return tuple(np.where(hit, x[at], 0.0) for x in (self.total, self.distinct, self.taken))


def short_levels(short: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, _Level]:
    """Levels of the contexts of up to ``SHORT`` bytes from their (gram, count) arrays."""
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    levels = {k: _Level(*short.get(k, none)) for k in range(1, SHORT + 1)}
    grams1, n = short.get(1, none)
    zero = np.bincount((grams1 & np.uint64(255)).astype(np.int64), weights=n, minlength=_SYMBOLS)
    levels[0] = _Level(np.arange(_SYMBOLS, dtype=np.uint64), zero)
    for k in range(1, SHORT + 1):
        levels[k].take_from(levels[k - 1], k)
    return levels


def code_lengths(keys: np.ndarray, counts: np.ndarray, short: dict[int, _Level]) -> np.ndarray:
    """-log10 probability of each gram; ``keys`` are distinct, sorted, and whole subtrees, ``short`` the levels every task has."""
    length = _lengths(keys)
    levels = dict(short)
    for k in range(SHORT + 1, ORDER + 1):
        p, place = np.unique(_at_order(keys[length >= k], k), return_inverse=True)
        levels[k] = _Level(p, np.bincount(place, weights=counts[length >= k], minlength=len(p)))
        levels[k].take_from(levels[k - 1], k)
    out = np.zeros(len(keys))
    live = np.ones(len(keys), bool)
    taken, out_of = np.zeros(len(keys)), np.zeros(len(keys))  # by the longer context
    for k in range(ORDER, -1, -1):
        at = np.flatnonzero(live & (length >= k))
        pairs = _at_order(keys[at], k)
        total, distinct, takes = levels[k].node(pairs >> np.uint64(8))
        t, d = total - taken[at], distinct - out_of[at]
        n = levels[k].count(pairs)
        hit = n > 0
        some = t + d > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(hit, np.log10(n / (t + d)), np.where(some, np.log10(d / (t + d)), 0.0))
        out[at] -= step
        live[at[hit]] = False
        seen = total > 0
        taken[at], out_of[at] = np.where(seen, takes, 0.0), np.where(seen, distinct, 0.0)
    left = max(_SYMBOLS - len(levels[0].pairs), 1)
    out[live] += np.log10(left)
    return out


def _score_grams(short: dict[int, tuple[np.ndarray, np.ndarray]]):
    made: list[dict[int, _Level]] = []  # once for all subtrees of a task

    def score(table: pa.Table) -> pa.Table:
        if not made:
            made.append(short_levels(short))
        keys = [from_sent(np.cumsum(from_planes(k))) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([from_planes(c) for c in table.column("counts").to_pylist()])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(distinct))
        steps = np.rint(code_lengths(distinct, total, made[0]) * STEPS).astype(np.uint64)[place]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        out = [to_planes(c) for c in np.split(steps, ends)]
        release()
        return pa.table({"unit": table.column("unit"), "subtree": table.column("subtree"),
                         "words": pa.nulls(len(out), pa.binary()), "found": pa.array(out, pa.binary())})
    return score


# -- documents -------------------------------------------------------------

def _sorted_chunks(g: Grams):
    """A function that goes through the grams in their order, a chunk at a time: grams, whether each is the first of its kind, texts."""
    gram = g.grams()
    low = max(1, len(g.ends).bit_length())
    if (ORDER + 1) * g.bits + low <= 64:  # gram and text sort as one number, in place
        for lo in range(0, len(gram), CHUNK):
            part = gram[lo:lo + CHUNK]
            part <<= np.uint64(low)
            part |= _owners(g.ends, lo, lo + len(part)).astype(np.uint64)
        gram.sort()

        def at(lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
            return gram[lo:hi] >> np.uint64(low), (gram[lo:hi] & np.uint64((1 << low) - 1)).astype(np.int64)
    else:
        order = np.argsort(gram)

        def at(lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
            return gram[order[lo:hi]], np.searchsorted(g.ends, order[lo:hi], side="right")

    def chunks():
        last = None
        for lo in range(0, len(gram), CHUNK):
            part, text = at(lo, lo + CHUNK)
            new = _first_of_each(part)
            new[0] = last is None or part[0] != last
            last = part[-1]
            yield part, new, text
    return chunks


def _text_steps(g: Grams, bits: int, steps: dict[int, np.ndarray]) -> np.ndarray:
    """Code length of every text, from the answers for the subtrees in the order in which the grams were sent."""
    chunks = _sorted_chunks(g)
    order, _, _ = _in_order(g, np.concatenate([part[new] for part, new, _ in chunks()]), bits)
    cost = np.empty(len(order))
    cost[order] = np.concatenate([steps[t] for t in sorted(steps)])
    out, seen = np.zeros(len(g.ends)), 0
    for _, new, text in chunks():
        place = seen + np.cumsum(new)
        seen = int(place[-1])
        out += np.bincount(text, weights=cost[place - 1], minlength=len(out))
    return out


def _score_documents(bits: int, n: int, v: int, end_count: int):
    def score(units: pa.Table, answers: pa.Table) -> pa.Table:
        parts = []
        floor = np.log10(float(n + v + 1))
        for u in _rows(units.to_batches()):
            count: dict[bytes, int] = {}
            steps: dict[int, np.ndarray] = {}
            for subtree, words, found in zip(*(answers.column(k).to_pylist() for k in ("subtree", "words", "found")), strict=True):
                if words is None:
                    steps[subtree] = from_planes(found)
                else:
                    count.update(zip(words.split(b" "), from_planes(found).tolist(), strict=True))
            texts = len(u.doc_ids)
            total = _text_steps(Grams(u.data, u.sizes), bits, steps)
            ends, done = np.cumsum(u.words), 0
            size = u.words.astype(np.int64) + 1
            base, known = np.log10(end_count + 1.0) - size * floor, np.full(texts, int(end_count > 0))
            for piece in _word_pieces(u.data, 0, len(u.data)):
                c = np.fromiter(map(count.__getitem__, piece), np.float64, len(piece))
                text = _owners(ends, done, done + len(piece))
                done += len(piece)
                base += np.bincount(text, weights=np.log10(c + 1), minlength=texts)
                known += np.bincount(text[c > 0], minlength=texts)
            parts.append(pa.table({"doc_id": pa.array(u.doc_ids, pa.int64()), "held_out": pa.array(np.arange(texts) >= u.learned), "n_tokens": pa.array(size),
                                   "n_known": pa.array(known), "base_score": pa.array(base), "score": pa.array(-total / STEPS)}))
        release()
        return pa.concat_tables(parts)
    return score


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Both scores are log10 probabilities: of the smoothed word counts and of the
    trie. Null texts are empty and hold the end alone. Without training rows
    every byte value is equally likely. Ids must be whole numbers or null; rows
    without an id are learned from. Equal ids and rows each count for themselves.
    Code lengths are kept in steps of 2 ** -18.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    units = materialize(texts.mapInArrow(_units, _UNIT_TYPE), "ppm-units")
    size = units.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    word_bits, bits = (max(3, int(size // each).bit_length()) for each in (VOCABULARY_BYTES, SUBTREE_BYTES))
    plain = units.drop("bytes")

    sent = plain.mapInArrow(_send_words(word_bits), _WORDS_TYPE)
    words = materialize(sent.groupBy("bucket").applyInArrow(_answer_words, "unit long, words binary, found binary, n long, known long"), "ppm-words", clean=True)
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("known"), F.lit(0)).alias("known")).first()
    ids = texts.select("doc_id")
    in_training = F.col("doc_id").isNull() | (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 != 2)
    ends = ids.filter(in_training).count()
    n, v = sums["n"] + ends, sums["known"] + (ends > 0)

    counted = (plain.mapInArrow(_short_counts, "length int, gram long, n long").groupBy("length", "gram").agg(F.sum("n").alias("n"))
               .orderBy("length", "gram").toPandas())  # at most 256 ** 3 grams of two context bytes
    short = {int(k): (g["gram"].to_numpy().astype(np.uint64), g["n"].to_numpy()) for k, g in counted.groupby("length")}
    costs = plain.mapInArrow(_send_grams(bits), _GRAMS_TYPE).groupBy("subtree").applyInArrow(_score_grams(short), _ANSWER)
    answers = costs.unionByName(words.select("unit", F.lit(-1).alias("subtree"), "words", "found")).withColumnRenamed("unit", "home")
    out = (plain.groupBy("unit").cogroup(answers.groupBy("home"))
           .applyInArrow(_score_documents(bits, n, v, ends),
                         "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return out.withColumn("train_tokens", F.lit(n).cast("long"))
