"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items build one suffix automaton; every
document streams through it, keeping the longest suffix of what was read that
occurs in some item. A match of at least ``window`` words marks its words, and
so does an item of fewer words that occurs whole.

The item table is the stated query set. It is taken in parts of at most
``PART_WORDS`` words (an item of more is a part alone), each sent to the
executors and searched in a pass over the documents of its own, so that a task
holds one part and the driver the one at hand and the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_batches, materialize

WINDOW = 10
#: Words of items in one automaton at most (about 120 MB of states).
PART_WORDS = 150_000

# Word bytes: 0-9, A-Z (lower-cased), a-z and every byte of a non-ASCII character.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_KEEP).split()


class ItemAutomaton:
    """Suffix automaton of several items; a match never runs over an item's end."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.in_window: dict[tuple, list[int]] = {}
        whole: dict[tuple, list[int]] = {}
        for k, (_, ws) in enumerate(items):
            state = 0
            for w in ws:
                state = self._extend(state, w)
            if len(ws) >= window:
                for i in range(len(ws) - window + 1):
                    self.in_window.setdefault(tuple(ws[i:i + window]), []).append(k)
            elif ws:
                whole.setdefault(tuple(ws), []).append(k)
        self.names = [name for name, _ in items]
        # short items that end in a state, with their lengths, over the suffix links
        ends: dict[int, list[tuple[int, list[int]]]] = {}
        for ws, ks in whole.items():
            state = 0
            for w in ws:
                state = self.next[state][w]
            ends.setdefault(state, []).append((len(ws), ks))
        self.short: dict[int, list[tuple[int, list[int]]]] = {}
        if ends:
            for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                if got := ends.get(s, []) + self.short.get(self.link[s], []):
                    self.short[s] = got

    def _extend(self, last: int, w: bytes) -> int:
        """Add a word after ``last``; the states of earlier items are kept in use."""
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(w)
        if q is not None and length[q] == length[last] + 1:
            return q
        if q is not None:
            return self._copy(last, w, q)
        new = self._state({}, length[last] + 1, 0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._copy(p, w, q)
        return new

    def _state(self, trans: dict, length: int, link: int) -> int:
        self.next.append(trans)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _copy(self, p: int, w: bytes, q: int) -> int:
        new = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def search(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of hit words (they may overlap) and the items with an occurring window."""
        nxt, link, length, short, window = self.next, self.link, self.length, self.short, self.window
        known = self.next[0]
        state = run = 0
        hits: list[tuple[int, int]] = []
        found: set[int] = set()
        for i, w in enumerate(ws):
            if w not in known:
                state = run = 0
                continue
            to = nxt[state].get(w)
            while to is None:
                state = link[state]
                run = length[state]
                to = nxt[state].get(w)
            state, run = to, run + 1
            if run >= window:
                hits.append((i + 1 - window, i + 1))
                found.update(self.in_window[tuple(ws[i + 1 - window:i + 1])])
            if state in short:
                for n, ks in short[state]:
                    if n <= run:
                        hits.append((i + 1 - n, i + 1))
                        found.update(ks)
        return hits, found


def _item_parts(items: DataFrame, id_col: str, text_col: str, part_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    part, n = [], 0
    rows = (items.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).alias("t"))
            .filter("k is not null and t is not null"))
    for r in rows.toLocalIterator():
        ws = words(r.t)
        if part and n + len(ws) > part_words:
            yield part
            part, n = [], 0
        part.append((r.k, ws))
        n += len(ws)
    yield part


_made: dict[tuple, ItemAutomaton] = {}


def _automaton(token: tuple, part, window: int) -> ItemAutomaton:
    if token not in _made:
        _made.clear()
        _made[token] = ItemAutomaton(part, window)
    return _made[token]


def _search_column(part, window: int, text: Column, before: Column | None, cut: bool) -> Column:
    """Struct of ``spans`` (flat, merged ranges of hit words), ``items`` and what is left, added to those of ``before``."""
    token = (hashlib.sha256(repr(part).encode()).hexdigest(), window)

    def found(texts: pd.Series, had: pd.DataFrame | None) -> pd.DataFrame:
        auto = _automaton(token, part, window)
        n_words, spans, items, left = [], [], [], []
        for i, t in enumerate(texts):
            ws = words(t) if t else []
            hits, ks = auto.search(ws)
            names = {auto.names[k] for k in ks}
            if had is not None:
                old = list(map(int, had["spans"].iloc[i]))
                hits = sorted(hits + list(zip(old[::2], old[1::2], strict=True)))
                names |= set(had["items"].iloc[i])
            merged: list[int] = []
            for a, b in hits if had is not None else sorted(hits):
                if merged and a <= merged[-1]:
                    merged[-1] = max(merged[-1], b)
                else:
                    merged += [a, b]
            n_words.append(len(ws))
            spans.append(merged)
            items.append(sorted(names))
            left.append(_without_spans(t, merged) if cut and merged else None)
        return pd.DataFrame({"n_words": n_words, "spans": spans, "items": items, "left": pd.Series(left, dtype=object)})

    # evaluated once, whatever is later asked of its result
    kind = "n_words long, spans array<int>, items array<string>, left string"
    if before is None:
        @F.pandas_udf(kind)
        def first(texts: pd.Series) -> pd.DataFrame:
            return found(texts, None)
        return first.asNondeterministic()(text)

    @F.pandas_udf(kind)
    def further(texts: pd.Series, had: pd.DataFrame) -> pd.DataFrame:
        return found(texts, had)
    return further.asNondeterministic()(text, before)


def match_benchmark(docs: DataFrame, items: DataFrame, held: str, text_col: str = "text", item_id_col: str = "item_id",
                    item_text_col: str = "text", window: int = WINDOW, part_words: int = PART_WORDS, cut: bool = False) -> DataFrame:
    """``docs`` with a column ``held``: ``n_words``, ``spans`` (word ranges, flat), ``items`` (sorted ids) and, with ``cut``, the text left.

    Null texts have no words; null item ids or texts are left out; rows that
    share an item id count as one item. No items, no hits. Every part of the
    items but the last is searched in a pass of its own whose result is
    written; the last pass is that of the frame returned.
    """
    bounded_batches(docs.sparkSession)
    frame, part, before = docs, None, None
    for following in _item_parts(items, item_id_col, item_text_col, part_words):
        if part is not None:
            frame = materialize(frame.withColumn(held, _search_column(part, window, F.col(text_col), before, cut)), "benchmark-matches")
            before = F.col(held)
        part = following
    return frame.withColumn(held, _search_column(part, window, F.col(text_col), before, cut))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items`` of every row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (match_benchmark(texts, items, "m", **options)
            .select("doc_id", F.col("m.n_words").alias("n_words"),
                    F.expr("aggregate(transform(m.spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)").alias("n_hit"),
                    F.col("m.spans").alias("spans"), F.col("m.items").alias("items")))


def _without_spans(text: str | None, spans) -> str | None:
    if text is None or not len(spans):
        return text
    raw = text.encode()
    flat = raw.translate(_KEEP)
    code = np.frombuffer(flat, np.uint8) != 32
    edge = np.diff(np.r_[False, code, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at:starts[a]])
        at = int(ends[b - 1])
    out.append(raw[at:])
    return b"".join(out).decode()


def remove_benchmark_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
                              max_coverage: float = 0.8, **options) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out of the text.

    A document of which more than ``max_coverage`` of the words are hit goes
    altogether. Texts without a hit are unchanged; ``chars_col``, if there is
    one, counts the code points of what is left of a cut text.
    """
    held = "benchmark_match"
    while held in docs.columns:
        held += "_"
    found = match_benchmark(docs, items, held, text_col, cut=True, **options)
    n_hit = F.expr(f"aggregate(transform({held}.spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)")
    keep = found.filter(n_hit <= max_coverage * F.col(f"{held}.n_words"))
    left = F.when(F.size(f"{held}.spans") > 0, F.col(f"{held}.left")).otherwise(F.col(text_col))
    changed = {text_col: left}
    if chars_col in docs.columns:
        changed[chars_col] = (F.when(F.size(f"{held}.spans") > 0, F.length(f"{held}.left").cast(docs.schema[chars_col].dataType))
                              .otherwise(F.col(chars_col)))
    return keep.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
