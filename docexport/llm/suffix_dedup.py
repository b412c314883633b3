"""Repeated byte strings by a logarithmic family of sparse suffix indexes.

A string of ``length`` bytes that starts in two places is repeated. Every such
string holds an *anchor*: of its ``length - GRAM + 1`` grams of ``GRAM`` bytes,
the rightmost with the smallest hash. Equal strings have equal anchors at equal
places, so suffixes need to be indexed at anchors only, about one position in
seventy, and strings need to be compared only where anchors meet.

1. Each block of documents sends the anchors it has (distinct, with counts) and
   the segment around each: from the first to the last byte of the strings whose
   anchor it is. In one task per bucket of anchors the blocks are batches of an
   index family: a batch is a sorted level, and levels of equal rank merge into
   one of the next, so that every key is moved a logarithmic number of times.
   What came more than once is then read off by a merge scan over the levels.
2. An anchor whose whole segment occurs elsewhere has only repeated strings.
   The strings of anchors that occur in several different segments go through
   the same family, one key per string, since there only some are repeated.
3. The blocks get their answers and cut every byte that a repeated string
   covers. Strings are judged on the input, not on what is left.

The levels hold 64-bit hashes of the bytes that count (gram, segment, string),
sorted as numbers and counted, in place of suffixes sorted by their bytes: of
a string of fixed length only its identity matters, not its neighbours' common
prefixes. The family lives as long as the task of its bucket.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (BYTE_CODE, bucket_bits, materialize, mix64, pack, pieces, prefix_sums, runs, span_hash, table_runs,
                     text_buffers, to_blocks)

LENGTH = 200
GRAM = 64


def slide_min_right(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its smallest, the rightmost of equal ones."""
    n = len(h) - width + 1
    val, idx = h, np.arange(len(h), dtype=np.int64)
    span = 1
    while span * 2 <= width:
        later = val[span:] <= val[:-span]
        idx = np.where(later, idx[span:], idx[:-span])
        val = np.where(later, val[span:], val[:-span])
        span *= 2
    rest = width - span
    a, b = val[:n], val[rest:rest + n]
    return np.where(b <= a, idx[rest:rest + n], idx[:n])


def anchors(data: np.ndarray, length: int = LENGTH):
    """``place, first, last, anchor hash, segment hash`` of each anchor, and the sums that hash any span.

    The strings whose anchor is at ``place`` start at ``first`` to ``last``.
    """
    sums = prefix_sums(BYTE_CODE[data])
    n = len(data) - length + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), sums
    at = np.arange(len(data) - GRAM + 1)
    gram = span_hash(sums, at, at + GRAM)
    best = slide_min_right(gram, length - GRAM + 1)
    cut = np.flatnonzero(np.diff(best)) + 1
    first, last = np.r_[0, cut], np.r_[cut, n] - 1
    place = best[first]
    segment = mix64(span_hash(sums, first, last + length) + (place - first).astype(np.uint64))
    return place, first, last, gram[place], segment, sums


class IndexFamily:
    """Sorted key arrays of geometric sizes; tells which keys came more than once."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # rank, keys, counts

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add a batch of distinct sorted keys: merge it with levels of its rank, then keep it as a level."""
        rank = 0
        while self.levels and self.levels[-1][0] <= rank:
            old_rank, k, c = self.levels.pop()
            keys, counts = _merged(keys, counts, k, c)
            rank = old_rank + 1
        self.levels.append((rank, keys, counts))

    def total(self, keys: np.ndarray) -> np.ndarray:
        """How often each of ``keys`` came, by a merge scan against every level."""
        out = np.zeros(len(keys), np.int64)
        for _, k, c in self.levels:
            at = np.minimum(np.searchsorted(k, keys), max(len(k) - 1, 0))
            if len(k):
                out += np.where(k[at] == keys, c[at], 0)
        return out


def _merged(k1, c1, k2, c2):
    keys = np.concatenate([k1, k2])
    order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
    keys, counts = keys[order], np.concatenate([c1, c2])[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SENT_TYPE = "bucket int, block long, keys binary, counts binary"


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Anchors have the smallest hashes of their surroundings; mixed again, they fall evenly into buckets."""
    return (mix64(keys) >> np.uint64(64 - bits)).astype(np.int64)


def _parcels(block: int, keys: np.ndarray, bits: int):
    """A block's distinct keys with their counts, by bucket, in order."""
    k, c = np.unique(keys, return_counts=True)
    bucket = bucket_of(k, bits)
    order = np.argsort(bucket, kind="stable")
    k, c, bucket = k[order], c[order], bucket[order]
    for a, b in runs(bucket):
        yield {"bucket": int(bucket[a]), "block": block, "keys": pack(k[a:b]), "counts": pack_counts(c[a:b])}


def pack_counts(c: np.ndarray) -> bytes:
    """Counts as their width in bytes and then as narrow as the greatest allows, up to 64 bits."""
    top = int(c.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + pack(c.astype(f"u{width}"))


def unpack_counts(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, f"u{cell[0]}", offset=1).astype(np.int64)


def _repeated(table: pa.Table) -> pa.Table:
    """For each block the keys of this bucket that came at least twice, with their totals."""
    family = IndexFamily()
    batches = [(np.frombuffer(k, np.uint64), unpack_counts(c))
               for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True)]
    for keys, counts in batches:
        family.add(keys, counts)
    totals = [family.total(k) for k, _ in batches]
    return pa.table({"block": table.column("block"),
                     "keys": pa.array([pack(k[n > 1]) for (k, _), n in zip(batches, totals, strict=True)], pa.binary()),
                     "counts": pa.array([pack_counts(n[n > 1]) for n in totals], pa.binary())})


def _documents(column):
    raw, off = text_buffers(column)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        yield raw[a:b]


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted answered keys and their totals."""
    keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist() if k]
    counts = [unpack_counts(c) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True) if k]
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    known, first = np.unique(np.concatenate(keys), return_index=True)
    return known, np.concatenate(counts)[first]


def _count(values: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Total of each value; 1 if there was no answer for it."""
    keys, counts = known
    if not len(keys):
        return np.ones(len(values), np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, counts[at], 1)


def _send_anchors(bits: int, length: int):
    def send(batches):
        for batch in batches:
            for block, part in table_runs(batch):
                got = []
                for data in _documents(part.column("text")):
                    if len(data) >= length:
                        _, _, _, gram, segment, _ = anchors(data, length)
                        got += [gram, segment]
                if got:
                    yield pa.RecordBatch.from_pylist(list(_parcels(block, np.concatenate(got), bits)), schema=_SENT)
    return send


def _string_hashes(sums, first, last, chosen, length):
    """Hash of every string of the chosen anchors, with its start."""
    n = (last - first + 1)[chosen]
    starts = np.repeat(first[chosen], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return starts, span_hash(sums, starts, starts + length)


def _send_strings(bits: int, length: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known = _keys(answers)
        got = []
        for data in _documents(docs.column("text")):
            if len(data) < length:
                continue
            _, first, last, gram, segment, sums = anchors(data, length)
            mixed = _count(gram, known) > _count(segment, known)
            if mixed.any():
                got.append(_string_hashes(sums, first, last, mixed, length)[1])
        if not got:
            return _SENT.empty_table()
        return pa.Table.from_pylist(list(_parcels(docs.column("block")[0].as_py(), np.concatenate(got), bits)), schema=_SENT)
    return send


def removed_runs(data: np.ndarray, known: tuple[np.ndarray, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes covered by repeated strings."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none
    _, first, last, gram, segment, sums = anchors(data, length)
    same = _count(segment, known)
    whole = same > 1
    ragged = (_count(gram, known) > same) & ~whole
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, first[whole], 1)
    np.add.at(edge, last[whole] + length, -1)
    if ragged.any():
        starts, h = _string_hashes(sums, first, last, ragged, length)
        starts = starts[_count(h, known) > 1]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + length, -1)
    covered = np.diff(np.r_[False, np.cumsum(edge[:-1]) > 0, False].astype(np.int8))
    return np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)


def _cut(length: int):
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known = _keys(answers)
        size, runs_, kept = [], [], []
        for data in _documents(docs.column("text")):
            starts, ends = removed_runs(data, known, length)
            size.append(len(data))
            runs_.append(np.stack([starts, ends], 1).ravel().tolist())
            at, left = 0, hashlib.sha256()
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                left.update(data[at:a])
                at = b
            left.update(data[at:])
            kept.append(left.hexdigest())
        return pa.table({"rid": docs.column("rid"), "doc_id": docs.column("doc_id"), "n_bytes": pa.array(size, pa.int64()),
                         "runs": pa.array(runs_, pa.list_(pa.int32())), "kept_sha256": pa.array(kept, pa.string())})
    return cut


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``rid, doc_id, n_bytes, runs, kept_sha256`` of every row.

    ``runs`` are the maximal removed byte ranges (start, end, start, ...).
    Null texts are empty; texts shorter than ``length`` lose nothing; copies of
    a longer text lose all of it, the first copy too.
    """
    blocks = to_blocks(docs, id_col, text_col, "suffix-blocks")
    bits = bucket_bits(blocks)
    by_block = blocks.groupBy("block")
    sent = blocks.select("block", "text").mapInArrow(_send_anchors(bits, length), _SENT_TYPE)
    answer = "block long, keys binary, counts binary"
    first = materialize(sent.groupBy("bucket").applyInArrow(_repeated, answer), "suffix-anchors", clean=True)
    strings = by_block.cogroup(first.groupBy("block")).applyInArrow(_send_strings(bits, length), _SENT_TYPE)
    second = materialize(strings.groupBy("bucket").applyInArrow(_repeated, answer), "suffix-strings", clean=True)
    return (by_block.cogroup(first.unionAll(second).groupBy("block"))
            .applyInArrow(_cut(length), "rid long, doc_id long, n_bytes long, runs array<int>, kept_sha256 string"))
