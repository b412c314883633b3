"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch form a trie. A depth-first walk gives every
prefix its *last-token state*: the last token of the prefix's encoding and the
state of what stands before that token. There is exactly one such token,
namely the suffix of the prefix that is compatible with the last token of the
rest (two tokens are compatible when merging their joined symbols gives just
these two). So the encoding of a prefix that many words share is found once,
and a word's ids are read off by following its states.

Sorted words are the leaves of the trie in depth-first order; the walk keeps
the states of the current path only. Words never seen again cost nothing after
their batch; the memory of compatible pairs is bounded.

Only the vocabulary file is read (its path is a parameter); normalisation,
splitting, merging and decoding are done here. What counts as a letter, digit
or space is asked of the file's library, whose Unicode tables differ.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import struct
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import chain, count

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

from .common import bounded_batches, release

#: Pairs of tokens whose compatibility is remembered, at most.
MAX_PAIRS = 500_000
_NO_LIMIT = 1 << 60

# Fixed value: the word pattern of the supported vocabulary files.
CONTRACTIONS_LETTERS_DIGITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_HIGH = re.compile("[\u0250-\U0010ffff]")


def low_pattern() -> re.Pattern:
    """The same pattern for texts below U+0250, with plain character classes, which scan faster."""
    kinds = {c: unicodedata.category(chr(c))[0] for c in range(0x250)}
    letters = "".join(chr(c) for c, k in kinds.items() if k == "L")
    numbers = "".join(chr(c) for c, k in kinds.items() if k == "N")
    spaces = "\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{spaces}{letters}{numbers}]+")


@cache
def _points() -> tuple[np.ndarray, str]:
    """All code points but the surrogates, as numbers and as a text."""
    points = np.r_[0:0xD800, 0xE000:0x110000]
    return points, points.astype("<u4").tobytes().decode("utf-32-le")


@cache
def class_set(name: str) -> str:
    """A character class (such as ``\\p{L}``) as the vocabulary's library knows it, as a nested set.

    Unicode gains letters every year, and libraries take them over at
    different times; a vocabulary file means the classes of its own. Both are
    let loose on a text of all code points, and the set names the difference.
    """
    text = _points()[1]
    theirs, ours = np.ones(len(text), bool), np.zeros(len(text), bool)
    for _, (a, b) in Split(Regex(f"{name}+"), "removed").pre_tokenize_str(text):
        theirs[a:b] = False
    for m in regex.finditer(f"{name}+", text):
        ours[m.start():m.end()] = True
    gone, extra = (_ranges(x) for x in (ours & ~theirs, theirs & ~ours))
    known = f"[{name}--[{gone}]]" if gone else name
    return f"[{known}{extra}]"


def _ranges(member: np.ndarray) -> str:
    points = _points()[0]
    edge = np.flatnonzero(np.diff(np.r_[False, member, False].astype(np.int8)))
    return "".join(f"\\U{points[a]:08x}-\\U{points[b - 1]:08x}" for a, b in edge.reshape(-1, 2).tolist())


def with_sets(pattern: str) -> str:
    """A pattern with those classes in place of the names; they stand inside brackets or alone."""
    return "(?V1)" + re.sub(r"\\p\{[LN]\}|\\s", lambda m: class_set(m[0]), pattern)


@cache
def new_lower() -> dict[int, str]:
    """Lower case of letters that only the library knows."""
    unknown = "".join(c for c in _points()[1] if unicodedata.category(c) == "Cn")
    return {ord(c): x for c, x in zip(unknown, Lowercase().normalize_str(unknown), strict=True) if x != c}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class WordBPE:
    """Encoder and decoder of one vocabulary file with a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("end_of_word_suffix") is None or spec.get("decoder") is not None:
            raise ValueError("a vocabulary with word ends and no decoder is needed")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.symbols = byte_symbols()
        self.rank: dict[tuple[str, str], int] = {}
        self.made: dict[str, tuple[int, str, str]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[a, b] = r
            self.made.setdefault(a + b, (r, a, b))
        self.begins = {t[:k] for t in self.ids for k in range(1, len(t) + 1)}
        self.steps: dict[tuple[str, str], tuple] = {}
        normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if normal != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"normalizer not supported: {normal}")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = pattern
        self.split_low = low_pattern() if pattern == CONTRACTIONS_LETTERS_DIGITS else self.split
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fits: dict[tuple[str, str], bool] = {}

    @cached_property
    def split(self) -> regex.Pattern:
        return regex.compile(with_sets(self.pattern))

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the symbols of ``left`` and ``right`` together gives these two tokens.

        Merges inside either token are undone from the latest back. At each
        step the two parts that touch would have merged across the border if
        they have a merge that comes before the last one undone.
        """
        key = (left, right)
        known = self.fits.get(key)
        if known is not None:
            return known
        made, rank = self.made, self.rank
        a, b, limit, fit = left, right, _NO_LIMIT, True
        while True:
            r = rank.get((a, b))
            if r is not None and r < limit:
                fit = False
                break
            ma, mb = made.get(a), made.get(b)
            if ma is None and mb is None:
                break
            # of equal merges the one on the left is done first
            if mb is None or (ma is not None and ma[0] > mb[0]):
                limit, a = ma[0], ma[2]
            else:
                limit, b = mb[0] + 1, mb[1]
        if len(self.fits) >= MAX_PAIRS:
            self.fits.clear()
        self.fits[key] = fit
        return fit

    def _step(self, held: str, symbol: str) -> tuple[str, tuple[tuple[str, int], ...]]:
        """After ``symbol``: the longest suffix that can begin a token, and all tokens that end here.

        ``held`` is that suffix before the symbol. Tokens come longest first,
        each with its number of symbols.
        """
        key = (held, symbol)
        known = self.steps.get(key)
        if known is not None:
            return known
        ends, now = [], held
        while True:
            token = now + symbol
            if token in self.ids:
                ends.append((token, len(now) + 1))
            if not now:
                break
            now = now[1:]
        now = held
        while now + symbol not in self.begins and now:
            now = now[1:]
        out = (now + symbol if now + symbol in self.begins else "", tuple(ends))
        if len(self.steps) >= MAX_PAIRS:
            self.steps.clear()
        self.steps[key] = out
        return out

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of each distinct word, by one depth-first walk over their trie."""
        collects = gc.isenabled()
        gc.disable()  # the walk makes many small tuples and no cycles
        try:
            return self._walk(words)
        finally:
            if collects:
                gc.enable()

    def _walk(self, words: set[str]) -> dict[str, list[int]]:
        symbols, end, ids, fits, steps = self.symbols, self.end, self.ids, self.fits, self.steps
        out: dict[str, list[int]] = {}
        path: list = [None]  # path[d]: the state of the first d symbols
        held: list[str] = [""]  # held[d]: the longest suffix of them that can begin a token
        last = ""
        for key, word in sorted([("".join([symbols[b] for b in w.encode()]), w) for w in words]):
            n = len(key) - 1  # the final symbol has an edge of its own
            shared = 0
            most = min(n, len(path) - 1)
            if most and key[:most] == last[:most]:
                shared = most
            else:
                while shared < most and key[shared] == last[shared]:
                    shared += 1
            del path[shared + 1:], held[shared + 1:]
            for d in range(shared, n + 1):
                symbol = key[d] if d < n else key[d] + end
                step = steps.get((held[d], symbol)) or self._step(held[d], symbol)
                for token, size in step[1]:
                    before = path[d + 1 - size]
                    if before is None:
                        state = (token, None)
                        break
                    fit = fits.get((before[0], token))
                    if fit if fit is not None else self.compatible(before[0], token):
                        state = (token, before)
                        break
                else:
                    raise ValueError(f"symbol outside the vocabulary: {symbol!r}")
                if d < n:
                    path.append(state)
                    held.append(step[0])
            found = []
            while state is not None:
                found.append(ids[state[0]])
                state = state[1]
            out[word] = found[::-1]
            last = key
        return out

    def normalize(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # a code point at a time where that matters: a final sigma has no context here
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def split_words(self, text: str) -> list[str]:
        text = self.normalize(text)
        if _HIGH.search(text):
            return self.split.findall(text.translate(new_lower()))
        return self.split_low.findall(text)

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """Runs of plain text, and special tokens with their id, in order."""
        if self.added is None or not any(s in text for s in self.special):
            return [(text, None)]
        return [(p, self.special.get(p)) for p in self.added.split(text) if p]

    def tokenize(self, texts: list[str]) -> tuple[list[int | str], list[array]]:
        """The distinct words of the texts (special tokens as ids), and each text as places among them."""
        place: dict[int | str, int] = defaultdict(count().__next__)
        rows = []
        for text in texts:
            row = array("I")
            for part, special in self.parts(text):
                row.extend(map(place.__getitem__, [special] if special is not None else self.split_words(part)))
            rows.append(row)
        return list(place), rows

    def encode_distinct(self, words: list[int | str]) -> list[list[int]]:
        """Ids of each entry of ``tokenize``'s first list."""
        ids = self.encode_words({w for w in words if isinstance(w, str)})
        return [ids[w] if isinstance(w, str) else [w] for w in words]

    def encode(self, texts: list[str]) -> list[list[int]]:
        words, rows = self.tokenize(texts)
        ids = self.encode_distinct(words)
        return [list(chain.from_iterable(map(ids.__getitem__, row))) for row in rows]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, tokens are joined by one space."""
        return " ".join(self.tokens[i] for i in ids)


_loaded: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def _in_pieces(texts: pd.Series, limit: int = 6 << 20):
    """Consecutive texts of about ``limit`` characters, so that one trie stays bounded."""
    piece, n = [], 0
    for t in texts:
        t = t or ""
        if piece and n + len(t) > limit:
            yield piece
            piece, n = [], 0
        piece.append(t)
        n += len(t)
    if piece:
        yield piece


def digests(text: Column, path: str) -> Column:
    """Struct of ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each text; null counts as empty."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for texts in batches:
            rows = []
            for piece in _in_pieces(texts):
                words, split = bpe.tokenize(piece)
                packed, shown = [], []
                for ids in bpe.encode_distinct(words):
                    packed.append(struct.pack(f"<{len(ids)}I", *ids))
                    shown.append(bpe.decode(ids).encode())
                for row in split:
                    raw = b"".join(map(packed.__getitem__, row))
                    rows.append((len(raw) // 4, hashlib.sha256(raw).hexdigest(),
                                 hashlib.sha256(b" ".join(map(shown.__getitem__, row))).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        del bpe
        _loaded.clear()  # the worker goes on to other stages
        release()
    return coded(text)


def encode_column(text: Column, path: str) -> Column:
    """Token ids of each text as ``array<int>``; null counts as empty."""
    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([x for piece in _in_pieces(texts) for x in bpe.encode(piece)], dtype=object)
    return ids(text)


def decode_column(ids: Column, path: str) -> Column:
    """Text of each list of ids; null gives null."""
    @F.pandas_udf("string")
    def text(lists: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([None if x is None else bpe.decode(list(map(int, x))) for x in lists], dtype=object)
    return text(ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    bounded_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("doc_id"), digests(F.col(text_col), path).alias("d"))
            .select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256"))
