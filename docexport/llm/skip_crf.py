"""Personal data by a skip-chain conditional random field.

Four patterns give the base spans, which always stay. Around them a random
field labels the tokens that could be personal data (those with a digit or an
``@``): a unary potential from a token's shape and the word before it, a chain
potential between neighbouring candidates, and a skip potential between
distant candidates that are the same or nearly so (same letters and digits
whatever the punctuation, or one ending with the other's digits). Loopy
sum-product messages run over each document; a token that no pattern caught,
but that the field labels like its repetitions, becomes a span of their kind.
A phone number repeated without its plus, say, is found this way.

Potentials are learned from the corpus: the base spans label the tokens of at
most ``MAX_TRAIN`` different texts that have some (in the order of a hash of
their ids and texts) and of at most ``MAX_TOKENS`` candidates of each, the shapes' weights are a softmax model, chain and skip weights are
smoothed log-odds of agreement.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_batches

#: Different texts with base spans that learning reads at most, and candidates of each.
MAX_TRAIN = 5_000
MAX_TOKENS = 2_000
KINDS = ("email", "ip", "card", "phone")
#: Marginal probability from which a token becomes a span.
CERTAIN = 0.8
ROUNDS = 6
#: Log potential that a repetition adds to what agreement has taught.
REPEATS = 4
#: Hash slots of unary features.
SLOTS = 512

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_RUN = re.compile(r"[0-9@+(][0-9A-Za-z@._%+()-]*(?:[\x20-]\(?[0-9][0-9().-]*)*|[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]*")
_NOT_DIGIT = re.compile("[^0-9]")
_BEFORE = re.compile(r"([^\W\d_]+)[^\w]*$")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind: leftmost non-overlapping matches that pass the kind's test."""
    email = [m.span() for m in EMAIL.finditer(text)] if "@" in text else []
    ip, card, phone = [], [], []
    if _DIGIT.search(text):
        ip = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NOT_DIGIT.sub("", m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    card.append(m.span())
        if "+" in text:
            phone = [m.span() for m in PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return [email, ip, card, phone]


@dataclass(frozen=True)
class Token:
    start: int
    end: int
    key: str
    digits: str
    slots: tuple[int, ...]
    label: int


def _shape(s: str) -> str:
    out, last = [], ""
    for c in s[:40]:
        k = "9" if c.isdigit() else "a" if c.isalpha() else c
        if k != last:
            out.append(k)
        last = k
    return "".join(out)


def _slot(name: str) -> int:
    h = 2166136261
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h % SLOTS


def candidates(text: str, base: list[list[tuple[int, int]]]) -> list[Token]:
    """Candidate tokens in order: base spans, and runs with digits or an ``@`` outside them."""
    spans = sorted({(a, b, k + 1) for k, found in enumerate(base) for a, b in found})
    taken: list[tuple[int, int, int]] = []
    for s in spans:
        if not taken or s[0] >= taken[-1][1]:
            taken.append(s)
    free, at = [], 0
    for a, b, _ in [*taken, (len(text), len(text), 0)]:
        for m in _RUN.finditer(text, at, a):
            x, y = m.start(), m.end()
            while y > x and text[y - 1] in ".,(-+%_":
                y -= 1
            body = text[x:y]
            if y - x >= 4 and ("@" in body or len(_NOT_DIGIT.sub("", body)) >= 7):
                free.append((x, y, 0))
        at = b
    out = []
    for a, b, label in sorted(taken + free):
        body = text[a:b]
        digits = _NOT_DIGIT.sub("", body)
        key = "".join(c for c in body.lower() if c.isalnum())
        word = _BEFORE.search(text, max(0, a - 30), a)
        names = (f"s{_shape(body)}", f"n{min(len(digits), 20)}", f"l{min(len(body) // 4, 10)}", f"@{body.count('@')}",
                 f".{min(body.count('.'), 4)}", f"+{body[0] == '+'}", f"w{word[1].lower()[:12] if word else ''}")
        out.append(Token(a, b, key, digits, tuple(map(_slot, names)), label))
    return out


def skip_edges(tokens: list[Token]) -> list[tuple[int, int]]:
    """Links between each candidate and the next ones that are the same or end with the same digits.

    A chain through each group of similar tokens, so that their number stays
    that of the tokens.
    """
    last: dict[str, int] = {}
    out = set()
    for i, t in enumerate(tokens):
        keys = [t.key] + ([f"#{t.digits[-9:]}"] if len(t.digits) >= 9 else []) + ([f"%{t.digits[-7:]}"] if len(t.digits) >= 7 else [])
        for k in keys:
            if k in last:
                out.add((last[k], i))
            last[k] = i
    return sorted(out)


@dataclass(frozen=True)
class Field:
    unary: np.ndarray  # SLOTS x labels
    chain: np.ndarray  # labels x labels, log potentials
    skip: np.ndarray


def learn(examples: list[list[Token]], rounds: int = 200, rate: float = 0.5) -> Field:
    """A field from labelled token lists (label 0: no span)."""
    n = len(KINDS) + 1
    rows = []
    for ts in examples:  # an unlabelled repetition of a labelled token teaches nothing: it is what is to be found
        near = {i for a, b in skip_edges(ts) for i in (a, b) if ts[a].label or ts[b].label}
        rows += [t for i, t in enumerate(ts) if t.label or i not in near]
    w = np.zeros((SLOTS, n))
    if rows:
        slots = np.array([t.slots for t in rows])
        y = np.eye(n)[[t.label for t in rows]]
        for _ in range(rounds):
            z = w[slots].sum(1)
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = np.zeros_like(w)
            for k in range(slots.shape[1]):
                np.add.at(g, slots[:, k], p - y)
            w -= rate * (g / len(rows) + 1e-4 * w)
    prior = np.bincount([t.label for t in rows], minlength=n) + 1.0
    prior /= prior.sum()

    def log_odds(pairs):
        c = np.ones((n, n)) * 0.5 + np.eye(n) * 0.5
        for a, b in pairs:
            c[a, b] += 1
            c[b, a] += 1
        return np.clip(np.log(c / c.sum() / np.outer(prior, prior)), -4, 4)

    chain = log_odds((a.label, b.label) for ts in examples for a, b in zip(ts, ts[1:], strict=False)) * 0.25
    # an unlabelled repetition of a labelled token is what the field is to find, so only labelled pairs teach disagreement
    skip = log_odds((ts[i].label, ts[j].label) for ts in examples for i, j in skip_edges(ts) if ts[i].label and ts[j].label)
    skip = np.where(np.eye(n) > 0, np.abs(skip) + REPEATS, np.minimum(skip, -1))
    skip[0, 0] = 0  # two unlabelled repetitions say nothing about each other
    return Field(w, chain, skip)


def marginals(tokens: list[Token], field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities by loopy sum-product; base spans are observed."""
    n, labels = len(tokens), field.unary.shape[1]
    edges = [(i, i + 1, field.chain) for i in range(n - 1)] + [(i, j, field.skip) for i, j in skip_edges(tokens) if j != i + 1]
    edges += [(i, j, field.skip) for i, j in skip_edges(tokens) if j == i + 1]
    unary = field.unary[np.array([t.slots for t in tokens])].sum(1)
    for i, t in enumerate(tokens):
        if t.label:
            unary[i] = -30.0
            unary[i, t.label] = 0.0
    ends = np.array([(i, j) for i, j, _ in edges]).reshape(-1, 2)
    pots = np.array([p for _, _, p in edges]).reshape(-1, labels, labels)
    src = np.r_[ends[:, 0], ends[:, 1]]
    dst = np.r_[ends[:, 1], ends[:, 0]]
    pot = np.concatenate([pots, pots.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(ends)) + len(ends), np.arange(len(ends))]
    msg = np.zeros((len(src), labels))
    belief = unary.copy()
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, dst, msg)
        out = (belief[src] - msg[back])[:, :, None] + pot
        top = out.max(1, keepdims=True)
        new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
        msg = 0.5 * msg + 0.5 * (new - new.max(1, keepdims=True))
    belief = unary.copy()
    np.add.at(belief, dst, msg)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _kind_fits(kind: int, t: Token) -> bool:
    """What a span of a kind must hold at least, whatever its neighbours say."""
    if kind == 1:
        return "@" in t.key or len(t.key) >= 5 and not t.digits == t.key
    return {2: 4 <= len(t.digits) <= 12, 3: 13 <= len(t.digits) <= 19, 4: 7 <= len(t.digits) <= 15}[kind]


def added_spans(text: str, base: list[list[tuple[int, int]]], field: Field) -> list[tuple[int, int, int]]:
    """Kind, start and end of the spans that the field adds."""
    if not any(base):
        return []
    tokens = candidates(text, base)
    if all(t.label for t in tokens):
        return []
    # only tokens with a skip link to a base span, direct or over others, can take its label
    reach = {i for i, t in enumerate(tokens) if t.label}
    edges = skip_edges(tokens)
    grown = True
    while grown:
        grown = False
        for i, j in edges:
            if (i in reach) != (j in reach):
                reach |= {i, j}
                grown = True
    p = marginals(tokens, field)
    out = []
    for i, t in enumerate(tokens):
        kind = int(p[i].argmax())
        if not t.label and i in reach and kind and p[i, kind] >= CERTAIN and _kind_fits(kind, t):
            out.append((kind - 1, t.start, t.end))
    return out


def train_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN,
                max_tokens: int = MAX_TOKENS) -> Field:
    """The field learned from texts that have base spans; without any, a field that adds nothing.

    At most ``max_train`` different (id, text), in hash order, a copy counting
    once, teach it; of a text with more than ``max_tokens`` candidates those
    whose keys come first in hash order, all repetitions of a key together.
    """
    @F.pandas_udf("boolean")
    def any_span(texts: pd.Series) -> pd.Series:
        return pd.Series([any(base_spans(x)) for x in texts], dtype=bool)

    @F.pandas_udf("array<struct<start:int,end:int,key:string,digits:string,slots:array<int>,label:int>>")
    def tokens(texts: pd.Series) -> pd.Series:
        return pd.Series([[(t.start, t.end, t.key, t.digits, list(t.slots), t.label) for t in _some(candidates(x, base_spans(x)), max_tokens)]
                          for x in texts], dtype=object)

    some = F.col(text_col).rlike("[0-9@]")  # no base span is without
    held = docs.filter(some).select(F.col(id_col).cast("string").alias("k"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    chosen = (held.filter(any_span("text")).select(F.coalesce("k", F.lit("")).alias("ck"), F.col("h").alias("ch")).distinct()
              .orderBy(F.xxhash64("ck", "ch"), "ck", "ch").limit(max_train))
    rows = (held.join(F.broadcast(chosen), (F.coalesce("k", F.lit("")) == F.col("ck")) & (F.col("h") == F.col("ch")))
            .groupBy("ck", "ch").agg(F.min("text").alias("text")).select(tokens("text").alias("t")))
    got = [[Token(*r[:4], tuple(r.slots), r.label) for r in x.t] for x in rows.toLocalIterator()]
    return learn(got)


def _some(found: list[Token], most: int) -> list[Token]:
    if len(found) <= most:
        return found
    left, keys = most, set()
    for key, n in sorted(Counter(t.key for t in found).items(), key=lambda x: xxhash.xxh64_intdigest(x[0])):
        if n <= left:
            keys.add(key)
            left -= n
    return [t for t in found if t.key in keys]


def personal_data(text: Column, field: Field) -> Column:
    """Struct of the base counts and spans and of all spans, each as text; null counts as empty."""
    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            t = t or ""
            base = base_spans(t)
            more = added_spans(t, base, field)
            listed = [(k, a, b) for k, spans in enumerate(base) for a, b in spans]
            show = [",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in x) for x in (listed, sorted(listed + more) if more else listed)]
            rows.append((*map(len, base), *show))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])
    return found(text)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` of every row."""
    bounded_batches(docs.sparkSession)
    field = train_field(docs, id_col, text_col, max_train)
    return (docs.select(F.col(id_col).alias("doc_id"), personal_data(F.col(text_col), field).alias("p"))
            .select("doc_id", "p.*"))
