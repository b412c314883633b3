"""Toxicity as a weighted finite-state pattern grammar over clauses.

Reported speech, negation, intent and targets are transducers that mark the
words they govern; insults and threats are transducers that weigh a word by its
mark. Composed, they are one machine that every clause runs through: an insult
or threat adds its weight to the clause, a target word or an intention nearby
raises it, a negation that governs it or a verb of reporting before it lowers
it. The document's evidence is what its matched clauses score, not a count of words.

The insult lexicon and all weights are learned from labelled rows: words whose
use is tied to the toxic label in many different surroundings, and a logistic
model on the clause scores. At most ``MAX_LABELLED`` labelled rows, in the
order of a hash of their ids, are used for that (the documented bound).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_batches, materialize

#: Labelled rows that learning reads at most.
MAX_LABELLED = 20_000
#: Words in the learned lexicon at most.
MAX_LEXICON = 2_000
THRESHOLD = 0.7

# Small closed word classes in English, German, French and Spanish.
TARGET = frozenset("""you your yours yourself he she him her they them their his this that these those the a an
all such people du dich dir dein deine ihr euch er sie der die das ein eine diese dieser tu te toi ton ta vous
votre il elle ils elles le la les un une ce cette ces usted ustedes tus su sus el los las una este esta eres""".split())
NEGATION = frozenset("""not no never neither nor without isn't aren't wasn't don't doesn't didn't won't cannot can't
nicht kein keine keinen nie niemals ohne ne pas jamais aucun aucune sans nunca jamás sin ningún ninguna""".split())
REPORTED = frozenset("""said says say claimed claims reported reports called calls wrote writes told tells quoted quotes
alleged according sagte sagt nannte schrieb behauptet dit disait appelé écrit selon dijo dice llamó escribió según""".split())
THREAT = frozenset("""kill hurt destroy beat burn stab shoot crush punch strangle murder smash töten umbringen
verletzen schlagen verbrennen tuer frapper détruire brûler matar golpear destruir quemar""".split())
INTENT = frozenset("will shall gonna going must should i'll we'll werde werden wirst vais allons voy vamos".split())

_CLAUSE = re.compile(r"[.!?;:\n]+|,\s")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")

# What a word is to the grammar, and what governs a word (PLAIN: nothing does).
OTHER, INSULT, THREATS, REPORTS, NEGATES, INTENDS, TARGETS = range(7)
PLAIN, AIMED, DENIED, QUOTED, MEANT = range(5)
CLASS = ({w: TARGETS for w in TARGET} | {w: INTENDS for w in INTENT} | {w: NEGATES for w in NEGATION} | {w: REPORTS for w in REPORTED}
         | {w: THREATS for w in THREAT})


@dataclass(frozen=True)
class Governor:
    """A transducer that marks the ``reach`` words after one of its own, unless one before it in the cascade has marked them.

    It reads (class, mark, opened) and passes them on. Where a transducer before
    it opens, it closes. ``again``: its own word opens it anew while it is open.
    """

    opens: int
    mark: int
    reach: int
    again: bool

    def step(self, state: int, cls: int, mark: int, opened: bool) -> tuple[int, int, bool]:
        open_, left = state > 0, max(state - 1, 0)
        if opened:
            return 0, mark, True
        if mark == PLAIN and cls == self.opens and (self.again or not open_):
            return self.reach, self.mark if open_ else PLAIN, True
        return left, self.mark if open_ and mark == PLAIN else mark, False


#: The governing transducers in the order of the cascade: reported speech over negation over intent over targets.
GOVERNORS = (Governor(REPORTS, QUOTED, 12, True), Governor(NEGATES, DENIED, 3, True), Governor(INTENDS, MEANT, 4, False),
             Governor(TARGETS, AIMED, 3, False))
#: Output of the insult transducer in each mark, as a factor of the word's weight, and of the threat transducer.
FACTOR = {PLAIN: 1.0, AIMED: 1.25, DENIED: 0.25, QUOTED: 0.35, MEANT: 1.0}
MENACE = {PLAIN: 0.0, AIMED: 0.4, DENIED: 0.0, QUOTED: 0.0, MEANT: 1.0}
SOFTENING = (DENIED, QUOTED)


def compose(governors: tuple[Governor, ...] = GOVERNORS) -> list[list[tuple[int, float, float, int]]]:
    """The cascade with the insult and threat transducers behind it as one machine.

    ``table[state][class]`` is the next state, the factor of an insult, the
    weight of a threat and whether the match is softened. Only states that a
    clause can reach are made, the first is the start.
    """
    number = {(0,) * len(governors): 0}
    todo, table = list(number), []
    while todo:
        row = []
        for cls in range(7):
            states, mark, opened = [], PLAIN, False
            for g, s in zip(governors, todo[0], strict=True):
                s, mark, opened = g.step(s, cls, mark, opened)
                states.append(s)
            to = tuple(states)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            insult, threat = FACTOR[mark] if cls == INSULT else 0.0, MENACE[mark] if cls == THREATS else 0.0
            row.append((number[to], insult, threat, int(cls in (INSULT, THREATS) and mark in SOFTENING)))
        table.append(row)
        todo.pop(0)
    return table


MACHINE = compose()
FEATURES = ("clauses", "strongest", "threats", "softened", "share")


@dataclass(frozen=True)
class Grammar:
    lexicon: dict[str, float]
    weights: tuple[float, ...]
    bias: float


def clause_score(clause_words: list[str], lexicon: dict[str, float]) -> tuple[float, float, int]:
    """Evidence of insult, evidence of threat and number of softened matches of one clause."""
    state = 0
    insult = threat = 0.0
    softened = 0
    for w in clause_words:
        weight = lexicon.get(w)
        cls = CLASS.get(w, OTHER) if weight is None else INSULT
        state, factor, menace, soft = MACHINE[state][cls]
        if cls == INSULT:
            insult = max(insult, weight * factor)
        threat = max(threat, menace)
        softened += soft
    return insult, threat, softened


def _trigger(words) -> re.Pattern:
    return re.compile(r"(?<![^\W\d_])(?:" + "|".join(map(re.escape, sorted(words))) + r")(?![^\W\d_])")


class _Triggers:
    """The words without which a text or a clause has no evidence, and a pattern that finds them; built once for a lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = frozenset(lexicon) | THREAT
        self.pattern = _trigger(self.words)


_triggers: list[tuple[dict[str, float], _Triggers]] = []


def _triggers_of(lexicon: dict[str, float]) -> _Triggers:
    if not _triggers or _triggers[0][0] is not lexicon:
        _triggers[:] = [(lexicon, _Triggers(lexicon))]
    return _triggers[0][1]


def features(text: str | None, lexicon: dict[str, float]) -> tuple[float, ...]:
    """The evidence of a whole text; an empty or null one has none."""
    low = (text or "").lower()
    known = _triggers_of(lexicon)
    triggers = known.words
    if not low or not known.pattern.search(low):
        return (0.0,) * len(FEATURES)
    total = strongest = threats = 0.0
    softened = n = 0
    for clause in _CLAUSE.split(low):
        ws = _WORD.findall(clause)
        if not ws:
            continue
        n += 1
        if triggers.isdisjoint(ws):
            continue
        insult, threat, soft = clause_score(ws, lexicon)
        total += insult
        strongest = max(strongest, insult)
        threats += threat
        softened += soft
    return (float(np.log1p(total)), strongest, float(np.log1p(threats)), float(np.log1p(softened)),
            float(np.sqrt(total / max(n, 1))))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
              usable: Column, max_labelled: int) -> DataFrame:
    marks = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    chosen = marks.filter(usable).orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), "doc_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialize(texts.join(F.broadcast(chosen), "doc_id").select("text", "y"), "toxicity-labelled")


def learn_lexicon(labelled: DataFrame, max_lexicon: int = MAX_LEXICON) -> dict[str, float]:
    """Words tied to the toxic label in many surroundings, with log-odds weights scaled to at most 1.

    Copies of a text count once, and a word needs many different words before
    it, so that what one much-copied document says is not taken for a rule.
    """
    def uses(batches):
        def counted(seen):
            return pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["w", "b", "y", "n"])

        for pdf in batches:
            seen: dict[tuple[str, str, int], int] = {}
            for text, y in zip(pdf["text"], pdf["y"], strict=True):
                ws = _WORD.findall(text.lower())
                first: dict[str, str] = {}
                for before, w in zip(["", *ws], ws, strict=False):
                    first.setdefault(w, before)
                for w, before in first.items():
                    k = (w, before if y else "", int(y))
                    seen[k] = seen.get(k, 0) + 1
                if len(seen) > 100_000:
                    yield counted(seen)
                    seen = {}
            yield counted(seen)

    once = labelled.groupBy(F.sha2("text", 256).alias("k")).agg(F.first("text").alias("text"), F.max("y").alias("y"))
    n_doc = {r.y: r["count"] for r in once.groupBy("y").count().collect()}
    pos, neg = n_doc.get(1, 0), n_doc.get(0, 0)
    if not pos or not neg:
        return {}
    per = (once.mapInPandas(uses, "w string, b string, y int, n long").groupBy("w", "b", "y").agg(F.sum("n").alias("n"))
           .groupBy("w").agg(F.sum(F.expr("if(y = 1, n, 0)")).alias("p"), F.sum(F.expr("if(y = 0, n, 0)")).alias("q"),
                             F.count(F.expr("if(y = 1, 1, null)")).alias("around")))
    odds = F.log((F.col("p") + 0.5) / (pos + 1)) - F.log((F.col("q") + 0.5) / (neg + 1))
    found = (per.withColumn("odds", odds)
             .filter((F.col("p") >= max(4, 0.01 * pos)) & (F.col("around") >= 0.25 * F.col("p")) & (F.col("around") >= 3)
                     & (F.col("odds") >= 2.5))
             .orderBy(F.desc("odds"), "w").limit(max_lexicon).collect())
    top = max((r.odds for r in found), default=1.0)
    return {r.w: r.odds / top for r in found}


def _fit(x: np.ndarray, y: np.ndarray, times: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps over rows that count so many times; the last value is the bias."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    pen = np.full(len(w), ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (times * (p - y)) + pen * w
        h = (a * (times * p * (1 - p))[:, None]).T @ a + np.diag(pen + 1e-6)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          usable: Column | None = None, max_labelled: int = MAX_LABELLED) -> Grammar:
    """The grammar learned from labelled rows for which ``usable`` (over ``doc_id``) holds.

    Without both labels the grammar knows only threats, with fixed weights.
    """
    bounded_batches(docs.sparkSession)
    labelled = _labelled(docs, labels, id_col, text_col, label_col, F.lit(True) if usable is None else usable, max_labelled)
    lexicon = learn_lexicon(labelled)
    if not lexicon:
        return Grammar({}, (0.0, 0.0, 4.0, -1.0, 0.0), -3.0)

    @F.pandas_udf("array<double>")
    def row(texts: pd.Series) -> pd.Series:
        return pd.Series([list(features(t, lexicon)) for t in texts], dtype=object)

    # equal feature rows are counted, so the driver gets few rows
    got = labelled.groupBy(row("text").alias("x"), "y").count().collect()
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got], float)
    n = np.array([r["count"] for r in got])
    w = _fit(x, y, n)
    w[2] = max(w[2], 4.0)  # threats may be absent from the labelled rows
    return Grammar(lexicon, tuple(w[:-1].tolist()), float(w[-1]))


def score(grammar: Grammar, text: Column) -> Column:
    """Probability of the toxic label; empty and null texts get the score of no evidence."""
    weights, bias, lexicon = np.array(grammar.weights), grammar.bias, grammar.lexicon

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        z = [float(np.dot(weights, features(t, lexicon)) + bias) for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))), dtype="float64")
    return scored(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, usable: Column | None = None, text_col: str = "text",
               threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` whose score stays under ``threshold``, with all their columns."""
    grammar = learn(docs, labels, text_col=text_col, usable=usable, **options)
    return docs.filter(score(grammar, F.col(text_col)) < threshold)
