"""Phrases, SimHash components and vector codes against brute force, on awkward rows, and through their registered queries."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash

from docexport.llm import phrases, queries, simhash, vector_codes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, shard string, phrase string, number long, fp string, path string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "p", 7, "f", "x") for i, t, lang in rows], SCHEMA).repartition(3)


# -- phrases ---------------------------------------------------------------

def phrases_by_force(rows, least, width=5, per_lang=2000):
    count, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            count[lang].update(tuple(w[i:i + k]) for k in range(1, width + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in count.items():
        many = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {p[i:j] for p, a in many.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and c[p[i:j]] == a}
        found = []
        for p, a in many.items():
            if p not in inside:
                score, _, left, right = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:per_lang])]
    return sorted(out)


def phrase_rows():
    r = random.Random(5)
    words = ["a", "the", "of", "b\x01", "b", "New", "york", "é", "x y", "city"]
    rows = [(i, " ".join(r.choice(words) + r.choice(["", "", "", ".", ",", "\n", "\t"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None])) for i in range(120)]
    rows += [(None, None, "en"), (200, "", "en"), (201, " \t ", None), (202, "...!?", "fr"), (203, "solo", "fr")]
    rows += [(204, "the same line of words", "en")] * 40
    rows += [(205, " ".join(r.choice(words) for _ in range(20_000)), "de")]
    return rows


@pytest.mark.parametrize("least,shard,sweep,window,lookups", [(3, 12 << 20, 1 << 20, 1 << 19, 1 << 19), (5, 4000, 64, 50, 40)])
def test_phrases_are_those_of_brute_force(spark, monkeypatch, least, shard, sweep, window, lookups):
    """Also with so small shards, sweeps, ranges and lookups that every hot prefix is split."""
    for name, value in (("SHARD_BYTES", shard), ("SWEEP", sweep), ("RANGE_WINDOWS", window), ("LOOKUPS", lookups)):
        monkeypatch.setattr(phrases, name, value)
    rows = phrase_rows()
    got = phrases.mine_phrases(frame(spark, rows), least=least, per_lang=50)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_force(rows, least, per_lang=50)


def test_phrases_of_nothing(spark):
    empty = phrases.mine_phrases(frame(spark, []))
    assert empty.collect() == [] and len(empty.columns) == 8
    assert phrases.mine_phrases(frame(spark, [(1, "too few words", "en"), (2, None, None)])).collect() == []


def test_phrase_scores_are_exact_beyond_64_bits():
    """The product of the numerator in wide decimals, by the expression of the job."""
    a, n = 9_000_000_000_000, 123_456_789_012_345
    assert 1000 * a * n > 1 << 64 and 1000 * a * n < 10 ** 38


def test_transducers_keep_windows_share_chains_and_compose():
    r = np.random.default_rng(1)
    rows = phrases.windows_of(r.integers(0, 4, 5000), 5)
    assert (rows[:, 1] > 0).all() and not ((rows[:, :-1] == 0) & (rows[:, 1:] > 0)).any()
    rows, weights = phrases.sum_windows(rows, np.ones(len(rows), np.int64))
    assert list(map(tuple, rows.tolist())) == sorted(set(map(tuple, rows.tolist())))
    back, load = phrases.paths(phrases.build(rows, weights))
    assert (back == rows).all() and (load == weights).all()
    machine = phrases.Transducer(rows, weights)
    known = dict(zip(map(tuple, rows.tolist()), weights.tolist(), strict=True))
    asked = np.array([p for k in range(1, 6) for p in (q + (0,) * (5 - k) for q in itertools.product((1, 2, 3, 4), repeat=k))], np.int64)
    assert machine.compose(asked).tolist() == [known.get(tuple(p), -1) for p in asked.tolist()]
    one = np.array([[i, 9, 9, 9, 9] for i in range(1, 200)], np.int64)  # a chain after each first word is one chain
    assert len(phrases.build(one, np.ones(199, np.int64))) < 199 * 5 * 2


def test_prefix_keys_sort_as_numbers():
    r = np.random.default_rng(2)
    rows = r.integers(0, 1 << 40, (500, 5))
    rows[::3, 3:] = 0
    rows[::7] &= 0xFF
    order = np.lexsort(rows.T[::-1])
    assert (np.argsort(phrases.as_keys(rows), kind="stable") == order).all()


# -- SimHash ---------------------------------------------------------------

def fingerprint_by_force(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_force(ids, prints):
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    links = [0] * len(ids)
    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            links[i] += 1
            links[j] += 1
            up[find(i)] = find(j)
    group = collections.defaultdict(list)
    for i, x in enumerate(ids):
        group[find(i)].append(x)
    return [(min((x for x in group[find(i)] if x is not None), default=None), links[i]) for i in range(len(ids))]


def simhash_rows():
    r = random.Random(3)
    words = ["".join(r.choice("abcdeé") for _ in range(4)) for _ in range(300)]
    base = [r.choice(words) for _ in range(400)]
    rows = [(0, None, "en"), (1, "", "en"), (None, " \n", "en"), (3, "One", "en"), (4, "ONE", "en"), (5, "one two", "en"), (6, "one  Two", "en")]
    for i in range(7, 120):
        w = list(base) if i % 2 else [r.choice(words) for _ in range(r.randint(1, 60))]
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w), "en"))
    rows += [(500, " ".join(base), "en")] * 50 + [(None, "no id at all here", "en")]
    rows.append((501, " ".join(r.choice(words) for _ in range(100_000)), "en"))
    return rows


@pytest.mark.parametrize("large,held", [(1 << 14, 1 << 17), (64, 20)])
def test_simhash_components_are_those_of_brute_force(spark, monkeypatch, large, held):
    monkeypatch.setattr(simhash, "LARGE", large)
    monkeypatch.setattr(simhash, "ROWS", held)
    rows = simhash_rows()
    prints = [fingerprint_by_force(t) for _, t, _ in rows]
    want = [(i, p, c, n) for (i, _, _), p, (c, n) in zip(rows, prints, components_by_force([x[0] for x in rows], prints), strict=True)]
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component, r.n_links) for r in simhash.near_duplicates(frame(spark, rows)).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert max(n for *_, n in want) > 60


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_every_pair_within_the_budget_meets_once():
    """For each set of up to three differing bits one subtree of the first level joins the pair, and one of every deeper level."""
    r = random.Random(1)
    for bits in [(), *itertools.combinations(range(64), 1), *(tuple(r.sample(range(64), r.choice([2, 3]))) for _ in range(500))]:
        z = sum(1 << b for b in bits)
        meets = [""]
        for _ in range(3):
            meets = [p + d for p in meets for d in "0123" if not z & simhash.masks_of(p + d)[0] and all(z & m for m in simhash.masks_of(p + d)[1])]
            assert len(meets) == 1


def test_trie_self_join_gives_every_near_pair_once():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 5, dtype=np.int64).astype(np.uint64)
    keys = np.unique(np.concatenate([base ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (4, 5)).astype(np.uint64), axis=0) for _ in range(60)]))
    starts = np.array([0, 40, 41])
    group = np.searchsorted(starts, np.arange(len(keys)), side="right")
    got = collections.Counter(tuple(sorted(p)) for a, b in simhash.Trie(keys, starts).self_join(3) for p in zip(a.tolist(), b.tolist(), strict=True))
    want = {(i, j) for i, j in itertools.combinations(range(len(keys)), 2) if group[i] == group[j] and int(keys[i] ^ keys[j]).bit_count() <= 3}
    assert set(got) == want and set(got.values()) <= {1} and want


# -- vector codes ----------------------------------------------------------

def codes_by_force(rows, rounds=6):
    keep = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(keep[0][1]) // 8
    part = [[v[p * size:(p + 1) * size] for p in range(8)] for _, v, _ in keep]
    first = sorted(range(len(keep)), key=lambda k: (keep[k][0] is None, keep[k][0] or 0, keep[k][1]))[:16]
    books = [[list(part[k][p]) for k in first] for p in range(8)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            mine = collections.defaultdict(list)
            for x in part:
                mine[best(x[p], books[p])[1]].append(x[p])
            for k, xs in mine.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    coded = [[best(x[p], books[p]) for p in range(8)] for x in part]
    by_label = collections.Counter()
    for (_, _, label), c in zip(keep, coded, strict=True):
        by_label[label] += sum(d for d, _ in c)
    out = [(i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), by_label[label]) for (i, _, label), c in zip(keep, coded, strict=True)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vector_frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, label, "k", "r", "p") for i, v, label in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, key string, rid string, position string").repartition(3)


def vector_rows(scale=1.0, n=150):
    r = np.random.default_rng(8)
    rows = [(i, (scale * r.normal(size=16)).astype(np.float32).tolist(), int(i) % 4 if i % 5 else None) for i in range(n)]
    rows += [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [None] + [0.0] * 15, 1), (903, [float("inf")] + [0.0] * 15, 1)]
    rows += [(None, rows[3][1], None), rows[4], (904, [0.0] * 16, 2)] + [(2000 + i, rows[7][1], 3) for i in range(200)]
    return rows


def check_codes(spark, rows, kind="float"):
    coded, books = vector_codes.compress_vectors(vector_frame(spark, rows, kind))
    want, digest = codes_by_force(rows)
    got = [(r.vec_id, f"{r.codes & (1 << 64) - 1:016x}", r.error, r.label_error) for r in coded.collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert vector_codes.books_digest(books) == digest


@pytest.mark.parametrize("rows,kind", [(vector_rows(), "float"), (vector_rows(1e5, 40), "double"), (vector_rows(n=5)[:5], "float"),
                                       ([(i, [0.25] * 8, None) for i in range(30)], "float")])
def test_vector_codes_are_those_of_brute_force(spark, rows, kind):
    check_codes(spark, rows, kind)


def test_vector_codes_of_nothing_and_of_bad_lengths(spark):
    for rows in ([], [(1, None, 2)]):
        coded, books = vector_codes.compress_vectors(vector_frame(spark, rows))
        assert coded.collect() == [] and vector_codes.books_digest(books) == hashlib.sha256(b"").hexdigest()
    for rows in ([(1, [1.0] * 12, 0)], [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)]):
        with pytest.raises(ValueError, match="equal parts"):
            vector_codes.compress_vectors(vector_frame(spark, rows))


@pytest.mark.parametrize("axes,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(axes, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    key = vector_codes.hilbert_keys(grid, bits)
    assert sorted(key.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    r = np.random.default_rng(6)
    parts = r.integers(-50, 50, (30, 20, 4))
    entries = r.integers(-60, 60, (30, 16, 4))
    listed = vector_codes.shortlists(parts.min(axis=1), parts.max(axis=1), entries)
    for k in range(30):
        apart = ((parts[k][:, None] - entries[k][None]) ** 2).sum(axis=2)
        code, error = vector_codes.nearest(parts[k], entries[k], np.flatnonzero(listed[k]))
        assert (code == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    near = vector_codes.shortlists(np.zeros((1, 2), int), np.ones((1, 2), int), np.array([[[0, 0], [90, 90]]]))
    assert near.tolist() == [[True, False]]


# -- registered queries ----------------------------------------------------

def test_queries_return_the_contract(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op11_weighted_automata"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(map(tuple, got.collect())) == phrases_by_force(docs, 100)
    got = queries.QUERIES["op12_trie_self_join"](spark, SF).collect()
    prints = [fingerprint_by_force(t) for _, t, _ in docs]
    want = [(i, f"{p:016x}", c) for (i, _, _), p, (c, _) in zip(docs, prints, components_by_force([d[0] for d in docs], prints), strict=True)]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(want)
    vectors = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, digest = codes_by_force(vectors)
    got = queries.QUERIES["op13_hilbert_blocks"](spark, SF).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {digest}
