"""Bounds and methods of the text operators: even buckets, wide counts, whole style trees, templates, bounded driver rows."""

import collections
import math
import random
import tracemalloc
import types

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docexport.llm import bpe, decontaminate, ngram_join, ppm, queries, site_style, skip_crf, suffix_dedup, toxicity

SF = "/root/testdata/sf0.01"


# -- repeated strings ------------------------------------------------------

def test_anchor_buckets_are_even(spark):
    keys = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        if len(data) >= suffix_dedup.LENGTH:
            keys.append(suffix_dedup.anchors(data)[3])
    keys = np.unique(np.concatenate(keys))
    sizes = np.bincount(suffix_dedup.bucket_of(keys, 6), minlength=64)
    assert sizes.min() > 0 and sizes.max() < 4 * sizes.mean()


def test_counts_are_64_bits_wide():
    for counts in ([1, 2, 255], [1, 65_535], [70_000], [1 << 33, 1], []):
        cell = suffix_dedup.pack_counts(np.array(counts, np.int64))
        assert suffix_dedup.unpack_counts(cell).tolist() == counts
    family = suffix_dedup.IndexFamily()
    key = np.array([7], np.uint64)
    for n in (1 << 32, 1):
        family.add(key, np.array([n], np.int64))
    assert family.total(key).tolist() == [(1 << 32) + 1]


# -- site style trees ------------------------------------------------------

def pages_of(spark, htmls, host="a.example"):
    return spark.createDataFrame([(i, f"http://{host}/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def texts_of(df):
    return [r.text for r in site_style.extract_main_text(df).orderBy("page_id").collect()]


def test_the_tree_alone_drops_what_every_page_repeats(spark):
    """Boilerplate without a telling tag, role or class goes where the site repeats it, and stays on a page of its own."""
    html = [f"<body><div class='x1'><span>Home</span> News Shop</div><div class='x2'><p>Story {i} about {'abc'[i % 3] * (i + 1)}.</p></div>"
            f"<div class='x3'><p>All rights of example.</p></div></body>" for i in range(8)]
    assert texts_of(pages_of(spark, html)) == [f"Story {i} about {'abc'[i % 3] * (i + 1)}." for i in range(8)]
    assert texts_of(pages_of(spark, html[:1])) == ["Home News Shop Story 0 about a. All rights of example."]


def test_menus_and_footers_are_in_the_tree(spark):
    html = [f"<body><nav>Home Shop</nav><article><p>Text number {i} here.</p></article><footer>Imprint</footer></body>" for i in range(6)]
    importance = {r.path: r.importance for r in site_style.style_importance(pages_of(spark, html)).collect()}
    assert importance["/body/nav"] < site_style.LOW_IMPORTANCE and importance["/body/footer"] < site_style.LOW_IMPORTANCE
    assert importance["/body/article/p"] > site_style.LOW_IMPORTANCE


def test_importance_is_that_of_brute_force(spark):
    rng = random.Random(2)
    html = ["<body>" + "".join(f"<div class='{c}'>{rng.choice(['one', 'two', 'three'])}</div>" for c in rng.sample(["p", "q", "r", "s"], 3))
            + f"<h1>{i}</h1></body>" for i in range(12)]
    seen = collections.defaultdict(lambda: (set(), collections.Counter(), collections.Counter()))
    html += html[:2]  # pages with equal blocks count once
    for h in set(html):
        here = {}
        for n in site_style.parse(h)[1]:
            here.setdefault(n.path, (set(), set()))
            here[n.path][0].add(" ".join(n.text))
            here[n.path][1].add(" ".join(n.children))
        for path, (contents, styles) in here.items():
            seen[path][0].add(h)
            seen[path][1].update(contents)
            seen[path][2].update(styles)
    got = {r.path: r for r in site_style.style_importance(pages_of(spark, html)).collect()}
    assert set(got) == set(seen)
    for path, (pages, contents, styles) in seen.items():
        m = len(pages)
        assert got[path].pages == m
        if m < 2:
            assert got[path].importance == 1.0
            continue
        content = 1 - sum(map(math.log, contents.values())) / len(contents) / math.log(m)
        style = 1 - sum(n * math.log(n) for n in styles.values()) / m / math.log(m)
        assert got[path].importance == pytest.approx(site_style.PRESENTATION * style + (1 - site_style.PRESENTATION) * content)


def test_what_an_article_holds_stays(spark):
    html = ["<body><article><p>Sum <math><mi>x</mi></math> of <label>weights</label>.</p><map>Chart</map></article><label>Search</label></body>",
            "<body><form id='aspnet'><div><p>A whole page inside one form keeps its text.</p></div></form></body>",
            "<body><article><p>Long enough running text of the article itself.</p><form>Name <input> Send</form></article></body>", "", None]
    assert texts_of(pages_of(spark, html)) == ["Sum x of weights. Chart", "A whole page inside one form keeps its text.",
                                               "Long enough running text of the article itself.", "", ""]


# -- bounded driver rows ---------------------------------------------------

CARD = "card 4111 1111 1111 1111 of"


def test_copies_teach_the_field_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(skip_crf, "learn", lambda got: seen.append(got))
    rows = [(1, f"{CARD} mine")] * 20_000 + [(2, f"write to a@b.example or {i}") for i in range(3)] + [(3, "nothing 12"), (None, f"{CARD} none"), (4, None)]
    skip_crf.train_field(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert len(seen[0]) == 5  # the spaced card, three mails and the row without an id
    assert sum(t.label == 3 for ts in seen[0] for t in ts) == 2


def test_long_texts_teach_whole_repetitions(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(skip_crf, "learn", lambda got: seen.append(got))
    text = "a@b.example " + " ".join(f"no {i:07d}x" for i in range(900)) + " a@b.example again"
    skip_crf.train_field(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert len(seen[0][0]) > 800 and [t.key for t in seen[0][0]].count("abexample") == 2
    short = skip_crf._some(seen[0][0], 100)
    counts = collections.Counter(t.key for t in seen[0][0])
    assert 50 < len(short) <= 100 and all(n == counts[k] for k, n in collections.Counter(t.key for t in short).items())


def test_base_spans_are_those_of_a_plain_scan():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["1", "23", "@", ".", "a.b", "-", " ", "+", "4111111111111111", "(", "255", "x@y.z", "é", "999"]) for _ in range(rng.randint(0, 30)))
        email, ip, card, phone = skip_crf.base_spans(text)
        assert email == [m.span() for m in skip_crf.EMAIL.finditer(text)]
        assert ip == [m.span() for m in skip_crf.IP.finditer(text) if max(int(x) for x in m[0].split(".")) <= 255]

        def digits(m):
            return [int(c) for c in m[0] if c in "0123456789"]

        def luhn(ds):
            return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(ds))) % 10 == 0
        assert card == [m.span() for m in skip_crf.CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
        assert phone == [m.span() for m in skip_crf.PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_marginals_of_a_tree_are_exact():
    """On a chain without skip links the messages give the marginals of enumeration."""
    import itertools
    rng = np.random.default_rng(3)
    field = skip_crf.Field(rng.normal(size=(skip_crf.SLOTS, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    tokens = [skip_crf.Token(i, i + 1, f"key{i}", "", (i * 3, i * 3 + 1), 0) for i in range(4)]
    assert skip_crf.skip_edges(tokens) == []
    unary = np.array([field.unary[list(t.slots)].sum(0) for t in tokens])
    total = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        w = math.exp(sum(unary[i, x] for i, x in enumerate(labels)) + sum(field.chain[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        for i, x in enumerate(labels):
            total[i, x] += w
    got = skip_crf.marginals(tokens, field, rounds=60)
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-6)


def test_repeated_labelled_rows_reach_the_driver_as_counts(spark, monkeypatch):
    seen, fit = [], toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda x, y, times: seen.append((len(x), times.sum())) or fit(x, y, times))
    bad = [f"you are a {w} worthless idiot" for w in "red green blue old new big".split()]
    rows = [(i, t) for i, t in enumerate(bad + [f"a quiet day number {i}" for i in range(6)])]
    labels = [(i, int(i < 6)) for i in range(12)]
    docs = spark.createDataFrame(rows + rows[:1] * 3000 + rows[6:7] * 3000, "doc_id long, text string")
    grammar = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert seen and seen[0][0] <= 12 and seen[0][1] == 6012
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(grammar, F.col("text")).alias("s")).distinct().collect()}
    assert min(scores[i] for i in range(6)) > max(scores[i] for i in range(6, 12))


def test_weights_fit_as_repeated_rows_do():
    rng = np.random.default_rng(5)
    x, y, n = rng.normal(size=(30, 3)), rng.integers(0, 2, 30).astype(float), rng.integers(1, 9, 30)
    assert np.allclose(toxicity._fit(x, y, n), toxicity._fit(np.repeat(x, n, axis=0), np.repeat(y, n), np.ones(n.sum())))


# -- decontamination -------------------------------------------------------

def test_the_search_runs_once_for_each_part(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven", 5)], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([("a", "one two three four five six seven eight nine ten"), ("b", "other words here")], "item_id string, text string")
    for part_words in (100_000, 5):
        out = decontaminate.remove_benchmark_passages(docs, items, part_words=part_words)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        found = decontaminate.contamination(docs, items, part_words=part_words)
        assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
        assert [(r.n_words, r.n_hit, list(r["items"])) for r in found.collect()] == [(11, 10, ["a"])]
        assert decontaminate.remove_benchmark_passages(docs, items, part_words=part_words).collect() == []


def test_held_out_is_false_without_an_id(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,), (3,)], "doc_id long")
    got = rows.select("doc_id", F.coalesce(~queries.learnable(), F.lit(False)).alias("h")).collect()
    assert all(r.h is not None for r in got) and not got[0].h


# -- templates in the n-gram join ------------------------------------------

def template_rows(n, own, seed=1):
    """Texts of 100 words on one template, each with some words of its own spread over it."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(n):
        w = list(base)
        for k in range(own):
            w[10 + k * 30] = f"own{i}x{k}"
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    return rows


def shingle_set(text):
    w = text.split()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)}


def test_a_template_without_links_forms_no_tiles(spark, monkeypatch):
    """300 texts with three own words each share most shingles, too few for a link: no pair of tiles is formed."""
    formed = []
    plain = ngram_join._tile_pairs

    def pairs(tiles, percent):
        out = plain(tiles, percent)
        formed.append((tiles.count(), out.count()))
        return out
    monkeypatch.setattr(ngram_join, "_tile_pairs", pairs)
    rows = template_rows(300, 3)
    a, b = shingle_set(rows[0][1]), shingle_set(rows[1][1])
    assert 100 * len(a & b) < 85 * len(a | b)
    found, _ = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.filter("n_links > 0").count() == 0 and formed == [(1, 0)]


@pytest.mark.parametrize("tile", [7, 2048])
def test_links_among_templates_are_those_of_brute_force(spark, monkeypatch, tile):
    """Two templates, texts with no, one, two or three own words, and a few copies."""
    monkeypatch.setattr(ngram_join, "CLUSTER_TILE", tile)
    rng = random.Random(3)
    rows = []
    for i in range(120):
        base = [f"{'ab'[i % 2]}{k}" for k in range(100)]
        for k in range(rng.randint(0, 3)):
            base[rng.randrange(100)] = f"own{i}x{k}"
        rows.append((i, " ".join(base[:rng.choice([100, 100, 96, 90])])))
    rows += [(200, rows[0][1]), (201, rows[0][1])]
    sets = [(i, shingle_set(t)) for i, t in rows]
    want = collections.Counter((i, sum(100 * len(s & t) >= 85 * len(s | t) for _, t in sets) - 1) for i, s in sets)
    found, links = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert collections.Counter((r.doc_id, r.n_links) for r in found.collect()) == want
    assert max(n for _, n in want) > 20


def test_many_templated_texts_cost_no_pairs(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ngram_join, "_cluster_links", lambda percent: seen.append(percent) or (lambda key, table: (_ for _ in ()).throw(AssertionError("a tile was formed"))))
    rows = spark.createDataFrame(template_rows(4000, 3), "doc_id long, text string").repartition(4)
    found, links = ngram_join.similar_documents(rows)
    assert seen and found.count() == 4000 and found.filter("n_links > 0").count() == 0 and links.count() == 0


# -- code points -----------------------------------------------------------

def test_every_code_point_is_split_as_the_library_does():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBPE(path)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for lo in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}b {chr(c)}1" for c in points[lo:lo + 50_000]]
        assert own.encode(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


# -- clause grammar --------------------------------------------------------

def govern_by_hand(classes):
    """What governs each word of a clause, by looking back from it: the last opening that holds, and until where."""
    t, out, mark, until = toxicity, [], toxicity.PLAIN, -1
    for i, c in enumerate(classes):
        if i > until:
            mark = t.PLAIN
        out.append(mark)
        if c == t.REPORTS:
            mark, until = t.QUOTED, i + 12
        elif c == t.NEGATES and out[i] != t.QUOTED:
            mark, until = t.DENIED, i + 3
        elif c == t.INTENDS and out[i] in (t.PLAIN, t.AIMED):
            mark, until = t.MEANT, i + 4
        elif c == t.TARGETS and out[i] == t.PLAIN:
            mark, until = t.AIMED, i + 3
    return out


def test_the_composed_machine_takes_every_path_as_by_hand():
    import itertools
    assert len(toxicity.MACHINE) == 1 + 12 + 3 + 4 + 3
    rng = random.Random(1)
    paths = [*itertools.product(range(7), repeat=5), *([rng.randrange(7) for _ in range(rng.randint(6, 40))] for _ in range(3000))]
    for classes in paths:
        state = 0
        for c, mark in zip(classes, govern_by_hand(classes), strict=True):
            state, factor, menace, soft = toxicity.MACHINE[state][c]
            assert factor == (toxicity.FACTOR[mark] if c == toxicity.INSULT else 0)
            assert menace == (toxicity.MENACE[mark] if c == toxicity.THREATS else 0)
            assert soft == (c in (toxicity.INSULT, toxicity.THREATS) and mark in toxicity.SOFTENING)


def test_without_a_governor_nothing_is_marked():
    assert toxicity.compose(()) == [[(0, 1.0 if c == toxicity.INSULT else 0.0, 0.0, 0) for c in range(7)]]
    only = toxicity.compose(toxicity.GOVERNORS[:1])
    assert len(only) == 13 and only[1][toxicity.INSULT][1] == toxicity.FACTOR[toxicity.QUOTED]


# -- blocks of bounded bytes -----------------------------------------------

def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    from docexport.llm import common
    monkeypatch.setattr(common, "BLOCK_BYTES", 4000)
    rows = [(i, "x" * (3000 if i % 5 == 0 else 20)) for i in range(100)] + [(200, "y" * 20_000), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    blocks = common.to_blocks(docs)
    assert blocks.columns == ["rid", "doc_id", "text", "block"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in blocks.collect()) == sorted((i is None, i or 0, t or "") for i, t in rows)
    size = collections.Counter()
    for r in blocks.collect():
        size[r.block] += len(r.text)
    assert len(size) > 12 and sorted(size.values())[-2] < 5 * 4000
    monkeypatch.setattr(common, "BLOCK_BYTES", 1 << 20)
    assert {r.block for r in common.to_blocks(docs).collect()} == {0}


def test_operators_over_dealt_blocks(spark, monkeypatch):
    """Joins and repeated strings give the same where texts are too long for common blocks."""
    from docexport.llm import common
    rows = template_rows(60, 1) + [(100 + i, f"{'word ' * 80}tail {i} " * 3) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)

    def results():
        found = ngram_join.similar_components(docs).select("doc_id", "n_ngrams", "n_links", "component").collect()
        cut = suffix_dedup.repeated_strings(docs).select("doc_id", "runs", "kept_sha256").collect()
        return sorted(map(str, found)), sorted(map(str, cut))
    plain = results()
    monkeypatch.setattr(common, "BLOCK_BYTES", 3000)
    assert results() == plain


# -- units of the byte trie ------------------------------------------------

def test_passes_of_the_trie_hold_little_beside_a_unit(monkeypatch):
    """Text, one number of 64 bits a byte and distinct grams and words: also when units follow each other."""
    monkeypatch.setattr(ppm, "CHUNK", 1 << 15)
    monkeypatch.setattr(ppm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(4)
    known = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(200)]
    texts = [" ".join(rng.choices(known, k=800)) for _ in range(400)]
    [unit] = ppm._units([pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": texts})])
    size = unit.column("bytes")[0].as_py()
    assert size > 1 << 20

    def held(f):
        tracemalloc.start()
        out = f()
        most = tracemalloc.get_traced_memory()[1] / size
        tracemalloc.stop()
        return out, most

    def sent(send):
        return held(lambda: [x for i, x in enumerate(send([unit] * 3)) if not i])

    [words], of_words = sent(ppm._send_words(3))
    [grams], of_grams = sent(ppm._send_grams(3))
    counted, of_counts = held(lambda: list(ppm._short_counts([unit] * 3)))
    short = {b.column("length")[0].as_py(): (b.column("gram").to_numpy().astype(np.uint64), b.column("n").to_numpy() // 3) for b in counted}
    words, grams = (pa.Table.from_batches([x]) for x in (words, grams))
    found = [ppm._answer_words(words.slice(i, 1)) for i in range(len(words))]
    answers = pa.concat_tables([*(ppm._score_grams(short)(grams.slice(i, 1)) for i in range(len(grams))),
                                *(t.select(["unit", "words", "found"]).add_column(1, "subtree", pa.array([-1] * len(t), pa.int32())) for t in found)])
    scored, of_documents = held(lambda: ppm._score_documents(3, sum(t.column("n")[0].as_py() for t in found), 200, 0)(pa.Table.from_batches([unit]), answers))
    assert len(scored) == 400 and set(scored.column("n_known").to_pylist()) == {800}
    assert of_words < 15 and of_grams < 18 and of_counts < 10 and of_documents < 18, (of_words, of_grams, of_counts, of_documents)


@pytest.mark.parametrize("chunk", [5, 1000, 1 << 19])
@pytest.mark.parametrize("letters", ["abcdef", "".join(map(chr, [*range(33, 65), *range(97, 127), *range(0x400, 0x800), *range(0x4E00, 0x9000, 97)]))])
def test_steps_of_texts_in_chunks(monkeypatch, chunk, letters):
    """Few letters: gram and text sort as one number; many letters in many texts: that takes more than 64 bits."""
    monkeypatch.setattr(ppm, "CHUNK", chunk)
    rng = random.Random(5)
    raw = [ppm.running(ppm.tokens("".join(rng.choices(letters + " ", k=rng.randint(0, 40))))) for _ in range(300)]
    sizes = np.array([len(x) for x in raw], np.int64)
    g = ppm.Grams(ppm._GAP.join([b"", *raw]), sizes)
    assert ((ppm.ORDER + 1) * g.bits + len(raw).bit_length() > 64) == (len(letters) > 6)
    at = [(i, x[max(0, j - ppm.ORDER):j + 1]) for i, x in enumerate(raw) for j in range(1, len(x))]
    gram = g.grams()
    assert g.keys(gram).tolist() == [len(x) - 1 << 56 | int.from_bytes(x, "big") for _, x in at]
    distinct, place = np.unique(gram, return_inverse=True)
    order, tree, sent = ppm._in_order(g, distinct, 4)
    assert ppm.from_sent(sent).tolist() == g.keys(distinct[order]).tolist() and (np.diff(tree.astype(int)) >= 0).all()
    cost = np.array([rng.randrange(1 << 20) for _ in distinct], np.float64)
    expected = np.bincount([i for i, _ in at], weights=cost[place], minlength=len(raw))
    assert ppm._text_steps(g, 4, {int(t): cost[order[tree == t]] for t in set(tree.tolist())}).tolist() == expected.tolist()
