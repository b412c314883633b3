"""The registered queries on whole small tables: their columns, types and values against plain Python."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from docexport.llm import queries, skip_crf, toxicity

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def items(spark):
    return [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def run(spark, name, **kinds):
    """Rows by id, after a look at the contract's columns and types."""
    got = queries.QUERIES[name](spark, SF)
    assert {f.name: f.dataType.simpleString() for f in got.schema if f.name in kinds} == kinds
    return got.collect()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def test_op1(spark, docs):
    got = run(spark, "op1_minimax_shards", doc_id="bigint", size="bigint", text_crc32="bigint", law="string", shard="int", slot="bigint", grown_shard="int")
    text = dict(docs)
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 16
    for s, rows in itertools.groupby(sorted(got, key=lambda r: (r.shard, r.slot)), key=lambda r: r.shard):
        assert [r.slot for r in rows] == list(range(sum(x.shard == s for x in got)))
    assert all(len({r.shard for r in got if text[r.doc_id] == t}) == 1 for t in set(text.values()))


def test_op2(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op2_ppm", doc_id="bigint", held_out="boolean", n_tokens="bigint", n_known="bigint", train_tokens="bigint",
                                    base_score="double", score="double")}
    c = collections.Counter(x for i, t in docs if fold(i, 7) != 2 for x in [*words(t), None])
    for i, t in docs:
        r, ws = got[i], [*words(t), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), c.total())
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (c.total() + len(c) + 1)) for w in ws))
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -8


def test_op3(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op3_skip_chain_crf", doc_id="bigint", n_email="bigint", n_ip="bigint", n_card="bigint", n_phone="bigint",
                                    base_sha256="string", spans="string")}
    for i, t in docs:
        base = skip_crf.base_spans(t)  # held against a plain scan in test_mends
        listed = [f"{k}:{a}:{b}" for k, spans in zip(("email", "ip", "card", "phone"), base, strict=True) for a, b in spans]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in base] and r.base_sha256 == sha(",".join(listed))
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans)
        order = [(("email", "ip", "card", "phone").index(s.split(":")[0]), *map(int, s.split(":")[1:])) for s in spans]
        assert order == sorted(order)


def test_op4(spark, docs):
    got = run(spark, "op4_block_naming", doc_id="bigint", keep_id="bigint", group_size="bigint", kept="boolean", text_sha256="string")
    same = collections.defaultdict(list)
    for i, t in docs:
        same[t].append(i)
    assert sorted(map(tuple, got)) == sorted((i, max(same[t]), len(same[t]), i == max(same[t]), sha(t)) for i, t in docs)


def test_op5(spark, docs):
    got = run(spark, "op5_pattern_grammar", doc_id="bigint", held_out="boolean", score="double", predicted="int")
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in docs)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def bpe_row(doc_id, text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return doc_id, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(LIBRARY.decode(ids, skip_special_tokens=False))


def test_op6(spark, docs):
    got = run(spark, "op6_trie_bpe", doc_id="bigint", n_tokens="bigint", ids_sha256="string", decoded_sha256="string")
    assert sorted(map(tuple, got)) == sorted(bpe_row(i, t) for i, t in docs)


def shingles(text, n):
    ws = words(text)
    return {tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)} if len(ws) >= n else {tuple(ws)} if ws else set()


def components(rows, n, percent):
    """Smallest id that links reach, for each id."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for (i, s), (j, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            a, b = sorted((find(i), find(j)))
            up[b] = a
    return {i: find(i) for i, _ in sets}


def test_op7(spark, docs):
    got = run(spark, "op7_sparse_product", doc_id="bigint", n_shingles="bigint", component_id="bigint")
    group = components(docs, 4, 85)
    assert sorted(map(tuple, got)) == sorted((i, len(shingles(t, 4)), group[i]) for i, t in docs)


def test_op8(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op8_suffix_family", doc_id="bigint", n_bytes="bigint", n_removed="bigint", n_spans="bigint", kept_sha256="string")}
    raws = [(i, t.encode()) for i, t in docs]
    seen = collections.Counter(b[k:k + 200] for _, b in raws for k in range(len(b) - 199))
    for i, b in raws:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\x01" * 200
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        assert tuple(got[i]) == (i, len(b), sum(gone), spans, sha(kept))


def bench_words(text):
    return [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER).encode())]


def item_windows(items):
    found = collections.defaultdict(set)
    for k, t in items:
        ws = bench_words(t or "")
        n = min(len(ws), 10)
        for a in range(len(ws) - n + 1 if ws else 0):
            found[tuple(ws[a:a + n])].add(k)
    return found


def hits(text, found):
    ws, hit, names = bench_words(text), set(), set()
    for n in {len(w) for w in found}:
        for a in range(len(ws) - n + 1):
            if (w := tuple(ws[a:a + n])) in found:
                hit.update(range(a, a + n))
                names |= found[w]
    return ws, hit, names


def test_op9(spark, docs, items):
    got = {r.doc_id: r for r in run(spark, "op9_suffix_automaton", doc_id="bigint", n_words="bigint", n_hit="bigint", n_items="bigint", items_sha256="string", contaminated="boolean")}
    found = item_windows(items)
    for i, t in docs:
        ws, hit, names = hits(t, found)
        assert tuple(got[i]) == (i, len(ws), len(hit), len(names), sha(",".join(sorted(names))), bool(hit))
    assert any(r.contaminated for r in got.values())


def test_op10(spark):
    got = run(spark, "op10_site_style_tree", page_id="bigint", url="string", text="string", n_chars="bigint")
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r.page_id for r in got) == sorted(pages)
    assert all(r.url == pages[r.page_id].url and r.n_chars == len(r.text) and " ".join(r.text.split()) == r.text for r in got)
    assert all("<" not in r.text or "&lt;" in pages[r.page_id].html for r in got) and sum(r.n_chars > 0 for r in got) > len(got) / 2


def test_pipeline(spark):
    """Every stage but the learned one by plain Python, on what the grammar lets through."""
    frame = spark.read.parquet(f"{LARGER}/documents.parquet")
    docs = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()]
    grammar = toxicity.learn(frame, spark.read.parquet(f"{LARGER}/labels.parquet"), usable=queries.learnable())
    mild = {r.doc_id for r in frame.filter(toxicity.score(grammar, F.col("text")) < toxicity.THRESHOLD).select("doc_id").collect()}
    rows = [(i, t) for i, t in docs if i in mild]
    assert 0 < len(rows) < len(docs)
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = sorted((i, t) for t, i in last.items())
    group = components(rows, 5, 80)
    rows = [(i, t) for i, t in rows if group[i] == i]
    found, kept = item_windows(items), []
    for i, t in rows:
        ws, hit, _ = hits(t, found)
        if len(hit) <= 0.8 * len(ws):
            kept.append((i, cut(t, sorted(hit))))
    got = corpus_pipeline.run(spark, LARGER).collect()
    assert sorted(map(tuple, got)) == sorted(bpe_row(i, t) for i, t in kept)


def cut(text, hit):
    """The text without the hit words and what lies between neighbouring ones."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", raw)]
    out, end = b"", 0
    for _, run_ in itertools.groupby(enumerate(hit), key=lambda x: x[1] - x[0]):
        places = [k for _, k in run_]
        out += raw[end:at[places[0]][0]]
        end = at[places[-1]][1]
    return (out + raw[end:]).decode()
