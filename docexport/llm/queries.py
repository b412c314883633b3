"""The registered queries of the subpackage: each operator over its whole table.

The operators keep their own results (texts, spans, ids, links); the queries
derive the contract's digest columns from them. ``ORACLE`` has DuckDB SQL where
SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import bpe, decontaminate, naming, ngram_join, phrases, ppm, sharding, simhash, site_style, skip_crf, suffix_dedup, toxicity, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def id_mod(n: int, id_col: str = "doc_id") -> Column:
    """Remainder of the crc32 of an id's text."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % n


def learnable() -> Column:
    """Rows whose toxicity labels may be learned from."""
    return id_mod(3) != 1


@register("op1_minimax_shards")
def op1_minimax_shards(spark, d):
    """All documents in 16 shards whose largest is as small as contiguous cuts allow."""
    return (sharding.shard_documents(table(spark, d, "documents"))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


@register("op4_block_naming", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
""")
def op4_block_naming(spark, d):
    """Exact duplicates of every document by block naming."""
    return naming.exact_duplicates(table(spark, d, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op5_pattern_grammar")
def op5_pattern_grammar(spark, d):
    """Toxicity score of every document by the clause grammar."""
    docs = table(spark, d, "documents")
    grammar = toxicity.learn(docs, table(spark, d, "labels"), usable=learnable())
    scored = docs.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), toxicity.score(grammar, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@register("op6_trie_bpe")
def op6_trie_bpe(spark, d):
    """Digests of the ids and of the decoded text of every document."""
    return bpe.encode_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op7_sparse_product")
def op7_sparse_product(spark, d):
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return (ngram_join.similar_components(table(spark, d, "documents"))
            .select("doc_id", F.col("n_ngrams").alias("n_shingles"), F.col("component").alias("component_id")))


@register("op9_suffix_automaton", r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM iw WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT s.doc_id, s.i, s.n, win.item_id
  FROM (SELECT dw.doc_id, ns.n, g.i, array_to_string(dw.w[g.i:g.i + ns.n - 1], ' ') AS k
        FROM dw, ns, unnest(generate_series(1, len(dw.w) - ns.n + 1)) AS g(i)) s
  JOIN win ON win.n = s.n AND win.k = s.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""".replace("WITH RECURSIVE", "WITH"))
def op9_suffix_automaton(spark, d):
    """Benchmark windows that occur in every document."""
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.encode(F.concat_ws(",", "items"), "UTF-8"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register("op10_site_style_tree")
def op10_site_style_tree(spark, d):
    """Main text of every page."""
    return (site_style.extract_main_text(table(spark, d, "pages"))
            .withColumn("n_chars", F.length("text").cast("long")))


@register("op3_skip_chain_crf")
def op3_skip_chain_crf(spark, d):
    """Personal data of every document."""
    return (skip_crf.find_personal_data(table(spark, d, "documents"))
            .select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"), "spans"))


@register("op8_suffix_family")
def op8_suffix_family(spark, d):
    """Bytes of every document that lie in a 200-byte string which starts elsewhere too."""
    found = suffix_dedup.repeated_strings(table(spark, d, "documents"))
    n_removed = F.expr("aggregate(transform(runs, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), (F.size("runs") / 2).cast("long").alias("n_spans"), "kept_sha256")


@register("op2_ppm")
def op2_ppm(spark, d):
    """Code length of every document by prediction by partial matching, beside the smoothed word counts."""
    return (ppm.score_documents(table(spark, d, "documents"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))


@register("op11_weighted_automata", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, ks.k, array_to_string(w[i:i + ks.k - 1], ' ') AS phrase
        FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) ks, unnest(generate_series(1, len(w) - ks.k + 1)) AS u(i))
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
inside AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:j], ' ') AS phrase, c.f
  FROM c, unnest(generate_series(1, c.k - 1)) AS a(i), unnest(generate_series(2, c.k)) AS b(j)
  WHERE j > i AND j - i + 1 < c.k),
kept AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.f >= c.f)),
cuts AS (
  SELECT kept.lang, kept.phrase, kept.f AS a, cut, l.f AS l, r.f AS r, n,
         CAST((CAST(1000 AS HUGEINT) * kept.f * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM kept JOIN total USING (lang), unnest(generate_series(1, kept.k - 1)) AS u(cut)
  JOIN g l ON l.lang = kept.lang AND l.phrase = array_to_string(kept.w[1:cut], ' ')
  JOIN g r ON r.lang = kept.lang AND r.phrase = array_to_string(kept.w[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""")
def op11_weighted_automata(spark, d):
    """The first 2000 phrase collocations of every language."""
    return phrases.mine_phrases(table(spark, d, "documents"))


@register("op12_trie_self_join")
def op12_trie_self_join(spark, d):
    """Components of documents whose SimHash fingerprints differ in at most 3 bits."""
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"), "n_links")


@register("op13_hilbert_blocks")
def op13_hilbert_blocks(spark, d):
    """Codes of all embeddings, eight parts with codebooks of 16 entries, and their exact errors."""
    coded, books = vector_codes.compress_vectors(table(spark, d, "embeddings"))
    return coded.select("vec_id", F.lower(F.lpad(F.hex("codes"), 16, "0")).alias("code"), "error", "label_error",
                        F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))
