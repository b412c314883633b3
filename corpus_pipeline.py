"""A corpus-cleaning pipeline: each stage works on what the stage before it kept.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docexport.llm.bpe import encode_documents
from docexport.llm.common import materialize
from docexport.llm.decontaminate import remove_benchmark_passages
from docexport.llm.naming import drop_exact_duplicates
from docexport.llm.ngram_join import drop_similar
from docexport.llm.queries import learnable
from docexport.llm.toxicity import drop_toxic
from docexport.session import ensure_checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), usable=learnable())


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_duplicates(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents (5-word n-grams, 0.8 or more) the one with the smallest id stays."""
    return drop_similar(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are little else go."""
    return remove_benchmark_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", ngram_jaccard),
          ("benchmark decontamination", decontamination), ("BPE encoding and decoding", bpe_digests)]

#: Learned scores and similarity components have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over ``documents``."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
