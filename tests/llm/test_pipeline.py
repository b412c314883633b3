"""The pipeline on a planted table, stage by stage."""

import corpus_pipeline
from docexport.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    left = {r.doc_id: r.text for r in docs.collect()}
    assert len(set(left.values())) == len(left) and set(left) <= set(before)
    assert all(t == before[i] or len(t) < len(before[i]) for i, t in left.items())
    digests = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in digests.collect()} == set(left)
