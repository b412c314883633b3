"""Cases in which rows, columns or an old file could get lost silently."""

import pytest
from pyspark.sql import functions as F

from docexport.operators.aggregate import aggregate
from docexport.operators.project import cells_as_text
from docexport.plans.job import export_frame
from docexport.sinks.csv import write_single_csv
from docexport.sources.readers import scan
from docexport.spec import AggSpec, ExportSpec


def test_wildcard_takes_the_fields_of_every_index(spark, tmp_path):
    spark.range(3).selectExpr("id as x").write.parquet(f"{tmp_path}/logs-1.parquet")
    spark.range(2).selectExpr("id as x", "id as y").write.parquet(f"{tmp_path}/logs-2.parquet")
    rows = scan(spark, f"{tmp_path}/logs-*.parquet").collect()
    assert sorted((r._index, r.x, r.y) for r in rows if r.y is not None) == [("logs-2", 0, 0), ("logs-2", 1, 1)]
    assert len(rows) == 5


def test_export_without_ids_keeps_equal_rows(spark):
    docs = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    assert sorted(r.v for r in export_frame(docs, ExportSpec(fields="v")).collect()) == ["a", "a", "b"]


def test_single_file_is_whole_whatever_the_session_sets(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        path = write_single_csv(spark.range(100), f"{tmp_path}/all.csv")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(open(path).read().splitlines()) == 101


def test_failing_overwrite_keeps_the_old_file(spark, tmp_path):
    path = write_single_csv(spark.range(3), f"{tmp_path}/old.csv")
    bad = spark.range(3).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        write_single_csv(bad, path, overwrite=True)
    assert len(open(path).read().splitlines()) == 4
    write_single_csv(spark.range(5), path, overwrite=True)
    assert len(open(path).read().splitlines()) == 6


def test_nan_is_missing_in_aggregates(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", float("nan"))], "k string, v double")
    row = aggregate(df, AggSpec(keys=["k"], functions={"v": "max"})).collect()[0]
    assert row[1] == 1.0


def test_objects_keep_microseconds(spark):
    df = spark.sql("select named_struct('t', timestamp_ntz'2024-01-01 00:00:00.123456') as o")
    assert "00.123456" in cells_as_text(df).collect()[0].o
