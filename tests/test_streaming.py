"""Incremental export over a folder of document files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF
from docexport.plans.job import export_frame
from docexport.sources.readers import read_csv
from docexport.spec import ExportSpec
from docexport.streaming import export_stream


def test_stream_matches_batch_export(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    src = str(tmp_path / "src")
    # two batches of files, the second repeating part of the first (re-delivery)
    events.filter("event_id < 600").write.parquet(src + "/b1")
    events.filter("event_id >= 500").write.parquet(src + "/b2")
    spec = ExportSpec(fields="ts,event_type,value", metadata="_id", time_field="ts",
                      start="2024-01-03T00:00:00")
    q = export_stream(spark, src + "/*", events.schema, spec, str(tmp_path / "out"),
                      str(tmp_path / "ckpt"), id_field="event_id", watermark="30 days")
    q.awaitTermination(120)
    got = read_csv(spark, str(tmp_path / "out"), "_id long, ts timestamp_ntz, event_type string, value double")
    batch = export_frame(events.withColumn("_id", F.col("event_id")), spec)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_late_files_lose_no_row(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, value double"
    files = [[(1, 20), (2, 21)], [(3, 1), (4, 2)], [(5, 25), (1, 20), (3, 1)], [(6, 3), (4, 2)]]  # id, day; later files are late or repeat
    for k, docs in enumerate(files):
        part = [(i, dt.datetime(2024, 1, d), 1.0) for i, d in docs]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "src" / f"f{k}"))
        for f in (tmp_path / "src" / f"f{k}").glob("*.parquet"):
            os.utime(f, (1_700_000_000 + 60 * k,) * 2)
    spec = ExportSpec(fields="ts,value", metadata="_id", time_field="ts")
    q = export_stream(spark, str(tmp_path / "src") + "/*", spark.createDataFrame([], schema).schema, spec, str(tmp_path / "out"),
                      str(tmp_path / "ckpt"), id_field="event_id", max_files_per_trigger=1)
    q.awaitTermination(120)
    got = [r[0] for r in read_csv(spark, str(tmp_path / "out"), "_id long, ts timestamp_ntz, value double").collect()]
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
