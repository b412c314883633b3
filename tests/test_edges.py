"""Edge cases: empty inputs, idempotent dedup, rounding against numpy."""

import numpy as np
import pandas as pd

from conftest import SF
from docexport.functions.fmt import round_floats
from docexport.operators.aggregate import aggregate
from docexport.operators.dedup import dedup_by_fields, dedup_by_id
from docexport.operators.slices import assign_slices, slice_table
from docexport.plans.job import export_frame
from docexport.spec import AggSpec, ExportSpec, SliceSpec


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, v double, t timestamp_ntz, _id long")
    assert aggregate(empty, AggSpec(keys="k", functions="v--sum")).count() == 0
    assert aggregate(empty, AggSpec(functions="v--sum", time_field="t", days=3)).count() == 0
    assert slice_table(empty, "t", SliceSpec(n=3)).count() == 0
    assert slice_table(empty, "t", SliceSpec(n=3, step="1d")).count() == 0
    assert assign_slices(empty, "t", SliceSpec(n=2)).count() == 0
    assert export_frame(empty, ExportSpec(fields="k,v", time_field="t")).count() == 0


def test_dedup_twice_is_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    once = dedup_by_fields(docs, ["text"], ["doc_id"])
    twice = dedup_by_fields(once, ["text"], ["doc_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("event_id", "_id")
    a = dedup_by_id(ev.unionByName(ev), ["ts", "value"])
    b = dedup_by_id(a, ["ts", "value"])
    assert a.count() == b.count() == ev.count()


def test_rounding_matches_numpy(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = li.selectExpr("l_extendedprice * l_discount AS a", "l_extendedprice * l_tax / 7 AS b")
    got = round_floats(df, 2).toPandas()
    raw = df.toPandas()
    assert (got["a"].values == np.round(raw["a"].values, 2)).all()
    assert (got["b"].values == pd.Series(raw["b"]).round(2).values).all()
    halves = spark.createDataFrame([(0.125,), (2.675,), (0.575,), (-0.125,), (1.005,)], "x double")
    assert [r.x for r in round_floats(halves, 2).collect()] == list(np.round([0.125, 2.675, 0.575, -0.125, 1.005], 2))


def test_instant_time_columns(spark):
    """A ``timestamp`` (instant) time field behaves like UTC wall clock, whatever the session zone."""
    from docexport.operators.predicate import time_range
    ntz = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        # the instant whose UTC wall clock is ts
        ltz = ntz.selectExpr("event_id", "timestamp_micros(timestampdiff(MICROSECOND, "
                             "TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)) AS ts")
        a = time_range(ntz, "ts", "2024-01-05T00:00:00", "2024-01-06T00:00:00", "Europe/Rome")
        b = time_range(ltz, "ts", "2024-01-05T00:00:00", "2024-01-06T00:00:00", "Europe/Rome")
        assert sorted(r[0] for r in a.select("event_id").collect()) == \
            sorted(r[0] for r in b.select("event_id").collect())
        spec = AggSpec(functions="event_id--count", time_field="ts", days=2, zone="Europe/Rome")
        assert sorted(map(tuple, aggregate(ntz, spec).collect())) == \
            sorted(map(tuple, aggregate(ltz, spec).collect()))
        s = SliceSpec(n=3, step="2d")
        assert [r.n_docs for r in slice_table(ntz, "ts", s).orderBy("slice_id").collect()] == \
            [r.n_docs for r in slice_table(ltz, "ts", s).orderBy("slice_id").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
