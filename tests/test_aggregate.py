"""Aggregation semantics, cross-checked against pandas group-by (the reference's engine)."""

import datetime as dt
import math
import random
from decimal import Decimal
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docexport.operators.aggregate import aggregate, count_rows
from docexport.spec import AggSpec

ROWS = [
    # key1, key2, v (double), n (long), flag, t (UTC text)
    ("a", 1, 0.125, 1, True, "2024-03-29T22:30:00Z"),
    ("a", 1, 2.675, 2, False, "2024-03-30T23:30:00Z"),   # 31 March, 00:30 in Rome
    ("a", 2, 0.575, None, None, "2024-03-31T00:30:00Z"),  # 31 March, 01:30 in Rome (before change)
    ("b", 1, None, 4, True, "2024-03-31T01:30:00Z"),     # 31 March, 03:30 in Rome (after change)
    ("b", 1, None, 5, True, "2024-03-31T22:30:00Z"),     # 1 April, 00:30 in Rome
    (None, 1, 1.005, 6, False, "2024-04-09T10:00:00Z"),  # null key, after a gap
    ("c", None, 3.0, 7, True, "2024-04-12T10:00:00Z"),
    ("c", 2, 2.5, 8, None, None),                        # no time
]
SCHEMA = "key1 string, key2 bigint, v double, n bigint, flag boolean, t string"


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumn("t", F.to_timestamp("t")).withColumn("t", F.col("t").cast("timestamp_ntz"))


def pandas_reference(keys, types, names=None, bools=(), time_field=None, days=1,
                     zone="UTC", rounding=2, prefix="agg"):
    """The reference's aggregation written with pandas, as its code does."""
    df = pd.DataFrame(ROWS, columns=["key1", "key2", "v", "n", "flag", "t"])
    df["key2"] = df["key2"].astype("Int64")
    df["n"] = df["n"].astype("Int64")
    df = df.round(rounding)
    for b in bools:
        df[b] = np.where(df[b] == True, 1, 0)  # noqa: E712
    fields = [c for c in df.columns if c in keys]
    names = {c: (names or {}).get(c, f"{prefix}__{c}__{f}") for c, f in types.items()}
    if time_field:
        df[time_field] = pd.to_datetime(df[time_field], utc=True).dt.tz_convert(zone)
        df = df.set_index(time_field)
        fields.insert(0, pd.Grouper(level=time_field, freq=f"{days}D"))
    out = df.groupby(fields).agg(types).rename(columns=names).reset_index()
    if time_field:
        out[time_field] = out[time_field].dt.date
    return out.round(rounding)


def canon(rows):
    def v(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or x is pd.NA:
            return None
        if isinstance(x, (np.integer,)):
            return int(x)
        if isinstance(x, (np.floating, float)):
            return float(x)
        if isinstance(x, pd.Timestamp):
            return x.date()
        return x
    return sorted([tuple(v(x) for x in r) for r in rows], key=repr)


def spark_rows(df):
    return canon([tuple(r) for r in df.collect()])


def pandas_rows(pdf):
    return canon(pdf.itertuples(index=False, name=None))


def test_five_functions_match_pandas(frame):
    types = {"v": "sum", "n": "count", "key2": "max"}
    spec = AggSpec(keys=["key1"], functions=types)
    got = aggregate(frame, spec)
    assert got.columns == ["key1", "agg__v__sum", "agg__n__count", "agg__key2__max"]
    assert spark_rows(got) == pandas_rows(pandas_reference(["key1"], types))


def test_mean_min_and_all_null_group(frame):
    types = {"v": "mean", "n": "min"}
    got = aggregate(frame, AggSpec(keys=["key1"], functions=types))
    rows = {r["key1"]: r for r in got.collect()}
    assert rows["b"]["agg__v__mean"] is None  # every v of b is null
    assert spark_rows(got) == pandas_rows(pandas_reference(["key1"], types))
    s = aggregate(frame, AggSpec(keys=["key1"], functions={"v": "sum"})).collect()
    assert {r["key1"]: r["agg__v__sum"] for r in s}["b"] == 0.0  # sum of nothing is 0


def test_halves_rounded_before_and_after(frame):
    got = {r["key1"]: r["agg__v__sum"]
           for r in aggregate(frame, AggSpec(keys=["key1"], functions={"v": "sum"})).collect()}
    # 0.125 -> 0.12, 2.675 -> 2.67 or 2.68 as numpy rounds it, 0.575 -> 0.57/0.58
    expect = pandas_reference(["key1"], {"v": "sum"})
    assert got["a"] == float(expect.set_index("key1").loc["a", "agg__v__sum"])


def test_key_order_follows_data_and_null_keys_dropped(frame):
    got = aggregate(frame, AggSpec(keys=["key2", "key1"], functions={"n": "sum"}))
    assert got.columns[:2] == ["key1", "key2"]
    assert all(r["key1"] is not None and r["key2"] is not None for r in got.collect())
    assert spark_rows(got) == pandas_rows(pandas_reference(["key2", "key1"], {"n": "sum"}))


def test_default_count_of_last_key_and_names(frame):
    got = aggregate(frame, AggSpec(keys=["key1", "key2"]))
    assert got.columns[-1] == "agg__key2__count"
    named = aggregate(frame, AggSpec(keys=["key1"], functions={"v": "max", "n": "sum"},
                                     names={"v": "top"}))
    assert named.columns == ["key1", "top", "agg__n__sum"]


def test_unknown_columns_pruned_and_errors(frame):
    got = aggregate(frame, AggSpec(keys=["key1", "ghost"], functions={"v": "min", "zz": "sum"},
                                   names={"zz": "q"}, bool_columns=["nope"]))
    assert got.columns == ["key1", "agg__v__min"]
    with pytest.raises(ValueError):
        aggregate(frame, AggSpec(keys=["ghost"], functions={"v": "sum"}))
    with pytest.raises(ValueError):
        aggregate(frame, AggSpec(keys=["key1"], functions={"zz": "sum"}))
    with pytest.raises(ValueError):
        aggregate(frame, AggSpec(keys=["key2"], functions={"key1": "sum"}))  # text sum refused


def test_boolean_occurrences(frame):
    types = {"flag": "sum"}
    got = aggregate(frame, AggSpec(keys=["key1"], functions=types, bool_columns=["flag"]))
    assert spark_rows(got) == pandas_rows(pandas_reference(["key1"], types, bools=["flag"]))


@pytest.mark.parametrize("days,zone", [(1, "UTC"), (1, "Europe/Rome"), (2, "Europe/Rome"),
                                       (7, "Europe/Rome"), (3, "America/New_York")])
def test_calendar_buckets_alone_are_dense(frame, days, zone):
    types = {"n": "count", "v": "sum", "key2": "max"}
    got = aggregate(frame, AggSpec(functions=types, time_field="t", days=days, zone=zone))
    exp = pandas_reference([], types, time_field="t", days=days, zone=zone)
    assert spark_rows(got) == pandas_rows(exp)


@pytest.mark.parametrize("days", [1, 2])
def test_calendar_buckets_with_keys_are_sparse(frame, days):
    types = {"n": "sum"}
    got = aggregate(frame, AggSpec(keys=["key1"], functions=types, time_field="t", days=days,
                                   zone="Europe/Rome"))
    exp = pandas_reference(["key1"], types, time_field="t", days=days, zone="Europe/Rome")
    assert spark_rows(got) == pandas_rows(exp)


def test_count_rows(frame):
    assert count_rows(frame.filter("key1 = 'a'")).first()[0] == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_beyond_64_bits(spark, ansi):
    """Values and totals whose multiples of 0.01 pass 64 bits, beside small ones, of both signs."""
    groups = {"total": [4e16] * 300, "value": [2e17, -0.25, 0.5], "mixed": [2e17, 1e14 + 0.37, -9.1e13 - 0.5, 0.01, -0.02, 123456789012.34] * 7,
              "negative": [-4e16] * 300 + [1.11], "wide": [3e20, 5e21, -1e19, 12.34], "cancel": [5e21, -5e21, 0.07], "many wide": [9e21] * 400 + [0.03], "huge": [1e300, 2e25, 1.0],
              "endless": [float("inf"), 1.0], "missing": [None, float("nan")]}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = {r["k"]: r for r in aggregate(df, AggSpec(keys="k", functions="v--sum")).collect()}
        mean = {r["k"]: r for r in aggregate(df, AggSpec(keys="k", functions="v--mean")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    for k, vs in groups.items():
        vs = [v for v in vs if v is not None and v == v]
        want = math.inf if math.inf in vs else float(sum((Decimal(repr(v)) for v in vs), Decimal(0)))
        assert got[k]["agg__v__sum"] == pytest.approx(want, rel=1e-15, abs=1e-9), k
        assert mean[k]["agg__v__mean"] == (pytest.approx(want / len(vs), rel=1e-14, abs=0.005) if vs else None), k
    assert got["cancel"]["agg__v__sum"] == 0.07 and got["value"]["agg__v__sum"] == 2e17 + 0.25


@pytest.mark.parametrize("rounding", [0, 4, 9])
def test_sums_at_other_roundings(spark, rounding):
    rng = random.Random(rounding)
    vs = [round(rng.uniform(-1, 1) * 10 ** rng.randint(0, 16), rounding) for _ in range(500)]
    df = spark.createDataFrame([("k", v) for v in vs], "k string, v double").repartition(3)
    got = aggregate(df, AggSpec(keys="k", functions="v--sum", rounding=rounding), pre_round=False).first()[1]
    assert got == pytest.approx(float(sum(Decimal(repr(v)) for v in vs)), rel=1e-14)


def test_exact_sums_stay_hash_aggregates_without_python(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id / 3.0D AS v")
    plan = aggregate(df, AggSpec(keys="k", functions="v--sum"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Python" not in plan


def test_dense_calendar_of_many_chunks(spark):
    days = spark.sql("SELECT explode(array(timestamp_ntz'1900-01-01 05:00:00', timestamp_ntz'1999-12-31 00:00:00')) AS t, 1 AS n")
    got = aggregate(days, AggSpec(functions="n--sum", time_field="t", days=1, zone="UTC"), sort=False)
    assert got.selectExpr("count(*)", "count(distinct t)", "min(t)", "max(t)", "sum(agg__n__sum)").first()[:] == (
        36524, 36524, dt.date(1900, 1, 1), dt.date(1999, 12, 31), 2)
