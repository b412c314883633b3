"""Times kept as text or date: one instant per row, whatever the session zone."""

import datetime as dt
import zoneinfo

import pytest
from pyspark.sql import functions as F

from docexport.functions.timefn import as_utc_ntz, epoch_micros, local_date
from docexport.operators.aggregate import aggregate
from docexport.operators.order import first_last, sort_by_time, time_bounds
from docexport.operators.predicate import time_range
from docexport.operators.slices import assign_slices
from docexport.plans.job import export_frame
from docexport.spec import AggSpec, ExportSpec, SliceSpec

TEXTS = ["2024-01-01T00:30:00+02:00", "2024-01-01T00:30:00-02:00", "2024-01-01T00:30:00", "2024-01-01 00:30:00.000001Z",
         "2024-03-31T02:30:00", "2024-03-31T02:30:00 Europe/Rome", "2023-12-31T23:59:59.999999", "2024-01-01", "2024-06-01T23:00:00-18:00",
         "2024-06-02T10:59:59+18:00", "not a time", "", None, "2024-13-45T00:00:00", "12:30"]


def instant(text):
    """The instant of a time text by the standard library, as UTC wall clock."""
    if text is None:
        return None
    head, _, zone = text.partition(" Europe")
    try:
        t = dt.datetime.fromisoformat(head.replace("Z", "+00:00"))
    except ValueError:
        return None
    if zone:
        t = t.replace(tzinfo=zoneinfo.ZoneInfo("Europe" + zone))
    return t if t.tzinfo is None else t.astimezone(dt.timezone.utc).replace(tzinfo=None)


@pytest.fixture(params=["UTC", "Asia/Tokyo", "Europe/Rome"])
def zoned(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "_id long, t string")


def test_instants_of_texts(zoned):
    df = texts(zoned)
    got = df.select("_id", as_utc_ntz(F.col("t"), df.schema["t"].dataType).cast("string").alias("u"),
                    epoch_micros(F.col("t"), df.schema["t"].dataType).alias("us")).orderBy("_id").collect()
    for r, text in zip(got, TEXTS):
        want = instant(text)
        assert (r["u"] is None) == (want is None), text
        if want is not None:
            assert dt.datetime.fromisoformat(r["u"]) == want, text
            assert r["us"] == (want - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


@pytest.mark.parametrize("start,end,zone", [("2024-01-01T00:00:00", None, "UTC"), (None, "2024-01-01T00:30:00", "UTC"),
                                            ("2024-01-01T00:00:00", "2024-01-01T02:30:00", "UTC"), ("2024-01-01T00:00:00", "2024-06-01T19:00:00", "Asia/Tokyo"),
                                            ("2024-06-02T00:00:00+14:00", "2024-06-02T17:00:00Z", "UTC"), (None, None, "UTC"),
                                            ("0001-01-01T00:00:00", "9999-12-31T23:59:59", "UTC")])
def test_range_on_texts(zoned, start, end, zone):
    def bound(b):
        if b is None:
            return None
        t = dt.datetime.fromisoformat(b.replace("Z", "+00:00"))
        t = t if t.tzinfo else t.replace(tzinfo=zoneinfo.ZoneInfo(zone))
        return t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    lo, hi = bound(start), bound(end)
    want = [i for i, t in enumerate(TEXTS) if (u := instant(t)) is not None and (lo is None or u >= lo) and (hi is None or u <= hi)]
    got = time_range(texts(zoned), "t", start, end, zone).orderBy("_id").collect()
    assert [r["_id"] for r in got] == want


def test_text_bounds_reach_the_scan(zoned, tmp_path):
    path = str(tmp_path / "texts")
    texts(zoned).write.parquet(path)
    df = time_range(zoned.read.parquet(path), "t", "2024-01-01T00:00:00", "2024-01-31T00:00:00")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(t,2023-12-31)" in pushed and "LessThan(t,2024-02-01)" in pushed


def test_order_and_bounds_of_texts(zoned):
    df = texts(zoned)
    known = sorted((u, i) for i, t in enumerate(TEXTS) if (u := instant(t)) is not None)
    got = [r["_id"] for r in sort_by_time(df, "t").collect()]
    assert got[:len(known)] == [i for _, i in known] and set(got[len(known):]) == {i for i, t in enumerate(TEXTS) if instant(t) is None}
    spec = ExportSpec(fields="t", metadata="_id", time_field="t")
    exported = export_frame(df, spec)
    assert exported.columns == ["_id", "t"]
    assert [r["_id"] for r in exported.collect()] == [i for _, i in known]
    one = first_last(df, "t").select("first_id", "last_id").first()
    assert tuple(one) == (known[0][1], known[-1][1])
    b = time_bounds(df, "t").select(F.col("first_time").cast("string"), F.col("last_time").cast("string"), "n_docs").first()
    assert dt.datetime.fromisoformat(b[0]) == known[0][0] and dt.datetime.fromisoformat(b[1]) == known[-1][0] and b[2] == len(known)


def test_slices_of_texts(zoned):
    known = {i: u for i, t in enumerate(TEXTS) if (u := instant(t)) is not None}
    lo, hi = min(known.values()), max(known.values())
    got = {r["_id"]: r["slice_id"] for r in assign_slices(texts(zoned), "t", SliceSpec(n=5)).collect()}
    for i in range(len(TEXTS)):
        want = min(4, (known[i] - lo) * 5 // (hi - lo)) if i in known else None
        assert got[i] == want, TEXTS[i]


def test_dates(zoned):
    days = [dt.date(2024, 1, d) for d in (4, 5, 5, 6)] + [None]
    df = zoned.createDataFrame(list(enumerate(days)), "_id long, d date")
    dtype = df.schema["d"].dataType
    assert [r[0] for r in df.orderBy("_id").select(local_date(F.col("d"), dtype, "UTC")).collect()] == days
    assert [r[0] for r in df.orderBy("_id").select(local_date(F.col("d"), dtype, "Asia/Tokyo")).collect()] == days
    for start, end, want in (("2024-01-05T00:00:00", None, [1, 2, 3]), ("2024-01-05T00:00:01", None, [3]),
                             (None, "2024-01-05T23:00:00", [0, 1, 2]), ("2024-01-05T00:00:00", "2024-01-05T00:00:00", [1, 2])):
        assert [r["_id"] for r in time_range(df, "d", start, end).orderBy("_id").collect()] == want
    agg = aggregate(df, AggSpec(time_field="d", functions={"_id": "count"})).collect()
    assert [tuple(r) for r in agg] == [(dt.date(2024, 1, 4), 1), (dt.date(2024, 1, 5), 2), (dt.date(2024, 1, 6), 1)]


def test_a_number_is_no_time(spark):
    with pytest.raises(ValueError, match="holds no times"):
        assign_slices(spark.createDataFrame([(1,)], "t long"), "t", SliceSpec(n=2))
