"""The spark-submit command line, end to end on the small tables."""

from conftest import SF
from docexport.plans.cli import main
from docexport.sources.readers import read_csv


def test_export_aggregate_and_slices(spark, tmp_path):
    out, agg = str(tmp_path / "export.csv"), str(tmp_path / "agg.csv")
    assert main(["export", "--source", f"{SF}/events.parquet", "--id-field", "event_id",
                 "--fields", "ts,event_type,value", "--metadata", "_id", "--time-field", "ts",
                 "--start", "2024-01-02T00:00:00", "--zone", "Europe/Rome",
                 "--query", "value > 10", "--rename", "value--amount", "--single-file",
                 "--out", out, "--agg-keys", "event_type", "--agg-types", "value--sum,_id--count",
                 "--agg-time-field", "ts", "--agg-days", "7", "--agg-out", agg]) == 0
    rows = read_csv(spark, out, "_id long, ts timestamp_ntz, event_type string, amount double")
    assert rows.count() > 0 and rows.filter("amount <= 10").count() == 0
    a = read_csv(spark, agg, "ts date, event_type string, s double, c long")
    assert a.groupBy().sum("c").first()[0] == rows.count()
    agg2 = str(tmp_path / "agg2.csv")
    assert main(["aggregate", "--raw-input", out, "--raw-schema",
                 "_id long, ts timestamp_ntz, event_type string, amount double",
                 "--agg-keys", "event_type", "--agg-types", "amount--mean", "--agg-out", agg2]) == 0
    assert read_csv(spark, agg2, "event_type string, m double").count() == 5
    sl = str(tmp_path / "slices.csv")
    assert main(["slices", "--source", f"{SF}/events.parquet", "--time-field", "ts",
                 "--slices", "4", "--step", "2d", "--out", sl]) == 0
    t = read_csv(spark, sl, "slice_id int, slice_start timestamp_ntz, slice_end timestamp_ntz, n long")
    assert t.groupBy().sum("n").first()[0] == 1000


def test_slices_of_a_query_and_a_range_in_a_zone(spark, tmp_path):
    sl = str(tmp_path / "slices.csv")
    assert main(["slices", "--source", f"{SF}/events.parquet", "--time-field", "ts", "--query", "event_type = 'view'",
                 "--start", "2024-01-02T01:00:00", "--end", "2024-01-20T00:00:00", "--zone", "Europe/Rome",
                 "--slices", "3", "--out", sl]) == 0
    t = read_csv(spark, sl, "slice_id int, slice_start timestamp_ntz, slice_end timestamp_ntz, n long")
    want = spark.read.parquet(f"{SF}/events.parquet").filter(
        "event_type = 'view' and ts >= timestamp_ntz'2024-01-02 00:00:00' and ts <= timestamp_ntz'2024-01-19 23:00:00'").count()
    assert want > 0 and t.groupBy().sum("n").first()[0] == want
