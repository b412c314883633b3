"""CSV parts: manifests, splitting, headers that differ, places of rows, what a cut-off overwrite leaves, one-pass jobs."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from conftest import SF
from docexport.plans import job
from docexport.plans.cli import main
from docexport.plans.job import aggregate_only, export, export_and_aggregate, export_frame
from docexport.session import ensure_checkpoint_dir
from docexport.sinks.csv import part_files, write_csv, write_single_csv
from docexport.sinks.manifest import read_manifest
from docexport.sources.parts import has_breaks, header_groups, index_files
from docexport.sources.readers import read_csv, read_hits_json, read_ordered, read_parts, scan
from docexport.spec import AggSpec, ExportSpec


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "32k")
    yield
    spark.conf.set(key, before)


def file(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(body)
    return str(folder)


# -- manifests and splitting -----------------------------------------------

def test_manifest_says_what_was_written(spark, tmp_path):
    plain, broken = str(tmp_path / "plain"), str(tmp_path / "broken")
    write_csv(spark.range(100).selectExpr("id", "'a,\"b' AS t"), plain, max_rows_per_file=30)
    write_csv(spark.createDataFrame([(1, "x"), (2, "line\rbreak")], "id int, t string"), broken)
    m = read_manifest(spark, plain)
    assert m["columns"] == ["id", "t"] and m["rows"] == 100 and not m["breaks"]
    assert m["parts"] == sorted(os.path.basename(p) for p in glob.glob(plain + "/*.csv"))
    assert read_manifest(spark, broken)["breaks"] and has_breaks(spark, broken) and not has_breaks(spark, plain)
    write_csv(spark.createDataFrame([], "id long, t string"), str(tmp_path / "empty"))
    assert read_manifest(spark, str(tmp_path / "empty"))["rows"] == 0


def test_a_manifest_speaks_only_for_its_parts(spark, tmp_path):
    path = str(tmp_path / "m")
    write_csv(spark.range(10), path)
    (tmp_path / "m" / "zz.csv").write_text('id\n"1\n"\n')
    assert read_manifest(spark, path) is None and has_breaks(spark, path)
    assert read_manifest(spark, [path]) is None and read_manifest(spark, path + "/*.csv") is None


def test_lines_tell_breaks(spark, tmp_path):
    folder = tmp_path / "f"
    file(folder, "a.csv", 'k,t\n1,"quoted, ""twice"""\n2,x\n')
    file(folder, "b.csv", 'k,t\n1,"two\nlines"\n')
    file(folder, "c.csv", "")
    got = {os.path.basename(r["path"]): (r["header"], r["lines"], r["breaks"]) for r in index_files(spark, str(folder)).collect()}
    assert got == {"a.csv": ("k,t", 3, False), "b.csv": ("k,t", 3, True)}


def big_csv(tmp_path):
    body = "k,v,t\n" + "".join(f'{i % 7},{i}.5,"some ""text"", {i}"\n' for i in range(20_000))
    return file(tmp_path / "big", "raw.csv", body)


SCHEMA = "k int, v double, t string"


def test_a_file_without_breaks_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = big_csv(tmp_path)
    for df in (read_csv(spark, path, SCHEMA), read_parts(spark, path, SCHEMA), read_csv(spark, path)):
        assert df.rdd.getNumPartitions() > 8
        assert df.agg(F.count("*"), F.sum("v"), F.countDistinct("t")).first()[:] == (20_000, 20_000 * 19_999 / 2 + 10_000, 20_000)
    broken = file(tmp_path / "broken", "raw.csv", open(path + "/raw.csv").read() + '1,2.5,"two\nlines"\n')
    df = read_parts(spark, broken, SCHEMA)
    assert df.rdd.getNumPartitions() == 1 and df.count() == 20_001


def test_jobs_and_command_line_read_raw_csv_by_many_tasks(spark, tmp_path, small_splits, monkeypatch):
    path, seen = big_csv(tmp_path), []
    real = job.read_parts

    def read(*args, **kwargs):
        df = real(*args, **kwargs)
        seen.append(df.rdd.getNumPartitions())
        return df
    monkeypatch.setattr(job, "read_parts", read)
    agg = AggSpec(keys="k", functions="v--sum")
    aggregate_only(spark, path, agg, str(tmp_path / "a.csv"), schema=SCHEMA)
    assert main(["aggregate", "--raw-input", path, "--raw-schema", SCHEMA, "--agg-keys", "k", "--agg-types", "v--sum", "--agg-parts",
                 "--agg-out", str(tmp_path / "b")]) == 0
    assert min(seen) > 8 and len(seen) == 2
    rows = [sorted(map(tuple, read_csv(spark, str(tmp_path / x), "k int, s double").collect())) for x in ("a.csv", "b")]
    assert rows[0] == rows[1] and len(rows[0]) == 7
    assert os.path.isdir(tmp_path / "b") and os.path.isfile(tmp_path / "a.csv")


# -- headers that differ ---------------------------------------------------

def test_parts_with_other_headers_in_one_folder(spark, tmp_path):
    folder = tmp_path / "mixed"
    file(folder, "a.csv", "k,v\n1,1.5\n2,2.5\n")
    file(folder, "b.csv", 'v,k,t\n9.5,3,"x\ny"\n')
    file(folder, "c.csv", "k,v\n4,\n")
    path = file(folder, "d.csv", "other\n7\n")
    got = read_parts(spark, path, "k int, v double, t string")
    assert got.columns == ["k", "v", "t"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 1.5, None), (2, 2.5, None), (3, 9.5, "x\ny"), (4, None, None), (None, None, None)]))
    assert len(header_groups(spark, path)) == 3
    with pytest.raises(ValueError, match="absent"):
        read_parts(spark, path, "k int, absent int").collect()


def test_inferred_types_of_mixed_headers_meet(spark, tmp_path):
    folder = tmp_path / "mixed"
    file(folder, "a.csv", "k,v\n1,1\n")
    path = file(folder, "b.csv", "v,k\n2.5,text\n")
    got = read_parts(spark, path)
    assert (got.schema["k"].dataType, got.schema["v"].dataType) == (StringType(), DoubleType())
    assert sorted(map(tuple, got.select("k", "v").collect())) == [("1", 1.0), ("text", 2.5)]


def test_decimal_mark_without_a_schema(spark, tmp_path):
    path = file(tmp_path / "d", "x.csv", "n;x;t;e\n1;1,5;a,5;\n2;-0,25;b;\n3;,5;1,5;\n4;;;\n")
    got = read_csv(spark, path, sep=";", decimal=",")
    kinds = [f.dataType for f in got.schema.fields]
    assert kinds[:3] == [IntegerType(), DoubleType(), StringType()]
    assert [r["x"] for r in got.orderBy("n").collect()] == [1.5, -0.25, 0.5, None]


# -- order -----------------------------------------------------------------

def shuffled(spark):
    return spark.range(3000).selectExpr("(id * 1237) % 3000 AS _id", "timestampadd(SECOND, cast((id * 911) % 1000 as int), timestamp_ntz'2024-01-01 00:00:00') AS t")


def test_places_of_rows_come_from_the_files(spark, tmp_path, monkeypatch):
    spec = ExportSpec(fields="t", metadata="_id", time_field="t", max_rows_per_file=170)
    want = [r["_id"] for r in shuffled(spark).orderBy("t", "_id").collect()]
    path = export(shuffled(spark), spec, str(tmp_path / "sorted"))
    rows = read_ordered(spark, path, "_id long, t timestamp_ntz").orderBy("rn").collect()
    assert [r["rn"] for r in rows] == list(range(1, 3001)) and [r["_id"] for r in rows] == want
    # without the sort of the job the places are wrong
    monkeypatch.setattr(job, "order_rows", lambda rows, docs, spec, *a, **k: rows.select("_id", "t"))
    path = export(shuffled(spark).repartition(4), spec, str(tmp_path / "unsorted"))
    rows = read_ordered(spark, path, "_id long, t timestamp_ntz").orderBy("rn").collect()
    assert len(rows) == 3000 and [r["_id"] for r in rows] != want


def test_places_in_split_files(spark, tmp_path, small_splits):
    rows = read_ordered(spark, big_csv(tmp_path), SCHEMA).orderBy("rn").collect()
    assert [(r["rn"], r["v"]) for r in rows] == [(i + 1, i + 0.5) for i in range(20_000)]


# -- sinks -----------------------------------------------------------------

def test_what_a_cut_off_overwrite_leaves_is_recovered(spark, tmp_path):
    path = str(tmp_path / "one.csv")
    write_single_csv(spark.range(3), path)
    os.rename(path, path + ".old")  # cut off between the two renames
    with pytest.raises(FileExistsError):
        write_single_csv(spark.range(5), path)
    assert len(open(path).read().splitlines()) == 4 and not os.path.exists(path + ".old")
    (tmp_path / "one.csv.old").write_text("left over")  # cut off before the old file was deleted
    write_single_csv(spark.range(5), path, overwrite=True)
    assert len(open(path).read().splitlines()) == 6 and not os.path.exists(path + ".old")


def test_marks_of_a_single_file(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, 1.5D AS b")
    with pytest.raises(ValueError, match="must differ"):
        write_single_csv(df, str(tmp_path / "x.csv"), sep=",", decimal=",")
    write_single_csv(df, str(tmp_path / "y.csv"), sep=".", decimal=",")
    assert open(tmp_path / "y.csv").read() == "a.b\n1.1,5\n"


# -- one pass --------------------------------------------------------------

def test_export_and_aggregate_scan_and_dedup_once(spark, tmp_path, monkeypatch):
    docs = scan(spark, f"{SF}/events.parquet", id_field="event_id")
    spec = ExportSpec(fields="event_id,ts,event_type,value", time_field="ts", rename="event_type--kind")
    agg = AggSpec(keys="event_type", functions="value--sum,event_id--count", time_field="ts", days=7)
    plans, files, write = [], set(), job.write_csv

    def watched(df, path, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        files.update(df.inputFiles())
        return write(df, path, **kwargs)
    monkeypatch.setattr(job, "write_csv", watched)
    out, parts = str(tmp_path / "e"), str(tmp_path / "a")
    export_and_aggregate(docs, spec, agg, out, parts, agg_parts=True)
    assert len(plans) == 2 and files and all("/export-rows-" in f for f in files)
    assert "HashAggregate" not in plans[0]  # the copy is distinct already
    assert "event_type:string" in plans[1] and "event_type:string" in plans[0]
    with pytest.raises(Exception):
        export_and_aggregate(docs, spec, agg, out, parts)  # both are there
    one = str(tmp_path / "one.csv")
    job.write_single_csv(job.aggregate_frame(export_frame(docs, spec, keep_names=True), agg, spec.rename), one)
    ddl = "ts date, kind string, s double, n long"
    assert sorted(map(str, read_csv(spark, parts, ddl).collect())) == sorted(map(str, read_csv(spark, one, ddl).collect()))
    base = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "scratch")
    assert not [x for x in os.listdir(base) if x.startswith("export-rows")]


# -- hits without a schema -------------------------------------------------

def test_hits_without_a_declared_schema(spark, tmp_path):
    path = file(tmp_path / "h", "x.json", '{"_id":"1","_index":"i","_score":1,"_source":{"a":1,"n":{"x":1},"t":"2024-01-01T00:00:00Z"}}\n'
                '{"_id":"2","_index":"i","_source":{"a":"one","n":{"x":2.5,"y":true},"b":[1]}}\n{"_id":"3","_source":{}}\n')
    df = read_hits_json(spark, path)
    assert df.columns == ["_index", "_id", "_score", "a", "b", "n", "t"] and df.schema["a"].dataType == StringType()
    assert df.schema["_score"].dataType == DoubleType() and df.schema["b"].dataType.elementType == LongType()
    rows = {r["_id"]: r for r in df.collect()}
    assert (rows["1"]["a"], rows["2"]["a"], rows["3"]["a"]) == ("1", "one", None) and rows["2"]["n"]["x"] == 2.5
    assert export_frame(df, ExportSpec(fields="a,n.x", time_field="t")).collect()[0]["n.x"] == 1.0
    with pytest.raises(ValueError, match="_source"):
        read_hits_json(spark, file(tmp_path / "none", "x.json", '{"_id":"1"}\n'))
