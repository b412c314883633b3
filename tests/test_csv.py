"""CSV sinks and sources: round trips, separators, decimal comma, parts, overwrite guard."""

import datetime as dt
from decimal import Decimal

import pytest

from docexport.sinks.csv import part_files, write_csv
from docexport.sources.readers import read_csv, read_parts

SCHEMA = "id long, txt string, x double, b boolean, t timestamp_ntz"
ROWS = [
    (1, 'He said "hi", then left', 1.5, True, dt.datetime(2024, 3, 31, 0, 30, 0, 123456)),
    (2, "line one\nline two; with semicolon", -0.125, False, dt.datetime(2024, 1, 1)),
    (3, "  padded  ", None, None, None),
    (4, "", 1e-05, True, dt.datetime(1999, 12, 31, 23, 59, 59, 999999)),
    (5, "àéîõü — ß", 12345.675, False, dt.datetime(2024, 2, 29, 12)),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _read_back(spark, path, sep=",", decimal="."):
    return sorted(tuple(r) for r in read_csv(spark, path, SCHEMA, sep, decimal).collect())


@pytest.mark.parametrize("sep,decimal", [(",", "."), (";", ","), ("|", "."), ("\t", ",")])
def test_round_trip(spark, df, tmp_path, sep, decimal):
    path = str(tmp_path / "out")
    write_csv(df, path, sep=sep, decimal=decimal, rounding=None)
    got = _read_back(spark, path, sep, decimal)
    want = sorted(tuple(None if v == "" else v for v in r) for r in ROWS)  # empty text -> NULL
    assert got == want


def test_rounding_half_even_on_write(spark, df, tmp_path):
    path = str(tmp_path / "r")
    write_csv(df, path, rounding=2)
    xs = {r["id"]: r["x"] for r in read_csv(spark, path, SCHEMA).collect()}
    assert xs[2] == -0.12 and xs[4] == 0.0 and xs[5] == 12345.68


def test_decimal_comma_text(spark, df, tmp_path):
    path = str(tmp_path / "dc")
    write_csv(df.select("id", "x"), path, sep=";", decimal=",", rounding=2, single_file=True)
    text = "".join(open(p.replace("file:", "")).read() for p in part_files(spark, path))
    assert "1;1,5" in text and "2;-0,12" in text
    with pytest.raises(ValueError):
        write_csv(df, str(tmp_path / "bad"), sep=",", decimal=",")


def test_parts_bounded_and_merged(spark, tmp_path):
    orders = spark.range(0, 2500).selectExpr("id", "id * 2 AS y").repartition(2)
    path = str(tmp_path / "parts")
    write_csv(orders, path, max_rows_per_file=400)
    files = part_files(spark, path)
    assert len(files) >= 7
    other = spark.range(2500, 2600).selectExpr("id", "'z' AS w")
    p2 = str(tmp_path / "parts2")
    write_csv(other, p2, single_file=True)
    assert len(part_files(spark, p2)) == 1
    merged = read_parts(spark, [path, p2], ["id long, y long", "id long, w string"])
    assert merged.count() == 2600 and merged.columns == ["id", "y", "w"]
    assert merged.filter("w IS NOT NULL").count() == 100


def test_overwrite_guard(spark, df, tmp_path):
    path = str(tmp_path / "g")
    write_csv(df, path)
    with pytest.raises(Exception):
        write_csv(df, path)
    write_csv(df.limit(1), path, overwrite=True)
    assert read_csv(spark, path, SCHEMA).count() == 1


def test_empty_frame_keeps_header(spark, tmp_path):
    path = str(tmp_path / "empty")
    write_csv(spark.createDataFrame([], SCHEMA), path, single_file=True)
    files = part_files(spark, path)
    assert open(files[0].replace("file:", "")).readline().strip() == "id,txt,x,b,t"


def test_nested_cells_as_json(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', 'x') AS o, array(1, 2) AS l")
    path = str(tmp_path / "nested")
    write_csv(df, path, single_file=True)
    got = read_csv(spark, path, "id long, o string, l string").first()
    assert got["o"] == '{"a":1,"b":"x"}' and got["l"] == "[1,2]"


def test_single_file_and_kept_parts(spark, tmp_path):
    from docexport.sinks.csv import write_single_csv
    df = spark.range(0, 3000).selectExpr("id", "id * 0.5 AS x").repartition(4).orderBy("id")
    path = str(tmp_path / "one.csv")
    write_single_csv(df, path, keep_parts=True, max_rows_per_file=500)
    lines = open(path).read().splitlines()
    assert lines[0] == "id,x" and len(lines) == 3001
    assert [int(line.split(",")[0]) for line in lines[1:]] == list(range(3000))  # order kept
    assert len(part_files(spark, path + ".parts")) >= 6
    with pytest.raises(FileExistsError):
        write_single_csv(df, path)
    write_single_csv(df.limit(2), path, overwrite=True)
    assert len(open(path).read().splitlines()) == 3


def test_raw_csv_fixture_then_aggregate(spark, tmp_path):
    """A hand-written raw CSV: decimal comma, quotes, newlines, empty cells, both boolean
    spellings, zoned timestamps; read with a schema and aggregated by 1-day buckets in Rome."""
    from docexport.operators.aggregate import aggregate
    from docexport.spec import AggSpec
    text = (
        'k;v;flag;t;note\n'
        'a;1,5;True;2024-03-30T22:30:00Z;"semi; colon"\n'
        'a;2,25;false;2024-03-31T00:30:00Z;"two\nlines"\n'
        'b;;False;2024-03-31T01:30:00+00:00;"say ""hi"""\n'
        'b;0,125;true;2024-03-31T22:30:00Z;\n'
    )
    p = tmp_path / "raw.csv"
    p.write_text(text)
    df = read_csv(spark, str(p), "k string, v double, flag boolean, t timestamp, note string",
                  sep=";", decimal=",")
    rows = sorted((tuple(r) for r in df.select("k", "v", "flag", "note").collect()), key=repr)
    assert rows == sorted([("a", 1.5, True, "semi; colon"), ("a", 2.25, False, "two\nlines"),
                    ("b", None, False, 'say "hi"'), ("b", 0.125, True, None)], key=repr)
    got = aggregate(df, AggSpec(keys="k", functions="v--sum,flag--sum", bool_columns="flag",
                                time_field="t", zone="Europe/Rome"))
    out = sorted((str(r[0]), r[1], r[2], r[3]) for r in got.collect())
    assert out == [("2024-03-30", "a", 1.5, 1), ("2024-03-31", "a", 2.25, 0),
                   ("2024-03-31", "b", 0.0, 0), ("2024-04-01", "b", 0.12, 1)]


def test_boolean_spelling(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, b boolean")
    path = str(tmp_path / "bools")
    write_csv(df, path, single_file=True, bool_text=("True", "False"))
    text = open(part_files(spark, path)[0].replace("file:", "")).read()
    assert "1,True" in text and "2,False" in text and "3," in text
    back = {r["id"]: r["b"] for r in read_csv(spark, path, "id int, b boolean").collect()}
    assert back == {1: True, 2: False, 3: None}


def _text_file(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(body)
    return str(folder)


def test_declared_columns_are_found_by_header_name(spark, tmp_path):
    path = _text_file(tmp_path / "a", "x.csv", "b,extra,a\nq,9,1.5\n")
    assert [tuple(r) for r in read_csv(spark, path, "a double, b string").collect()] == [(1.5, "q")]


def test_absent_column_other_header_and_bad_cell_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="no column v"):
        read_csv(spark, _text_file(tmp_path / "a", "x.csv", "k\n1\n"), "k int, v int")
    mixed = _text_file(tmp_path / "b", "x.csv", "a,b\n1,2\n")
    _text_file(tmp_path / "b", "y.csv", "b,a\n3,4\n")
    with pytest.raises(Exception):
        read_csv(spark, mixed, "a int, b int").collect()
    with pytest.raises(Exception):
        read_csv(spark, _text_file(tmp_path / "c", "x.csv", 'a,b\n"1,234.5",2\n'), "a double, b int").collect()
    with pytest.raises(Exception, match="not a number"):
        read_csv(spark, _text_file(tmp_path / "d", "x.csv", "a;b\n1.234,5;2\n"), "a double, b int", sep=";", decimal=",").collect()


def test_decimal_mark_in_every_fractional_type(spark, tmp_path):
    path = _text_file(tmp_path / "a", "x.csv", "a;b;c\n1,5;2,5;3,25\n;;\n")
    rows = read_csv(spark, path, "a double, b float, c decimal(10,2)", sep=";", decimal=",").collect()
    assert [tuple(r) for r in rows] == [(1.5, 2.5, Decimal("3.25")), (None, None, None)]
