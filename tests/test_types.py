"""Fields whose types differ between sources, maps and nested objects in dedup, order codes."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType,
                               NullType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType)

from docexport.operators.dedup import dedup_by_fields, dedup_by_id, union_parts
from docexport.operators.project import select_fields
from docexport.operators.types import common_type, same_type
from docexport.plans.job import export_frame
from docexport.sources.readers import scan
from docexport.spec import ExportSpec

TYPES = [BooleanType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType(), DecimalType(10, 2), DecimalType(38, 10), DateType(),
         TimestampType(), TimestampNTZType(), StringType(), NullType(), ArrayType(LongType()), StructType([StructField("a", IntegerType())]),
         MapType(StringType(), IntegerType())]


def test_common_types_form_a_lattice():
    """The order of sources decides nothing, nor does taking them in twos."""
    for a, b in itertools.product(TYPES, TYPES):
        assert same_type(common_type(a, b), common_type(b, a)), (a, b)
        assert same_type(common_type(a, a), a)
        assert same_type(common_type(common_type(a, b), a), common_type(a, b)), (a, b)
    assert common_type(IntegerType(), LongType()) == LongType()
    assert common_type(LongType(), FloatType()) == DoubleType()
    assert common_type(DecimalType(10, 2), LongType()) == DecimalType(21, 2)
    assert common_type(IntegerType(), StringType()) == StringType()
    assert common_type(DateType(), TimestampType()) == TimestampNTZType()


def test_union_of_types_that_differ(spark):
    a = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3), {"k": 1}, [1], True)], "n int, t timestamp_ntz, o map<string,int>, l array<int>, x boolean")
    b = spark.createDataFrame([(2.5, dt.date(2024, 1, 3), {"k": "z"}, ["y"], "text")], "n double, t date, o map<string,string>, l array<string>, x string")
    c = spark.createDataFrame([("three", None, None, None, 7)], "n string, t date, o map<string,string>, l array<string>, x int")
    two = union_parts(a, b)
    assert [tuple(r) for r in two.orderBy("n").collect()] == [
        (1.0, dt.datetime(2024, 1, 2, 3), {"k": "1"}, ["1"], "true"), (2.5, dt.datetime(2024, 1, 3), {"k": "z"}, ["y"], "text")]
    three = union_parts(a, b, c)
    assert sorted((r["n"], r["x"]) for r in three.collect()) == [("1", "true"), ("2.5", "text"), ("three", "7")]
    s1 = spark.sql("SELECT named_struct('a', 1, 'b', 'x') AS s")
    s2 = spark.sql("SELECT named_struct('a', 2.5D, 'c', true) AS s UNION ALL SELECT CAST(NULL AS STRUCT<a:double,c:boolean>)")
    assert sorted(str(r["s"]) for r in union_parts(s1, s2).collect()) == ["None", "Row(a=1.0, b='x', c=None)", "Row(a=2.5, b=None, c=True)"]
    assert union_parts(a, a).schema == a.schema


@pytest.fixture(scope="module")
def drifting(spark, tmp_path_factory):
    """An index pattern whose files hold ``v`` as int, bigint, double and text, and one with nested drift."""
    base = tmp_path_factory.mktemp("drift")
    kinds = ["int", "int", "bigint", "double", "string", "int"]
    for i, kind in enumerate(kinds):
        (spark.range(i * 10, i * 10 + 10).selectExpr("id", f"cast(id as {kind}) AS v", f"named_struct('w', cast(id as {kind})) AS o",
                                                     f"'x' AS only_{i % 2}").coalesce(1).write.parquet(f"{base}/logs-{i}"))
    return str(base)


def test_scan_of_a_pattern_with_drifting_types(spark, drifting):
    got = scan(spark, f"{drifting}/logs-*", id_field="id")
    assert got.schema["v"].dataType == StringType() and got.schema["o"].dataType.simpleString() == "struct<w:string>"
    rows = {r["_id"]: r for r in got.collect()}
    assert len(rows) == 60
    for i, r in rows.items():
        text = f"{i}.0" if i // 10 == 3 else str(i)
        assert (r["v"], r["o"]["w"], r["_index"]) == (text, text, f"logs-{i // 10}")
        assert (r["only_0"] is None) != (r["only_1"] is None)
    numbers = scan(spark, f"{drifting}/logs-[0-3]", id_field="id")
    assert numbers.schema["v"].dataType == DoubleType() and numbers.count() == 40


def test_scan_of_a_dict_and_a_list_with_drifting_types(spark, drifting):
    got = scan(spark, {"a": f"{drifting}/logs-0", "b": f"{drifting}/logs-2"}, id_field="id")
    assert got.schema["v"].dataType == LongType() and {r["_index"] for r in got.collect()} == {"a", "b"}
    got = scan(spark, [f"{drifting}/logs-1", f"{drifting}/logs-4"])
    assert got.schema["v"].dataType == StringType() and got.count() == 20


def test_filters_and_columns_reach_the_scans_of_drifting_files(spark, drifting):
    df = scan(spark, f"{drifting}/logs-*", id_field="id").filter("id > 12").select("_id", "v")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert plan.count("GreaterThan(id,12)") >= 4 and "only_0" not in plan.split("ReadSchema", 1)[1].split("\n")[0]


def test_nested_text_beside_a_literal_number(spark):
    df = spark.sql("SELECT named_struct('b', 'text') AS a, 7L AS `a.b` UNION ALL SELECT named_struct('b', CAST(NULL AS STRING)), 8L")
    got = select_fields(df, ["a.b"], id_col=None)
    assert got.schema["a.b"].dataType == StringType() and sorted(r[0] for r in got.collect()) == ["8", "text"]
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2.5D AS `a.b` UNION ALL SELECT named_struct('b', CAST(NULL AS INT)), 0.5D")
    assert sorted(r[0] for r in select_fields(df, ["a.b"], id_col=None).collect()) == [0.5, 1.0]


# -- dedup -----------------------------------------------------------------

MAPS = """SELECT * FROM VALUES
  (1, map('a', 1, 'b', 2), array(map('x', map(1, 'p', 2, 'q'))), 'one'),
  (1, map('b', 2, 'a', 1), array(map('x', map(2, 'q', 1, 'p'))), 'one'),
  (1, map('a', 1, 'b', 3), array(map('x', map(1, 'p', 2, 'q'))), 'one'),
  (2, NULL, NULL, 'two'), (2, NULL, NULL, 'two'), (2, map(), array(), 'two') AS t(_id, m, l, s)"""


def test_dedup_on_maps_and_nested_maps(spark):
    df = spark.sql(MAPS)
    got = dedup_by_id(df, ["m", "l", "s"])
    assert got.columns == ["_id", "m", "l", "s"] and got.schema == df.select("_id", "m", "l", "s").schema
    assert sorted((r["_id"], str(sorted((r["m"] or {}).items())), r["m"] is None) for r in got.collect()) == [
        (1, "[('a', 1), ('b', 2)]", False), (1, "[('a', 1), ('b', 3)]", False), (2, "[]", False), (2, "[]", True)]
    exported = export_frame(df, ExportSpec(fields="m,l,s", metadata="_id"))
    assert exported.count() == 4


def test_dedup_on_fields_with_maps(spark):
    df = spark.sql(MAPS).withColumn("t", F.col("_id"))
    got = dedup_by_fields(df.select("m", "s", "_id"), ["m", "s"], ["_id"])
    assert got.columns == ["m", "s", "_id"] and got.count() == 4


def first_by_force(rows, order):
    best = {}
    for r in rows:
        key = tuple((r[c] is not None, r[c]) if r[c] is not None else (False, 0) for c in order)
        if r["f"] not in best or key < best[r["f"]][0]:
            best[r["f"]] = (key, r)
    return sorted((str(f), *(str(r[c]) for c in order)) for f, (_, r) in best.items())


ORDERS = [("t timestamp_ntz, i bigint", ["t", "i"]), ("t timestamp, i int", ["t", "i"]), ("t date, i smallint", ["t", "i"]), ("t bigint", ["t"]),
          ("t timestamp_ntz, i string", ["t", "i"]), ("t bigint, i bigint", ["t", "i"]), ("t boolean, i int", ["t", "i"])]


@pytest.mark.parametrize("ddl,order", ORDERS)
def test_first_row_wins_for_any_order(spark, ddl, order):
    rng = random.Random(ddl)

    def value(kind):
        if rng.random() < 0.15:
            return None
        return {"timestamp_ntz": lambda: dt.datetime(1960, 1, 1) + dt.timedelta(microseconds=rng.randrange(10 ** 16)),
                "timestamp": lambda: dt.datetime(1990, 1, 1) + dt.timedelta(seconds=rng.randrange(10 ** 9)),
                "date": lambda: dt.date(1960, 1, 1) + dt.timedelta(days=rng.randrange(40_000)),
                "bigint": lambda: rng.choice([-2 ** 63, 2 ** 63 - 1, 0, rng.randrange(-10 ** 12, 10 ** 12)]),
                "int": lambda: rng.randrange(-5, 5), "smallint": lambda: rng.randrange(-3, 3), "boolean": lambda: rng.random() < 0.5,
                "string": lambda: str(rng.randrange(100))}[kind]()
    kinds = [x.split()[1] for x in ddl.split(", ")]
    rows = [(rng.choice(["a", "b", "c", None]), *(value(k) for k in kinds)) for _ in range(60)]
    df = spark.createDataFrame(rows, "f string, " + ddl).repartition(4)
    got = dedup_by_fields(df, ["f"], order)
    assert got.schema == df.schema
    names = ["f", *order]
    assert sorted((str(r["f"]), *(str(r[c]) for c in order)) for r in got.collect()) == first_by_force([dict(zip(names, r)) for r in rows], order)


def test_time_and_whole_number_need_no_sort(spark):
    df = spark.sql("SELECT uuid() AS text, timestamp_ntz'2024-01-01 00:00:00' AS t, id FROM range(10)")
    for fields in (["text"], ["text", "t"], ["text", "t", "id"]):
        plan = dedup_by_fields(df, fields, ["t", "id"])._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "Sort" not in plan
