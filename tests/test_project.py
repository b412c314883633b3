import json


from docexport.operators.project import cells_as_text, rename_columns, select_fields
from docexport.sources.readers import lift_hits, read_hits_json, scan


def _json_df(spark, docs, schema=None):
    rdd_text = [json.dumps(d) for d in docs]
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(spark.sparkContext.parallelize(rdd_text, 1))


def test_falsy_leaf_kept_by_default_and_nulled_in_parity(spark):
    df = _json_df(spark, [{"a": {"b": 0, "c": "x", "d": "", "e": False, "f": []}}],
                  "a struct<b:bigint,c:string,d:string,e:boolean,f:array<bigint>>")
    fields = ["a.b", "a.c", "a.d", "a.e", "a.f"]
    keep = select_fields(df, fields, id_col=None).first()
    assert (keep["a.b"], keep["a.c"], keep["a.d"], keep["a.e"], keep["a.f"]) == (0, "x", "", False, [])
    null = select_fields(df, fields, id_col=None, falsy="null").first()
    assert (null["a.b"], null["a.c"], null["a.d"], null["a.e"], null["a.f"]) == (None, "x", None, None, None)


def test_dotted_key_alone_and_with_nested(spark):
    only = _json_df(spark, [{"a.b": "lit"}], "`a.b` string")
    assert select_fields(only, ["a.b"], id_col=None).first()["a.b"] == "lit"
    both = _json_df(spark, [{"a.b": "lit", "a": {"b": "nested"}},
                            {"a.b": "lit", "a": {"b": ""}}],
                    "`a.b` string, a struct<b:string>")
    keep = [r["a.b"] for r in select_fields(both, ["a.b"], id_col=None).collect()]
    assert keep == ["nested", ""]
    parity = [r["a.b"] for r in select_fields(both, ["a.b"], id_col=None, falsy="null").collect()]
    assert parity == ["nested", "lit"]


def test_paths_through_array_number_absent(spark):
    df = _json_df(spark, [{"a": [{"n": 1}, {"n": 2}], "b": 5}],
                  "a array<struct<n:bigint>>, b bigint")
    r = select_fields(df, ["a.n", "b.x", "c", "c.d"], id_col=None).first()
    assert (r["a.n"], r["b.x"], r["c"], r["c.d"]) == (None, None, None, None)


def test_empty_object_and_map_paths(spark):
    df = _json_df(spark, [{"m": {"k": 3}}, {}], "m map<string,bigint>")
    assert [r["m.k"] for r in select_fields(df, ["m.k"], id_col=None).collect()] == [3, None]


def test_parent_dropped_in_parity(spark):
    df = _json_df(spark, [{"a": {"b": 1}}], "a struct<b:bigint>")
    r = select_fields(df, ["a", "a.b"], id_col=None, falsy="null", drop_parents=True).first()
    assert r["a"] is None and r["a.b"] == 1
    r = select_fields(df, ["a", "a.b"], id_col=None).first()
    assert r["a"]["b"] == 1


def test_whole_object_and_array_as_one_cell(spark):
    df = _json_df(spark, [{"o": {"x": 1, "y": "z"}, "l": [1, 2]}], "o struct<x:bigint,y:string>, l array<bigint>")
    r = cells_as_text(df).first()
    assert json.loads(r["o"]) == {"x": 1, "y": "z"} and json.loads(r["l"]) == [1, 2]


def test_metadata_before_fields_id_carried(spark):
    df = _json_df(spark, [{"_id": "7", "_index": "i", "v": 1}], "_id string, _index string, v bigint")
    assert select_fields(df, ["v"], metadata=["_index"]).columns == ["_index", "v", "_id"]
    assert select_fields(df, ["v"], metadata=["_id", "_index"]).columns == ["_id", "_index", "v"]


def test_rename_ignores_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, {"a": "x", "zzz": "y"}).columns == ["x", "b"]


def test_lift_hits_metadata_wins(spark, tmp_path):
    p = tmp_path / "hits.json"
    p.write_text(json.dumps({"_index": "ix", "_type": "_doc", "_id": "1", "_score": 2.0,
                             "_source": {"_id": "body", "a": {"b": 3}, "t": "x"}}) + "\n")
    df = read_hits_json(spark, str(p), "_id string, a struct<b:bigint>, t string",
                        metadata=["_index", "_id"])
    r = df.first()
    assert df.columns == ["_index", "_id", "a", "t"] and r["_id"] == "1" and r["a"]["b"] == 3
    assert lift_hits(spark.read.json(str(p)), ["_score"]).columns[0] == "_score"


def test_scan_wildcard_index_names(spark, tmp_path):
    for name in ("logs-2024.01", "logs-2024.02"):
        spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / name))
    df = scan(spark, str(tmp_path / "logs-*"))
    assert sorted(r["_index"] for r in df.collect()) == ["logs-2024.01", "logs-2024.02"]
    df2 = scan(spark, {"a": str(tmp_path / "logs-2024.01"), "b": str(tmp_path / "logs-2024.02")})
    assert sorted(r["_index"] for r in df2.collect()) == ["a", "b"]
    df3 = scan(spark, str(tmp_path / "logs-2024.01"), id_field="x")
    assert df3.select("_index", "_id").first() == ("logs-2024.01", 1)


def test_scan_keeps_existing_metadata(spark, tmp_path):
    p = str(tmp_path / "withmeta")
    spark.createDataFrame([("ix", "id1", 5)], "_index string, _id string, n int").write.parquet(p)
    df = scan(spark, p)
    assert df.columns == ["_index", "_id", "n"] and df.first()["_index"] == "ix"
    df2 = scan(spark, p, id_field="n")
    assert sorted(df2.columns) == ["_id", "_index", "n"] and df2.first()["_id"] == 5
