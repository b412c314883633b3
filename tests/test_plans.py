"""Plan checks: pushdown, pruning, aggregate strategy, no Python UDFs anywhere."""

import pytest

import __spark_entry__ as entry_mod
from docexport.plans.catalog import QUERIES
from conftest import SF
from docexport.operators.dedup import dedup_by_id
from docexport.operators.predicate import time_range
from docexport.sources.readers import scan


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_bounds_pushed_and_columns_pruned(spark):
    docs = scan(spark, f"{SF}/events.parquet", id_field="event_id")
    df = time_range(docs, "ts", "2024-01-05T00:00:00", "2024-01-05T23:59:59", "Europe/Rome")
    p = plan(df.select("event_id", "value"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "LessThanOrEqual(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in p


def test_default_dedup_is_hash_aggregate(spark):
    docs = scan(spark, f"{SF}/events.parquet", id_field="event_id")
    p = plan(dedup_by_id(docs, ["ts", "event_type", "value"]))
    assert "HashAggregate" in p and "SortAggregate" not in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_cross_join_in_any_query(spark, name):
    p = plan(entry_mod.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                 "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert node not in p, (name, node)
