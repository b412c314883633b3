"""Every registered query against its DuckDB SQL form, on the smallest tables."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry_mod
from docexport.plans.catalog import ORACLE, QUERIES
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    cols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    dcols, drows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert rows_of(cols, srows) == rows_of(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["ts", "event_type"]
