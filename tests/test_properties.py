"""Property checks with generated inputs (hypothesis), kept small for Spark."""

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st

from docexport.functions.fmt import round_floats
from docexport.operators.aggregate import aggregate
from docexport.spec import AggSpec, parse_couples, parse_duration

names = st.text(alphabet="abcxyz_", min_size=1, max_size=5)


@given(st.lists(st.tuples(names, names), max_size=8))
def test_couples_last_wins(pairs):
    text = ",".join(f"{a}--{b}" for a, b in pairs)
    assert parse_couples(text) == dict(pairs)


@given(st.integers(min_value=1, max_value=10_000), st.sampled_from("dwMy"))
def test_durations_scale_linearly(n, unit):
    assert parse_duration(f"{n}{unit}") == n * parse_duration(f"1{unit}")


SLOW = settings(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40))
def test_rounding_is_numpy_rounding(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.x for r in round_floats(df, 2).collect()]
    assert got == list(np.round(np.array(xs), 2))


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.integers(-1000, 1000).map(lambda i: i / 8))),
                min_size=0, max_size=30))
def test_group_sums_are_exact_and_drop_null_keys(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["s"], r["c"]) for r in aggregate(
        df, AggSpec(keys="k", functions="v--sum,k--count", names="v--s,k--c")).collect()}
    want = {}
    for k, v in rows:
        if k is None:
            continue
        s, c = want.get(k, (0, 0))
        want[k] = (s + (round(v * 100) if v is not None else 0), c + 1)
    assert set(got) == set(want)
    for k, (s_cents, c) in want.items():
        assert got[k][1] == c
        # exact: integer cents of half-even-rounded values, summed without error
        assert round(got[k][0] * 100) == s_cents
