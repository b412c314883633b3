"""Time slices: properties, edge cases, and a brute-force restatement of the walk."""

import datetime as dt
import os
import random

import pytest

from docexport.operators import slices
from docexport.operators.slices import assign_slices, slice_table
from docexport.spec import SliceSpec

EPOCH = dt.datetime(1970, 1, 1)
US = 1_000_000


def frame(spark, micros):
    rows = [(i, EPOCH + dt.timedelta(microseconds=u)) for i, u in enumerate(micros)]
    return spark.createDataFrame(rows, "id long, t timestamp_ntz")


def brute(micros, n, step_us=None):
    """Slice of each time, by walking the grid one step at a time."""
    lo, hi, total = min(micros), max(micros), len(micros)
    cuts = []
    if step_us is not None:
        start, e = 0, 1
        while len(cuts) < n - 1 and e * step_us <= hi - lo:
            hits = sum(1 for u in micros if lo + start * step_us <= u < lo + e * step_us)
            if hits >= total / n:
                cuts.append(e)
                start = e
            e += 1
    m = len(cuts)
    last = lo + (cuts[-1] * step_us if cuts else 0)
    r0 = min(u for u in micros if u >= last)
    w = n - m
    out = []
    for u in micros:
        if m and u < last:
            out.append(sum(1 for c in cuts if lo + c * step_us <= u))
        else:
            out.append(m + (0 if hi == r0 else min(w - 1, (u - r0) * w // (hi - r0))))
    return out


def labels(spark, micros, spec):
    got = assign_slices(frame(spark, micros), "t", spec).orderBy("id").collect()
    return [r["slice_id"] for r in got]


CASES = {
    "even": [i * 3600 * US for i in range(200)],
    "skewed": [i * 60 * US for i in range(150)] + [86400 * 40 * US + i * US for i in range(50)],
    "one_row": [123 * US],
    "one_instant": [5 * US] * 7,
}


@pytest.mark.parametrize("name", list(CASES))
@pytest.mark.parametrize("n", [1, 3, 4])
def test_equal_slices_match_brute_force(spark, name, n):
    micros = CASES[name]
    assert labels(spark, micros, SliceSpec(n=n)) == brute(micros, n)


@pytest.mark.parametrize("name,n,step", [("even", 4, "1d"), ("even", 10, "2d"), ("skewed", 4, "1d"),
                                         ("skewed", 3, "7d"), ("even", 1, "1d")])
def test_load_slices_match_brute_force(spark, name, n, step):
    micros = CASES[name]
    spec = SliceSpec(n=n, step=step)
    assert labels(spark, micros, spec) == brute(micros, n, spec.step_seconds * US)


def test_random_load_slices(spark):
    rng = random.Random(7)
    for trial in range(4):
        micros = sorted(rng.randrange(0, 60 * 86400) * US for _ in range(rng.randrange(20, 300)))
        if rng.random() < 0.5:  # a hot instant holding a third of the rows
            micros += [micros[len(micros) // 2]] * (len(micros) // 2)
        n = rng.randrange(2, 9)
        spec = SliceSpec(n=n, step=rng.choice(["1d", "2d", "5d"]))
        assert labels(spark, micros, spec) == brute(micros, n, spec.step_seconds * US), trial


def test_slice_table_properties(spark):
    micros = CASES["skewed"]
    for spec in (SliceSpec(n=4), SliceSpec(n=4, step="1d"), SliceSpec(n=6, step="2d")):
        t = slice_table(frame(spark, micros), "t", spec).orderBy("slice_id").collect()
        assert [r["slice_id"] for r in t] == list(range(spec.n))
        assert sum(r["n_docs"] for r in t) == len(micros)
        starts = [r["slice_start"] for r in t]
        assert starts == sorted(starts)
        assert t[0]["slice_start"] == EPOCH + dt.timedelta(microseconds=min(micros))
        assert t[-1]["slice_end"] == EPOCH + dt.timedelta(microseconds=max(micros))
        want = brute(micros, spec.n, spec.step_seconds * US if spec.step else None)
        assert [r["n_docs"] for r in t] == [want.count(i) for i in range(spec.n)]


def test_boundary_hit_exactly(spark):
    micros = [0, 86400 * US, 2 * 86400 * US, 3 * 86400 * US, 4 * 86400 * US]
    assert labels(spark, micros, SliceSpec(n=4)) == [0, 1, 2, 3, 3]


def test_step_not_below_span_raises(spark):
    micros = [0, 86400 * US]
    with pytest.raises(Exception, match="not smaller than the span"):
        labels(spark, micros, SliceSpec(n=2, step="2d"))


def test_null_times_have_no_slice(spark):
    df = spark.createDataFrame([(1, None), (2, EPOCH)], "id long, t timestamp_ntz")
    got = {r["id"]: r["slice_id"] for r in assign_slices(df, "t", SliceSpec(n=2)).collect()}
    assert got == {1: None, 2: 0}


def test_over_a_million_steps_match_brute_force(spark, monkeypatch):
    """A span of 1.5 million one-minute steps, walked through several levels of blocks; nothing is refused."""
    rng = random.Random(11)
    minute = 60 * US
    micros = [rng.randrange(0, 1_500_000) * minute + rng.randrange(minute) for _ in range(700)]
    micros += [0, 1_500_000 * minute] + [micros[5]] * 300  # a hot instant
    n = 9
    steps = sorted((u // minute, u) for u in micros)
    cuts, held = [], 0
    for k in sorted({k for k, _ in steps}):
        held += sum(1 for x, _ in steps if x == k)
        if len(cuts) < n - 1 and n * held >= len(micros) and (k + 1) * minute <= max(micros):
            cuts.append(k + 1)
            held = 0
    for fan in (1024, 8):
        monkeypatch.setattr(slices, "FAN", fan)
        plan = slices.slice_plan(frame(spark, micros), "t", SliceSpec(n=n, step="1m", allow_short=True)).first()
        assert plan["__cuts"] == cuts and len(cuts) > 3
        assert plan["__r0"] == min(u for u in micros if u >= cuts[-1] * minute)


def test_the_walk_opens_only_blocks_with_a_cut(spark, monkeypatch):
    """Every job of the walk fetches bounded totals, and blocks without a cut stay closed."""
    monkeypatch.setattr(slices, "FAN", 16)
    hist = spark.createDataFrame([(k, 1) for k in range(0, 60_000, 7)], "k long, c long")
    fetched = []
    plain = slices._Histogram.parts

    def parts(self, width, starts):
        out = plain(self, width, starts)
        fetched.append((width, len(out)))
        return out
    monkeypatch.setattr(slices._Histogram, "parts", parts)
    total = len(range(0, 60_000, 7))
    cuts = slices.load_cuts(hist, 3, total, 60_000, 59_999)
    assert cuts == [7 * (-(-total // 3) - 1) + 1, 7 * (2 * -(-total // 3) - 1) + 1]
    assert max(n for _, n in fetched) <= 16 and len(fetched) <= 1 + 2 * 3


def test_empty_table_has_no_slices(spark):
    df = spark.createDataFrame([], "id long, t timestamp_ntz")
    for spec in (SliceSpec(n=3), SliceSpec(n=3, step="1d")):
        assert slice_table(df, "t", spec).collect() == []
        assert assign_slices(df, "t", spec).collect() == []


def test_scratch_histogram_is_deleted(spark):
    from docexport.session import ensure_checkpoint_dir
    base = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "scratch")
    slice_table(frame(spark, CASES["even"]), "t", SliceSpec(n=4, step="1d")).collect()
    assert not [x for x in os.listdir(base) if x.startswith("slice-histogram")]
