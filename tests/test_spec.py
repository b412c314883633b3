import pytest

from docexport.spec import (AggSpec, ExportSpec, SliceSpec, check_step_below_span, parse_couples,
                            parse_duration, parse_functions, parse_instant)


def test_couples_later_wins_and_bad_skipped():
    assert parse_couples("a--b,c--d,a--e,bad,x--y--z,--q") == {"a": "e", "c": "d"}
    assert parse_couples("") == {}


def test_functions_default_count_and_errors():
    assert parse_functions("a--sum,b,c--MEAN") == {"a": "sum", "b": "count", "c": "mean"}
    with pytest.raises(ValueError):
        parse_functions("a--median")
    with pytest.raises(ValueError):
        parse_functions("a--sum--x")


def test_durations():
    assert parse_duration("3d") == 3 * 86400
    assert parse_duration("2w") == 2 * 604800
    assert parse_duration("1M") == 30 * 86400
    assert parse_duration("1y") == 360 * 86400
    with pytest.raises(ValueError):
        parse_duration("5m")
    assert parse_duration("5m", allow_short=True) == 300
    assert parse_duration("2h", allow_short=True) == 7200
    for bad in ("", "d", "3x", "1.5d", "-1d", "0d"):
        with pytest.raises(ValueError):
            parse_duration(bad)


def test_step_below_span():
    check_step_below_span(100, 99)
    with pytest.raises(ValueError):
        check_step_below_span(100, 100)


def test_instants_in_zone():
    a = parse_instant("2024-03-31T01:30:00", "Europe/Rome")  # before the clock change
    b = parse_instant("2024-03-31T03:30:00", "Europe/Rome")  # after it
    assert a.isoformat() == "2024-03-31T00:30:00+00:00"
    assert b.isoformat() == "2024-03-31T01:30:00+00:00"
    assert parse_instant("2024-01-01T00:00:00Z").isoformat() == "2024-01-01T00:00:00+00:00"
    assert parse_instant("2024-01-01T02:00:00+02:00", "Asia/Tokyo").hour == 0
    with pytest.raises(ValueError):
        parse_instant("yesterday")


def test_export_spec_checks():
    s = ExportSpec(fields="a,b", metadata="_id,_index", rename="a--x")
    assert s.columns == ("_id", "_index", "a", "b") and s.rename == {"a": "x"}
    with pytest.raises(ValueError):
        ExportSpec(fields="a", metadata="_bogus")
    with pytest.raises(ValueError):
        ExportSpec(fields="a", start="2024-01-01")  # dates without a time field
    with pytest.raises(ValueError):
        ExportSpec(fields="a", time_field="t", start="2024-01-02", end="2024-01-01")
    with pytest.raises(ValueError):
        ExportSpec(fields="a", time_field="t", start="not a date")
    with pytest.raises(ValueError):
        ExportSpec(fields="a", zone="Mars/Olympus")
    with pytest.raises(ValueError):
        ExportSpec(fields="")


def test_agg_and_slice_specs():
    a = AggSpec(keys="k1,k2", functions="v--sum,w", names="v--total")
    assert a.functions == {"v": "sum", "w": "count"} and a.names == {"v": "total"}
    with pytest.raises(ValueError):
        AggSpec()
    with pytest.raises(ValueError):
        AggSpec(keys="k", days=0)
    assert SliceSpec(n=3, step="2d").step_seconds == 172800
    with pytest.raises(ValueError):
        SliceSpec(n=0)
    with pytest.raises(ValueError):
        SliceSpec(n=2, step="1h")
