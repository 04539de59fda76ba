"""Runs of spike hours: islands over midnight and at the window's ends."""

from datetime import datetime, timedelta

from fleetlens.params import Params
from fleetlens.plans.patterns import cpu_spike_batches
from tests.helpers import host, hr, rows, run_of

AS_OF = datetime(2026, 3, 1, 12, 0)


def batches(spark, times, days=30, **kw):
    hourly = [hr("a-D-1", t, None if v is None else float(v)) for t, v in times]
    run = run_of(spark, Params(as_of=AS_OF, events_days=days, **kw), targets=[host("a-D-1")], hourly=hourly)
    return sorted(rows(cpu_spike_batches(run)), key=lambda r: r["start_ts"])


def at(day, hour, minute=0):
    return datetime(2026, 2, day, hour, minute)


def test_one_run_over_midnight(spark):
    got = batches(spark, [(at(10, 22, 30), 98.0), (at(10, 23, 30), 99.5), (at(11, 0, 30), 100.0), (at(11, 2, 30), 98)])
    assert [(r["start_ts"], r["last_spike_ts"], r["length_minutes"], r["samples"], r["peak_cpu"]) for r in got] == [
        ("2026-02-10 22:30", "2026-02-11 00:30", 180, 3, 100.0), ("2026-02-11 02:30", "2026-02-11 02:30", 60, 1, 98.0)]
    assert [r["start_hhmi"] for r in got] == ["22:30", "02:30"]
    assert not any(r["open_start"] or r["open_end"] for r in got)


def test_gap_of_one_grain_joins_a_longer_one_parts(spark):
    t = at(10, 8)
    assert len(batches(spark, [(t, 99), (t + timedelta(minutes=60), 99)])) == 1
    assert len(batches(spark, [(t, 99), (t + timedelta(minutes=61), 99)])) == 2
    assert len(batches(spark, [(t, 99), (t + timedelta(minutes=60), 97.9999), (t + timedelta(minutes=120), 99)])) == 2


def test_copies_and_ties_count_once(spark):
    got = batches(spark, [(at(10, 8), 98.5), (at(10, 8), 99.5), (at(10, 8), 98.5), (at(10, 9), 98)])
    assert [(r["samples"], r["peak_cpu"], r["length_minutes"]) for r in got] == [(2, 99.5, 120)]


def test_days_per_start(spark):
    times = [(at(d, 2, 15), 99) for d in (3, 5, 9)] + [(at(d, 3, 15), 99) for d in (3, 5)] + [(at(20, 3, 15), 99)]
    got = batches(spark, times)
    assert {(r["start_hhmi"], r["days_at_start"], r["pattern_hint"]) for r in got} == {
        ("02:15", 3, "Recurring batch @ 02:15"), ("03:15", 1, "Isolated")}
    assert {r["length_minutes"] for r in got if r["start_hhmi"] == "02:15"} == {60, 120}


def test_window_ends(spark):
    """A run that the window's start or end may have cut is marked and its
    start is none."""
    start = AS_OF - timedelta(days=5)
    times = [(start, 99), (start + timedelta(hours=1), 99)]
    times += [(start + timedelta(days=d), 99) for d in (1, 2, 3)]  # the same time of day, whole
    times += [(AS_OF - timedelta(minutes=30), 99), (AS_OF + timedelta(minutes=5), 99), (start - timedelta(hours=1), 99)]
    got = batches(spark, times, days=5)
    assert [(r["open_start"], r["open_end"], r["days_at_start"], r["samples"]) for r in got] == [
        (True, False, 0, 2), (False, False, 3, 1), (False, False, 3, 1), (False, False, 3, 1), (False, True, 1, 1)]
    assert got[0]["pattern_hint"] == "Isolated" and got[1]["pattern_hint"] == "Recurring batch @ 12:00"


def test_no_spikes(spark):
    assert batches(spark, [(at(10, 8), 50.0), (at(10, 9), None)]) == []
