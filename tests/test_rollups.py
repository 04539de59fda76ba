"""Sections from day partials equal those from the readings."""

import random
import tempfile
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetlens.params import Params
from fleetlens.plans import patterns
from fleetlens.plans.context import ReportRun
from fleetlens.plans.report import cpu_report
from fleetlens.plans.rollups import DayStore, RollupRun
from fleetlens.sources.tables import MonitoringTables, materialize_tables, tables_from_rows
from tests.helpers import host

FIRST, DAYS = date(2026, 1, 1), 24


def readings(day_count=DAYS, first=FIRST, seed=1):
    rng, rows = random.Random(seed), []
    values = [98.0, 97.9999996, 100.0, 99.5, 0.0, 3037.5, -4.25, None, float("nan"), float("inf")]
    for h in range(9):
        for hour in range(24 * day_count):
            if rng.random() < 0.3:
                continue
            ts = datetime(first.year, first.month, first.day) + timedelta(hours=hour, minutes=rng.choice((0, 0, 0, 30)))
            v = rng.choice(values) if rng.random() < 0.1 else rng.uniform(0, 110)
            rows += [(f"h-D-{h}", "host", "Load", "cpuUtil", ts, v)] * rng.choice((1, 1, 1, 2))
            if rng.random() < 0.1:  # a tie on the instant
                rows.append((f"h-D-{h}", "host", "Load", "cpuUtil", ts, rng.uniform(0, 110)))
            rows.append((f"h-D-{h}", "host", "Load", "memUsedPct", ts, 99.0))
    return rows


TARGETS = [host(f"h-D-{h}", "AIX" if h % 2 else "Linux") for h in range(7)] + [host("h-D-0"), host("idle-d-1", "AIX")]


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="fleetlens-rollup-src-")
    size = ("db", "oracle_database", "DATABASE_SIZE", "USED_GB", datetime(2026, 1, 1), 1.0)
    return materialize_tables(tables_from_rows(spark, targets=TARGETS, hourly=readings(), daily=[size]), root)


def store_for(spark, params, **kw):
    return DayStore(spark, tempfile.mkdtemp(prefix="fleetlens-rollup-"), params, **kw)


def sections(run):
    out = {**cpu_report(run), "rolling": patterns.cpu_rolling_7d(run), "batches": patterns.cpu_spike_batches(run)}
    return {k: sorted(map(str, v.collect())) for k, v in out.items()}


@pytest.mark.parametrize("as_of,lookback", [
    (datetime(2026, 1, 20, 12, 30), 10),  # partial first and last day
    (datetime(2026, 1, 18), 7),  # from midnight to midnight
    (datetime(2026, 1, 24, 23, 59), 30),  # longer than what is stored, on both sides
    (datetime(2026, 1, 2, 0, 30), 1),  # no whole day inside
])
def test_equal_to_the_direct_reports(spark, tables, as_of, lookback):
    p = Params(as_of=as_of, lookback_days=lookback, events_days=lookback, name_like="%-D-%")
    store = store_for(spark, p)
    store.extend(tables, date(2026, 1, 9), first=date(2026, 1, 3))
    store.extend(tables, date(2026, 1, 19))
    direct, stored = sections(ReportRun(tables, p)), sections(RollupRun(tables, store, p))
    assert stored == direct and any(direct["cpu_spike_days"])


def files_read(df):
    return {r[0].split("rollup_date=")[1][:10] for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_new_day_reads_that_day_only(spark, tables):
    p = Params(as_of=datetime(2026, 1, 20))
    store = store_for(spark, p)
    assert store.extend(tables, date(2026, 1, 9), first=date(2026, 1, 3)) == (date(2026, 1, 3), date(2026, 1, 9))
    assert files_read(store.readings(tables, date(2026, 1, 10), date(2026, 1, 10))) == {"2026-01-10"}
    assert store.extend(tables, date(2026, 1, 10)) == (date(2026, 1, 3), date(2026, 1, 10))
    run = RollupRun(tables, store, Params(as_of=datetime(2026, 1, 11, 12), lookback_days=7))
    assert run.folds.stored_days(7) == (date(2026, 1, 5), date(2026, 1, 10))
    assert files_read(run.cpu_rows(7, run.folds.stored_days(7))) == {"2026-01-04", "2026-01-11"}


def test_late_and_withdrawn_readings(spark, tables):
    """Days stored anew take late readings in and drop what is gone."""
    p = Params(as_of=datetime(2026, 1, 12), lookback_days=9)
    store = store_for(spark, p)
    store.extend(tables, date(2026, 1, 11), first=date(2026, 1, 3))
    ts = F.col("rollup_timestamp")
    late = tables_from_rows(spark, hourly=[("h-D-0", "host", "Load", "cpuUtil", datetime(2026, 1, 6, 5), 100.0)])
    hourly = tables.hourly.drop("rollup_date").where(F.to_date(ts) != F.lit(date(2026, 1, 5))).unionByName(late.hourly)
    now = MonitoringTables(tables.targets, hourly, tables.daily, tables.current, tables.tablespaces)
    assert sections(RollupRun(now, store, p)) != sections(ReportRun(now, p))
    assert store.extend(now, date(2026, 1, 6), first=date(2026, 1, 5)) == (date(2026, 1, 3), date(2026, 1, 11))
    assert sections(RollupRun(now, store, p)) == sections(ReportRun(now, p))


def test_killed_extension_and_gaps(spark, tables, monkeypatch):
    p = Params(as_of=datetime(2026, 1, 12), lookback_days=9)
    store = store_for(spark, p)
    with pytest.raises(ValueError):
        store.extend(tables, date(2026, 1, 9))
    store.extend(tables, date(2026, 1, 8), first=date(2026, 1, 3))
    with pytest.raises(ValueError):
        store.extend(tables, date(2026, 1, 12), first=date(2026, 1, 10))
    write = store._write

    def dies(df, name, first, last):
        if name == "spikes":
            raise KeyboardInterrupt
        write(df, name, first, last)

    monkeypatch.setattr(store, "_write", dies)
    with pytest.raises(KeyboardInterrupt):
        store.extend(tables, date(2026, 1, 10))
    monkeypatch.undo()
    assert store.covered() == (date(2026, 1, 3), date(2026, 1, 8))
    assert sections(RollupRun(tables, store, p)) == sections(ReportRun(tables, p))
    assert store.extend(tables, date(2026, 1, 10)) == (date(2026, 1, 3), date(2026, 1, 10))
    assert sections(RollupRun(tables, store, p)) == sections(ReportRun(tables, p))
    assert store.extend(tables, date(2026, 1, 9)) == store.covered()  # nothing to do


def test_other_cutoff_is_refused(spark, tables):
    p = Params(as_of=datetime(2026, 1, 12))
    store = store_for(spark, p)
    store.extend(tables, date(2026, 1, 8), first=date(2026, 1, 3))
    other = Params(as_of=p.as_of, spike_threshold=95)
    with pytest.raises(ValueError):
        RollupRun(tables, store, other).folds
    with pytest.raises(ValueError):
        DayStore(spark, store.root, other).covered()


def test_empty_store_and_tables(spark, tables):
    p = Params(as_of=datetime(2026, 1, 12), lookback_days=5)
    store = store_for(spark, p)
    assert sections(RollupRun(tables, store, p)) == sections(ReportRun(tables, p))
    nothing = tables_from_rows(spark, targets=TARGETS)
    store.extend(nothing, date(2026, 1, 8), first=date(2026, 1, 3))
    assert sections(RollupRun(nothing, store, p)) == sections(ReportRun(nothing, p))


def test_partials_are_combined_before_the_shuffle_and_read_by_day(spark, tables):
    p = Params(as_of=datetime(2026, 1, 20), lookback_days=9)
    store = store_for(spark, p)
    store.extend(tables, date(2026, 1, 19), first=date(2026, 1, 3))
    run = RollupRun(tables, store, p)
    plan = run.folds._by(9, F.col("rollup_date"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    scans = [x for x in plan.split("\n") if "host_days" in x]
    assert scans and all("PartitionFilters: [isnotnull(rollup_date" in x for x in scans)


# ---- ties, second moments ----------------------------------------------------

def test_latest_with_ties_is_the_same_in_any_order(spark):
    from fleetlens.operators.windows import latest_by_rank, latest_per_host
    at, rng = datetime(2026, 1, 1, 5), random.Random(3)
    rows = [(f"h{h}", at, v, None if v is None else int(v * 1e6)) for h in range(20)
            for v in (1.5, 99.0, 7.25, None, 98.999)] + [("n", at, None, None)] * 3
    rows += [(f"h{h}", at - timedelta(hours=1), 100.0, 100_000_000) for h in range(20)]
    results = set()
    for _ in range(4):
        rng.shuffle(rows)
        df = spark.createDataFrame(
            rows, "target_name string, rollup_timestamp timestamp_ntz, average double, cpu_units bigint").repartition(7)
        for f in (latest_per_host, latest_by_rank):
            got = f(df).select("target_name", "rollup_timestamp", "average", "cpu_units").collect()
            results.add(tuple(sorted(map(str, got))))
    assert len(results) == 1
    assert all("average=99.0, cpu_units=99000000" in r or "target_name='n'" in r for r in results.pop())


def test_second_moments_are_exact(spark):
    from fleetlens.functions.numbers import square_sum, square_sums
    rng = random.Random(5)
    values = [rng.randrange(-10 ** 8, 10 ** 8) for _ in range(500)] + [0, -1, 1, 2 ** 31, -2 ** 31, 2 ** 31 - 1,
              2 ** 40 + 12345, -2 ** 45 - 7, 3_037_500_000, None]
    df = spark.createDataFrame([(v,) for v in values], "u bigint").repartition(9)
    got = df.agg(*square_sums(F.col("u"))).select(square_sum().alias("q")).first()["q"]
    assert got == Decimal(sum(v * v for v in values if v is not None))


def test_stddev_is_the_same_however_rows_are_dealt(spark):
    """Readings for which doubles, merged in another order, change."""
    from fleetlens.plans.cpu import host_stats
    rng = random.Random(9)
    rows = [("h-D-1", "host", "Load", "cpuUtil", datetime(2026, 1, 1) + timedelta(minutes=i),
             1e9 + rng.random() * 1e-3) for i in range(600)]
    rows += [("h-D-2", "host", "Load", "cpuUtil", datetime(2026, 1, 1), 5.0)]
    t = tables_from_rows(spark, targets=[host("h-D-1"), host("h-D-2"), host("h-D-3")], hourly=rows)
    results = set()
    for n in (1, 3, 8, 17):
        dealt = MonitoringTables(t.targets, t.hourly.repartition(n), t.daily, t.current, t.tablespaces)
        got = host_stats(ReportRun(dealt, Params(as_of=datetime(2026, 1, 2)))).select("target_name", "stddev_cpu")
        results.add(tuple(sorted(map(tuple, got.collect()))))
    assert results == {(("h-D-1", 0.0), ("h-D-2", 0.0))}
