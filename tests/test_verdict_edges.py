"""Tests on stored readings, closed windows, persisted runs, wide sums."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import aggregates as A
from fleetlens.params import Params
from fleetlens.plans import cpu, growth, health, patterns
from fleetlens.plans.report import cpu_report
from tests.helpers import AS_OF, host, hr, rows, run_of

H = "app-D-01.example.com"
T = datetime(2026, 2, 28, 12)


def test_a_reading_just_below_the_threshold_is_no_spike(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 97.9999996)])
    assert rows(cpu.cpu_dashboard_kpis(run))[0]["spike_count"] == 0
    assert rows(cpu.cpu_spike_days(run)) == [] and rows(cpu.cpu_top_spike_events(run)) == []
    assert rows(cpu.cpu_weekly_trend(run))[0]["spike_count"] == 0
    assert rows(cpu.cpu_top_consumers_linux(run))[0]["incidents"] == 0


def test_a_reading_just_below_a_class_stays_below(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 89.9999996)])
    r = rows(cpu.cpu_current_snapshot(run))[0]
    assert (r["status"], r["status4"], r["cpu_pct"]) == ("WARNING", "WARNING", 90.0)


def test_non_finite_readings_are_no_spikes(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, float("nan")), hr(H, T.replace(hour=13), float("inf"))])
    assert rows(cpu.cpu_spike_days(run)) == []
    r = rows(cpu.cpu_current_snapshot(run))[0]
    assert (r["cpu_pct"], r["status"]) == (0.0, "NORMAL")


def test_a_finite_reading_beyond_the_unit_range_fails(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 1e20)])
    with pytest.raises(Exception):
        rows(cpu.cpu_dashboard_kpis(run))


def test_same_rows_with_and_without_persist(spark):
    """A host listed twice under two OS values."""
    targets = [host(H, "Linux"), host(H, "AIX"), host("b-D-2.x", "Linux")]
    hourly = [hr(H, T.replace(hour=h), 90.0 + h) for h in range(12)] + [hr("b-D-2.x", T, 99.5)]
    from fleetlens.plans.context import ReportRun
    plain = run_of(spark, targets=targets, hourly=hourly)
    kept = ReportRun(plain.t, plain.p, persist=True)
    for (name, a), b in zip(cpu_report(plain).items(), cpu_report(kept).values()):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name
    kept.unpersist()
    assert rows(cpu.cpu_dashboard_kpis(plain))[0]["spike_count"] == 5


def test_windows_end_at_as_of(spark):
    later = datetime(2026, 3, 28, 12)
    hourly = [hr(H, T, 50.0), hr(H, AS_OF, 60.0), hr(H, later, 99.0)]
    run = run_of(spark, targets=[host(H)], hourly=hourly)
    assert rows(cpu.cpu_dashboard_kpis(run))[0] == dict(
        total_hosts=1, avg_cpu=55.0, max_cpu=60.0, spike_count=0, hosts_with_spikes=0)
    assert rows(cpu.cpu_current_snapshot(run))[0]["last_measured"] == "2026-03-01 00:00"
    for report in (cpu.cpu_spike_days, cpu.cpu_top_spike_events, patterns.cpu_recurring_pattern):
        assert rows(report(run)) == []
    assert [r["day"] for r in rows(patterns.cpu_rolling_7d(run))] == ["2026-02-28", "2026-03-01"]
    assert rows(cpu.cpu_top_consumers_linux(run))[0]["max_cpu"] == 60.0


def test_growth_ends_at_as_of_and_is_ordered(spark):
    targets = [host("h1"), ("DB2", "oracle_database", "19", None, "h1"), ("DB1", "oracle_pdb", "19", None, "h1")]
    daily = [(d, t, "DATABASE_SIZE", "USED_GB", datetime(2026, m, 5), 10.0 * m)
             for d, t in (("DB2", "oracle_database"), ("DB1", "oracle_pdb")) for m in (4, 1, 3, 2)]
    run = run_of(spark, Params(as_of=datetime(2026, 3, 10)), targets=targets, daily=daily)
    got = [(r["target_name"], r["month_label"]) for r in rows(growth.db_growth_monthly(run))]
    assert got == [(d, m) for d in ("DB1", "DB2") for m in ("JAN-2026", "FEB-2026", "MAR-2026")]


def test_a_bad_text_outside_the_inventory_does_not_fail(spark):
    targets = [host("h1"), ("DB1", "oracle_database", "19", None, "h1"),
               ("+ASM_1", "osm_instance", None, None, "h1"), ("+ASM_9", "osm_instance", None, None, "h9")]
    current = [("+ASM_1", "DiskGroup_Usage", "percent_used", "DATA", "91.5"),
               ("+ASM_9", "DiskGroup_Usage", "percent_used", "DATA", "not a number"),
               ("h9", "Load", "cpuUtil", " ", "not a number"), ("h1", "Load", "cpuUtil", " ", "12")]
    run = run_of(spark, targets=targets, current=current)
    assert [(r["used_pct"], r["status"]) for r in rows(health.asm_diskgroup_usage(run))] == [(91.5, "critical")]
    assert [r["cpu_pct"] for r in rows(health.host_cpu_current(run))] == [12.0]


def test_not_applicable_row_without_databases(spark):
    run = run_of(spark, targets=[host("h1")])
    assert rows(health.asm_not_applicable(run)) == [dict(os="AIX", status="Not Applicable for AIX Servers")]


def test_sums_beyond_the_long_range(spark):
    """Two hosts whose unit sums fit a BIGINT each but not together."""
    big = 6 * 10 ** 18
    cpu_rows = spark.createDataFrame([("a", T, 1.0, big), ("b", T, 99.0, big)],
                                     "target_name string, rollup_timestamp timestamp_ntz, average double, cpu_units long")
    spike = F.col("average") >= 98
    assert str(A.agg_global(cpu_rows, spike).first()["avg_cpu"]) == "6000000000000.00"
    assert str(A.agg_by_iso_week(cpu_rows, spike).first()["avg_cpu"]) == "6000000000000.00"
    assert int(A.fold_hosts(cpu_rows, F.to_date("rollup_timestamp"), spike).first()["s"]) == 2 * big
