"""Edge rows (FIXTURES.md section D)."""

from datetime import datetime

import pytest

from fleetlens.params import Params
from fleetlens.plans import cpu, growth, health
from fleetlens.plans.patterns import cpu_recurring_pattern, cpu_rolling_7d
from fleetlens.plans.render import render_html_row
from tests.helpers import host, hr, rows, run_of

T = datetime(2026, 2, 28, 12)
H = "app-D-01.example.com"


def test_empty_kpis(spark):
    run = run_of(spark, targets=[host(H)])
    assert rows(cpu.cpu_dashboard_kpis(run)) == [dict(
        total_hosts=0, avg_cpu=None, max_cpu=None, spike_count=0, hosts_with_spikes=0)]


def test_host_without_sample(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, datetime(2026, 2, 20), 50.0)])
    r = rows(cpu.cpu_current_snapshot(run))[0]
    assert (r["cpu_pct"], r["status"], r["last_measured"], r["colour"]) == (0.0, "NORMAL", "N/A", "#212529")


def test_one_sample_stddev_zero(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 40.0)])
    assert rows(cpu.cpu_top_consumers_linux(run))[0]["stddev_cpu"] == 0.0


def test_latest_89_996_prints_90_warning(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 89.996)])
    r = rows(cpu.cpu_current_snapshot(run))[0]
    assert (r["cpu_pct"], r["status"], r["colour"]) == (90.0, "WARNING", "#fd7e14")


def test_average_49_995_optimize(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 49.99), hr(H, T.replace(hour=13), 50.0)])
    r = rows(cpu.cpu_top_consumers_linux(run))[0]
    assert (r["avg_cpu"], r["action"]) == (50.0, "OPTIMIZE")


@pytest.mark.parametrize("n,expected", [(4, "TRACK"), (5, "REVIEW"), (9, "REVIEW"), (10, "RCA REQUIRED")])
def test_incident_actions(spark, n, expected):
    hourly = [hr(H, datetime(2026, 2, 27, h), 99.0 if h < n else 1.0) for h in range(24)]
    run = run_of(spark, targets=[host(H)], hourly=hourly)
    assert rows(cpu.cpu_top_consumers_linux(run))[0]["action"] == expected


def test_97_995_not_a_spike(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 97.995)])
    k = rows(cpu.cpu_dashboard_kpis(run))[0]
    assert (k["spike_count"], k["max_cpu"]) == (0, 98.0)


def test_text_value_strict_and_tolerant(spark):
    targets = [("DB1", "oracle_database", "19", None, "h1"), host("h1", "AIX")]
    run = run_of(spark, targets=targets, current=[("h1", "Load", "cpuUtil", " ", "abc")])
    assert rows(health.host_cpu_current(run, strict=False))[0]["cpu_pct"] is None
    with pytest.raises(Exception):
        health.host_cpu_current(run, strict=True).collect()


def _ts_run(spark, used_bytes_list, size=10**12):
    targets = [("DB1", "oracle_database", "19", None, "h1"), host("h1", "Linux")]
    ts = [("DB1", "h1", f"TS{i}", "ONLINE", "PERMANENT", size if u is not None else 0, u or 0, None)
          for i, u in enumerate(used_bytes_list)]
    return run_of(spark, targets=targets, tablespaces=ts)


def test_tablespace_84_995_listed_warning(spark):
    run = _ts_run(spark, [849950000000])  # 84.995 % of 10**12 bytes
    r = rows(health.tablespace_attention(run))[0]
    assert (r["tablespace_list"], r["status"]) == ("TS0(85%)", "warning")


def test_tablespace_zero_size_dropped(spark):
    run = _ts_run(spark, [None, 10**11])
    r = rows(health.tablespace_attention(run))[0]
    assert r["critical_tablespaces"] == 0 and r["status"] == "ok"


def test_missing_month_compares_with_previous_row(spark):
    targets = [("DB1", "oracle_database", "19", None, "h1"), host("h1", "Linux")]
    daily = [("DB1", "oracle_database", "DATABASE_SIZE", "USED_GB", datetime(2026, 1, 3), 100.0),
             ("DB1", "oracle_database", "DATABASE_SIZE", "USED_GB", datetime(2026, 3, 3), 110.0)]
    run = run_of(spark, Params(as_of=datetime(2026, 3, 10)), targets=targets, daily=daily)
    got = {r["month_label"]: r for r in rows(growth.db_growth_monthly(run))}
    assert got["MAR-2026"]["used_growth_pct"] == 10.0
    assert got["JAN-2026"]["used_growth_pct"] == 0.0
    assert got["MAR-2026"]["allocated_gb"] == 0.0  # absent -> 0


def test_short_names(spark):
    from fleetlens.functions.text import short_hostname
    df = spark.createDataFrame([("HOSTA-D-1",), (".x",), ("Ab.c.d",)], "n string")
    assert [r[0] for r in df.select(short_hostname("n")).collect()] == ["hosta-d-1", None, "ab"]


def test_os_null_kept_and_empty_cell(spark):
    run = run_of(spark, targets=[(H, "host", None, None, H)], hourly=[hr(H, T, 10.0)])
    out = rows(render_html_row(cpu.cpu_current_snapshot(run), "cpu_current_snapshot"))
    assert len(out) == 1 and "<td></td>" in out[0]["html_row"]


def test_os_upper_case_matching(spark):
    targets = [(H, "host", "LINUX", "v", H), ("DB1", "oracle_database", "19", None, H)]
    run = run_of(spark, targets=targets, hourly=[hr(H, T, 10.0)])
    assert len(rows(cpu.cpu_top_consumers_linux(run))) == 1
    assert rows(health.db_host_inventory(run, ("Linux",))) == []


def test_two_databases_repeat_cpu_row(spark):
    targets = [host("h1", "Linux"), ("DB1", "oracle_database", "19", None, "h1"),
               ("DB2", "oracle_pdb", "19", None, "h1")]
    run = run_of(spark, targets=targets, current=[("h1", "Load", "cpuUtil", " ", "12.5")])
    got = sorted(r["database_name"] for r in rows(health.host_cpu_current(run)))
    assert got == ["DB1", "DB2"]


def test_diskgroup_total_only(spark):
    targets = [host("h1", "Linux"), ("DB1", "oracle_database", "19", None, "h1"),
               ("+ASM_1", "osm_instance", None, None, "h1")]
    run = run_of(spark, targets=targets, current=[("+ASM_1", "DiskGroup_Usage", "total_mb", "DATA", "2048")])
    r = rows(health.asm_diskgroup_usage(run))[0]
    assert (r["used_pct"], r["status"], r["total_gb"]) == (None, "normal", 2.0)


def test_distractor_metric_filtered(spark):
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 99.5, "memUsedPct"), hr(H, T, 10.0)])
    k = rows(cpu.cpu_dashboard_kpis(run))[0]
    assert (k["spike_count"], k["max_cpu"]) == (0, 10.0)


def test_recurring_pattern(spark):
    hourly = [hr(H, datetime(2026, 2, d, 3), 99.0) for d in (20, 21, 22)]
    hourly += [hr(H, datetime(2026, 2, 23, 5), 99.0)]
    run = run_of(spark, targets=[host(H)], hourly=hourly)
    got = sorted((r["event_ts"], r["pattern_hint"]) for r in rows(cpu_recurring_pattern(run)))
    assert got == [("2026-02-20 03:00", "Recurring batch @ 03:00"),
                   ("2026-02-21 03:00", "Recurring batch @ 03:00"),
                   ("2026-02-22 03:00", "Recurring batch @ 03:00"),
                   ("2026-02-23 05:00", "Isolated")]


def test_recurring_pattern_copies_count_days_once(spark):
    """Copies of a host's readings repeat the spike rows but count each
    day once, so the hint does not change."""
    hourly = [hr(H, datetime(2026, 2, d, 3), 99.0) for d in (20, 21)]
    hourly += [hr(H, datetime(2026, 2, 23, 5), 99.0)]
    run = run_of(spark, targets=[host(H)], hourly=hourly * 4)
    got = rows(cpu_recurring_pattern(run))
    assert len(got) == 12
    assert {(r["spike_hour"], r["days_at_hour"]) for r in got} == {(3, 2), (5, 1)}


def test_rolling_7d(spark):
    hourly = [hr(H, datetime(2026, 2, d, 1), float(d)) for d in range(10, 20)]
    run = run_of(spark, targets=[host(H)], hourly=hourly)
    got = {r["day"]: r for r in rows(cpu_rolling_7d(run))}
    assert got["2026-02-16"]["rolling_avg_cpu"] == 13.0  # days 10..16
    assert got["2026-02-19"]["rolling_avg_cpu"] == 16.0  # days 13..19
    assert got["2026-02-10"]["days_in_window"] == 1


def test_snapshot_order_raw_value_then_name(spark):
    hosts = ["b-D-1.x", "a-D-2.x", "c-D-3.x", "d-D-4.x"]
    hourly = [hr("b-D-1.x", T, 89.996), hr("a-D-2.x", T, 90.004), hr("d-D-4.x", T, 0.0)]
    run = run_of(spark, targets=[host(h) for h in hosts], hourly=hourly)
    got = [r["hostname"] for r in rows(cpu.cpu_current_snapshot(run))]
    assert got == ["a-d-2", "b-d-1", "c-d-3", "d-d-4"]


def test_desc_sort_puts_null_average_first(spark):
    """A host whose readings are all NULL has a NULL peak; a descending sort
    in the repository puts it first (M5)."""
    hourly = [hr("a-D-1.x", T, None), hr("b-D-2.x", T, 99.0), hr("c-D-3.x", T, 50.0)]
    run = run_of(spark, targets=[host(h) for h in ("a-D-1.x", "b-D-2.x", "c-D-3.x")], hourly=hourly)
    got = [r["hostname"] for r in rows(cpu.cpu_top_consumers_linux(run))]
    assert got == ["a-d-1", "b-d-2", "c-d-3"]


def test_weekly_colour_uses_rounded_peak(spark):
    """89.996 rounds to 90.00, so the weekly peak is red (M11), while the
    snapshot tests the raw value and stays orange (M10)."""
    run = run_of(spark, targets=[host(H)], hourly=[hr(H, T, 89.996)])
    assert rows(cpu.cpu_weekly_trend(run))[0]["colour"] == "#dc3545"
    assert rows(cpu.cpu_current_snapshot(run))[0]["colour"] == "#fd7e14"


def test_total_hosts_counts_hosts_with_samples(spark):
    """Hosts of the fleet without samples in the window are not counted
    (M17); the snapshot still lists them."""
    run = run_of(spark, targets=[host(H), host("idle-D-9.x")], hourly=[hr(H, T, 10.0)])
    assert rows(cpu.cpu_dashboard_kpis(run))[0]["total_hosts"] == 1
    assert len(rows(cpu.cpu_current_snapshot(run))) == 2


def test_non_finite_reading_is_missing(spark):
    hourly = [hr(H, T, float("nan")), hr(H, T.replace(hour=13), 40.0),
              hr(H, T.replace(hour=14), float("inf"))]
    run = run_of(spark, targets=[host(H)], hourly=hourly)
    k = rows(cpu.cpu_dashboard_kpis(run))[0]
    assert (k["total_hosts"], k["avg_cpu"], k["max_cpu"]) == (1, 40.0, 40.0)


def test_window_ignores_session_time_zone(spark):
    """The window edge is as_of minus N days in wall-clock terms, whatever
    the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        edge = datetime(2026, 2, 27, 0, 0)  # AS_OF (2026-03-01) minus 2 days
        run = run_of(spark, targets=[host(H)], hourly=[hr(H, edge, 55.0)])
        r = rows(cpu.cpu_current_snapshot(run))[0]
        assert (r["cpu_pct"], r["last_measured"]) == (55.0, "2026-02-27 00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_minute_label_inside_dst_gap(spark):
    from fleetlens.functions.dates import minute_label
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(datetime(2026, 3, 8, 2, 30),)], "t timestamp_ntz")
        assert df.select(minute_label("t")).collect()[0][0] == "2026-03-08 02:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
