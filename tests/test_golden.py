"""Golden rows taken from the two sample reports (FIXTURES.md section B)."""

from datetime import datetime
from decimal import Decimal

import pytest

from fleetlens.functions.numbers import growth_pct
from fleetlens.functions.text import number_fixed2, number_plain
from fleetlens.params import Params
from fleetlens.plans import cpu, growth, health
from fleetlens.plans.render import render_html_row
from tests.helpers import host, hr, rows, run_of

# The expected rows of the sample reports.
GROWTH = [  # previous, current, expected text
    ("677.46", "684.99", "1.11"), ("356.09", "365.24", "2.57"), ("1522.48", "1549.53", "1.78"),
    ("900.09", "927.6", "3.06"), ("57.08", "58.22", "2"), ("4.86", "4.87", "0"),
    ("7.31", "7.32", "0"), ("73.24", "73.27", ".04"), ("69.7", "69.8", ".14"),
    ("13.25", "13.24", "0"), ("13.21", "13.23", ".15"), ("139.63", "156.14", "11.82"),
    ("573", "575.7", ".47"), (None, "2028.07", "0"),
]


def test_growth_golden(spark):
    df = spark.createDataFrame([(Decimal(p) if p else None, Decimal(c)) for p, c, _ in GROWTH],
                               "prev decimal(18,2), cur decimal(18,2)")
    got = [r[0] for r in df.select(number_plain(growth_pct("cur", "prev"))).collect()]
    assert got == [e for _, _, e in GROWTH]


def test_number_texts(spark):
    df = spark.createDataFrame([(0.63, 0.96), (2.0, 100.0), (14.1, 5.9)], "a double, b double")
    got = [(r[0], r[1]) for r in df.select(number_plain("a"), number_fixed2("b")).collect()]
    assert got == [(".63", "0.96"), ("2", "100.00"), ("14.1", "5.90")]


def test_tablespace_list_golden(spark):
    gb = 1024 * 1024 * 1024
    ts = [("DB003", "aix-host-03.example.com", "TS132", "ONLINE", "PERMANENT", 100 * gb, 8540 * gb // 100, None),
          ("DB003", "aix-host-03.example.com", "TS065", "ONLINE", "PERMANENT", 10000 * gb, 9187 * gb, None),
          ("DB003", "aix-host-03.example.com", "TS001", "ONLINE", "PERMANENT", 100 * gb, 10 * gb, None),
          ("DB050", "aix-host-01.example.com", "TS001", "ONLINE", "PERMANENT", 100 * gb, 10 * gb, None)]
    targets = [("DB003", "oracle_database", "19.0", None, "aix-host-03.example.com"),
               ("DB050", "oracle_database", "19.0", None, "aix-host-01.example.com"),
               host("aix-host-03.example.com", "AIX"), host("aix-host-01.example.com", "AIX")]
    run = run_of(spark, targets=targets, tablespaces=ts)
    out = render_html_row(health.tablespace_attention(run, ("AIX",)), "tablespace_attention")
    got = sorted(r["html_row"] for r in rows(out))
    assert got == [
        '<tr class="critical"><td>DB003</td><td>aix-host-03.example.com</td>'
        '<td>TS065(91.87%), TS132(85.4%)</td></tr>',
        '<tr class="ok"><td>DB050</td><td>aix-host-01.example.com</td>'
        '<td>No tablespace used 85% above</td></tr>']


def test_consumer_row_golden(spark):
    """incidents 9, avg 9.34, max 100.00 -> REVIEW, as in the CPU sample."""
    df = spark.createDataFrame(
        [("oem-host-12.example.com", "oem-host-12", "Linux", 9.34, 6.37, 100.0, 13.77, 9,
          "REVIEW", "#212529", "#dc3545", "#dc3545")],
        "target_name string, hostname string, os_type string, avg_cpu double, min_cpu double, "
        "max_cpu double, stddev_cpu double, incidents bigint, action string, avg_colour string, "
        "max_colour string, incident_colour string")
    html = render_html_row(df, "cpu_top_consumers_linux").collect()[0]["html_row"]
    assert html == (
        '<tr><td><strong>oem-host-12</strong></td><td style="text-align:center;font-weight:bold;'
        'color:#212529;">9.34%</td><td style="text-align:center;">6.37%</td><td style="text-align:'
        'center;font-weight:bold;color:#dc3545;">100.00%</td><td style="text-align:center;color:'
        '#6c757d;">13.77</td><td style="text-align:center;font-weight:bold;color:#dc3545;">9</td>'
        '<td><span class="badge badge-warning">REVIEW</span></td></tr>')


def test_consumer_classes_from_hours(spark):
    """Nine spike hours and a low average give REVIEW with a red peak;
    no incidents and avg 10.38 give TRACK."""
    t0 = datetime(2026, 2, 20)
    hourly = [hr("app-D-01.example.com", t0.replace(hour=h), 100.0 if h < 9 else 0.5) for h in range(24)]
    hourly += [hr("app-D-02.example.com", t0.replace(hour=h), 10.38) for h in range(24)]
    run = run_of(spark, targets=[host("app-D-01.example.com"), host("app-D-02.example.com")],
                 hourly=hourly)
    got = {r["hostname"]: r for r in rows(cpu.cpu_top_consumers_linux(run))}
    assert got["app-d-01"]["action"] == "REVIEW" and got["app-d-01"]["max_colour"] == "#dc3545"
    assert got["app-d-01"]["incidents"] == 9
    assert got["app-d-02"]["action"] == "TRACK" and got["app-d-02"]["avg_cpu"] == 10.38


def test_snapshot_row_golden(spark):
    run = run_of(spark, targets=[host("OEM-D-HOST-20.example.com")],
                 hourly=[hr("OEM-D-HOST-20.example.com", datetime(2026, 2, 28, 23), 36.30),
                         hr("OEM-D-HOST-20.example.com", datetime(2026, 2, 28, 22), 99.0)])
    html = rows(render_html_row(cpu.cpu_current_snapshot(run), "cpu_current_snapshot"))[0]["html_row"]
    assert html == ('<tr><td><strong>oem-d-host-20</strong></td><td>Linux</td><td style="text-align:'
                    'center;font-weight:bold;color:#212529;">36.30%</td><td><span class="badge '
                    'badge-secondary">NORMAL</span></td><td>2026-02-28 23:00</td></tr>')


def test_week_labels_partial_weeks(spark):
    """A 30-day window from 2026-01-30 11:29 gives five ISO weeks, the first
    labelled 2026-02-01 (partial) and the last 2026-03-01."""
    as_of = datetime(2026, 3, 1, 11, 29)
    hourly = [hr("app-D-01.example.com", datetime(2026, 1, 30, 12), 10.0),
              hr("app-D-01.example.com", datetime(2026, 1, 29, 12), 10.0),  # outside
              hr("app-D-01.example.com", datetime(2026, 2, 23, 0), 95.0),
              hr("app-D-01.example.com", datetime(2026, 2, 28, 23), 20.0)]
    for d in (3, 10, 17):
        hourly.append(hr("app-D-01.example.com", datetime(2026, 2, d, 5), 30.0))
    run = run_of(spark, Params(as_of=as_of), targets=[host("app-D-01.example.com")], hourly=hourly)
    got = [r["week_end"] for r in rows(cpu.cpu_weekly_trend(run))]
    assert got == ["2026-03-01", "2026-02-22", "2026-02-15", "2026-02-08", "2026-02-01"]


def test_growth_report_month_labels(spark):
    targets = [("DB008", "oracle_database", "19.0", None, "aix-host-13.example.com"),
               host("aix-host-13.example.com", "AIX")]
    daily = []
    for day, used, alloc in ((datetime(2026, 1, 5), 356.09, 677.46), (datetime(2026, 2, 5), 365.24, 684.99)):
        daily.append(("DB008", "oracle_database", "DATABASE_SIZE", "USED_GB", day, used))
        daily.append(("DB008", "oracle_database", "DATABASE_SIZE", "ALLOCATED_GB", day, alloc))
    run = run_of(spark, Params(as_of=datetime(2026, 2, 20)), targets=targets, daily=daily)
    out = render_html_row(growth.db_growth_monthly(run), "db_growth_monthly")
    got = [r["html_row"] for r in out.orderBy("month_dt").collect()]
    assert got == [
        "<tr><td>DB008</td><td>aix-host-13.example.com</td><td>JAN-2026</td><td>677.46</td>"
        "<td>356.09</td><td>0%</td><td>0%</td></tr>",
        "<tr><td>DB008</td><td>aix-host-13.example.com</td><td>FEB-2026</td><td>684.99</td>"
        "<td>365.24</td><td>1.11%</td><td>2.57%</td></tr>"]


def test_kpi_cards_golden(spark):
    df = spark.createDataFrame([(31, 5.02, 100.0, 9, 1)],
                               "total_hosts bigint, avg_cpu double, max_cpu double, "
                               "spike_count bigint, hosts_with_spikes bigint")
    html = render_html_row(df, "cpu_dashboard_kpis").collect()[0]["html_row"]
    assert html.startswith('<div class="metric-card"><div class="metric-value">31</div>'
                           '<div class="metric-label">Total Hosts Monitored</div></div>')
    assert '<div class="metric-value">5.02%</div><div class="metric-label">Average CPU (30d)' in html
    assert '<div class="metric-value">100.00%</div>' in html
    assert "Spike Events ≥98%" in html


@pytest.mark.parametrize("value,status", [("1.58", "low"), ("79.5", "warning"), ("89.5", "critical")])
def test_host_cpu_rounding(spark, value, status):
    targets = [("DB1", "oracle_database", "19", None, "h1"), host("h1", "AIX")]
    run = run_of(spark, targets=targets, current=[("h1", "Load", "cpuUtil", " ", value)])
    got = rows(health.host_cpu_current(run))
    assert got[0]["status"] == status


def _render(spark, key, ddl, row):
    return render_html_row(spark.createDataFrame([row], ddl), key).collect()[0]["html_row"]


def test_spike_day_row_golden(spark):
    html = _render(spark, "cpu_spike_days",
                   "spike_day string, hosts_affected bigint, incident_count bigint, peak_cpu double",
                   ("2026-02-11", 1, 8, 100.0))
    assert html == ('<tr><td>2026-02-11</td><td style="text-align:center;">1</td><td style="text-align:'
                    'center;font-weight:bold;color:#dc3545;">8</td><td style="text-align:center;'
                    'font-weight:bold;color:#dc3545;">100.00%</td></tr>')


def test_weekly_row_golden(spark):
    html = _render(spark, "cpu_weekly_trend",
                   "week_end string, avg_cpu double, max_cpu double, spike_count bigint, colour string",
                   ("2026-02-15", 4.99, 100.0, 9, "#dc3545"))
    assert html == ('<tr><td>2026-02-15</td><td style="text-align:center;">4.99%</td><td style="text-'
                    'align:center;font-weight:bold;color:#dc3545;">100.00%</td><td style="text-align:'
                    'center;">9</td></tr>')


def test_spike_event_row_golden(spark):
    html = _render(spark, "cpu_top_spike_events",
                   "hostname string, os_type string, event_ts string, cpu_pct double",
                   ("oem-host-12", "Linux", "2026-02-11 19:00", 100.0))
    assert html == ('<tr><td><strong>oem-host-12</strong></td><td>Linux</td><td>2026-02-11 19:00</td>'
                    '<td style="text-align:center;font-weight:bold;color:#dc3545;">100.00%</td>'
                    '<td><em>Check for recurring HH:MI pattern</em></td></tr>')


@pytest.mark.parametrize("pct,text", [(1.7, "1.7%"), (14.1, "14.1%"), (1.58, "1.58%")])
def test_host_cpu_row_golden(spark, pct, text):
    html = _render(spark, "host_cpu_current", "server string, cpu_pct double, status string",
                   ("aix-host-07.example.com", pct, "low"))
    assert html == f'<tr class="low"><td>aix-host-07.example.com</td><td>{text}</td></tr>'
