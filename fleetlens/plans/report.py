"""Whole reports: every section of the CPU report, every section of the
health report, as a dict of DataFrames ready for a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetlens.plans import cpu, growth, health
from fleetlens.plans.context import ReportRun
from fleetlens.plans.render import render_html_row


def cpu_report(run: ReportRun, html: bool = False) -> dict[str, DataFrame]:
    """The seven CPU sections.  Build ``run`` with ``persist=True`` to read
    the hourly facts once for all seven."""
    sections = {
        "cpu_dashboard_kpis": cpu.cpu_dashboard_kpis(run),
        "cpu_current_snapshot": cpu.cpu_current_snapshot(run),
        "cpu_spike_days": cpu.cpu_spike_days(run),
        "cpu_weekly_trend": cpu.cpu_weekly_trend(run),
        "cpu_top_spike_events": cpu.cpu_top_spike_events(run),
        "cpu_top_consumers_linux": cpu.cpu_top_consumers_linux(run),
        "cpu_top_consumers_aix": cpu.cpu_top_consumers_aix(run),
    }
    if html:
        sections = {k: render_html_row(v, k, run.p) for k, v in sections.items()}
    return sections


def health_report(run: ReportRun, html: bool = False) -> dict[str, DataFrame]:
    """The health sections for every OS of ``run.p.os_list`` at once: one job
    per section, rows carry ``os`` and come in the order of OS and database,
    so that a sink split by ``os`` holds one report per OS.  Disk groups for
    Linux, the fixed row for AIX."""
    os_list = tuple(run.p.os_list)
    no_asm = tuple(o for o in os_list if o == "AIX")
    with_asm = tuple(o for o in os_list if o != "AIX")
    sections = {
        "db_host_inventory": health.db_host_inventory_sorted(run, os_list),
        "asm_diskgroup_usage": health.asm_diskgroup_usage(run, with_asm),
        "asm_not_applicable": health.asm_not_applicable(run, no_asm),
        "tablespace_attention": health.tablespace_attention(run, os_list),
        "host_cpu_current": health.host_cpu_current(run, os_list),
        "db_growth_monthly": growth.db_growth_monthly(run, os_list),
    }
    if html:
        sections = {k: (render_html_row(v, k, run.p) if k != "db_host_inventory" else v)
                    for k, v in sections.items()}
    return sections


def register_views(run: ReportRun, prefix: str = "") -> list[str]:
    """Register the five relations and every report of ``run`` as temporary
    views, so they can be queried with ``spark.sql``.  Views are lazy: a
    report runs only when a statement reads it."""
    from fleetlens.plans import patterns

    t = run.t
    views = {"mon_target": t.targets, "mon_metric_hourly": t.hourly, "mon_metric_daily": t.daily,
             "mon_metric_current": t.current, "mon_db_tablespaces": t.tablespaces}
    views.update(cpu_report(run))
    views.update(health_report(run))
    views.update({"cpu_recurring_pattern": patterns.cpu_recurring_pattern(run),
                  "cpu_rolling_7d": patterns.cpu_rolling_7d(run),
                  "cpu_elevated_hosts": patterns.cpu_elevated_hosts(run)})
    names = []
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
