"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
report and per operator, all over the driver's tables mapped by
:mod:`fleetlens.sources.testmap`."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.params import Params
from fleetlens.plans import cpu, growth, health, patterns
from fleetlens.plans.context import ReportRun
from fleetlens.plans.rollups import DayStore, RollupRun
from fleetlens.session import ensure_checkpoint_dir
from fleetlens.sources import testmap
from fleetlens.sources.buckets import BucketedRun, write_buckets

Query = Callable[[SparkSession, str], DataFrame]


def cpu_params() -> Params:
    return Params(as_of=testmap.CPU_AS_OF)


def growth_params() -> Params:
    return Params(as_of=testmap.GROWTH_AS_OF)


def ranges(spark: SparkSession) -> int:
    """Tasks that order a section: as many as any shuffle has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def run_for(spark: SparkSession, sf_dir: str, params: Params | None = None,
            persist: bool = False) -> ReportRun:
    return ReportRun(testmap.load(spark, sf_dir), params or cpu_params(), persist=persist, ranges=ranges(spark))


def _cpu(fn) -> Query:
    return lambda spark, sf_dir: fn(run_for(spark, sf_dir))


def _growth(fn) -> Query:
    return lambda spark, sf_dir: fn(run_for(spark, sf_dir, growth_params()))


# report name -> (plan function of a ReportRun, uses the growth parameters)
REPORT_PLANS = {
    "cpu_dashboard_kpis": (cpu.cpu_dashboard_kpis, False),
    "cpu_current_snapshot": (cpu.cpu_current_snapshot, False),
    "cpu_spike_days": (cpu.cpu_spike_days, False),
    "cpu_weekly_trend": (cpu.cpu_weekly_trend, False),
    "cpu_top_spike_events": (cpu.cpu_top_spike_events, False),
    "cpu_top_consumers_linux": (cpu.cpu_top_consumers_linux, False),
    "cpu_top_consumers_aix": (cpu.cpu_top_consumers_aix, False),
    "db_host_inventory": (health.db_host_inventory_sorted, False),
    "asm_diskgroup_usage": (health.asm_diskgroup_usage, False),
    "asm_not_applicable": (health.asm_not_applicable, False),
    "tablespace_attention": (health.tablespace_attention, False),
    "host_cpu_current": (health.host_cpu_current, False),
    "db_growth_monthly": (growth.db_growth_monthly, True),
    "cpu_recurring_pattern": (patterns.cpu_recurring_pattern, False),
    "cpu_spike_batches": (patterns.cpu_spike_batches, False),
    "cpu_rolling_7d": (patterns.cpu_rolling_7d, False),
    "cpu_elevated_hosts": (patterns.cpu_elevated_hosts, False),
}

REPORTS: dict[str, Query] = {k: (_growth(f) if g else _cpu(f)) for k, (f, g) in REPORT_PLANS.items()}


# the sections that a stored table of day partials serves
ROLLUP_KEYS = ("cpu_dashboard_kpis", "cpu_current_snapshot", "cpu_spike_days", "cpu_weekly_trend",
               "cpu_top_spike_events", "cpu_top_consumers_linux", "cpu_top_consumers_aix", "cpu_rolling_7d",
               "cpu_spike_batches")


def stored_run(spark: SparkSession, sf_dir: str) -> RollupRun:
    """A run over day partials of the driver's tables, stored in two steps in
    the cluster's shared folder."""
    tables, params = testmap.load(spark, sf_dir), cpu_params()
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-rollup-{uuid.uuid4().hex[:12]}"
    store, end = DayStore(spark, root, params), params.as_of.date()
    store.extend(tables, end - timedelta(days=3), first=end - timedelta(days=params.lookback_days + 3))
    store.extend(tables, end - timedelta(days=1))
    return RollupRun(tables, store, params)


def _stored(key: str) -> Query:
    return lambda spark, sf_dir: REPORT_PLANS[key][0](stored_run(spark, sf_dir))


# the sections that the relations in buckets serve
BUCKETED_KEYS = ("db_host_inventory", "asm_diskgroup_usage", "tablespace_attention", "host_cpu_current",
                 "db_growth_monthly")


def _bucketed(key: str) -> Query:
    fn, is_growth = REPORT_PLANS[key]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = testmap.load(spark, sf_dir)
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-buckets-{uuid.uuid4().hex[:12]}"
        write_buckets(tables, root, int(spark.conf.get("spark.sql.shuffle.partitions")))
        params = growth_params() if is_growth else cpu_params()
        return fn(BucketedRun(spark, root, tables.hourly, params, ranges=ranges(spark)))
    return q


def queries() -> dict[str, Query]:
    out = dict(REPORTS)
    out.update({f"bucketed_{k}": _bucketed(k) for k in BUCKETED_KEYS})
    out.update({f"rollup_{k}": _stored(k) for k in ROLLUP_KEYS})
    from fleetlens.registry_ops import OPERATORS
    out.update(OPERATORS)
    out.update(html_queries())
    return out


def _html(key: str) -> Query:
    from fleetlens.plans.render import render_html_row

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        params = growth_params() if key == "db_growth_monthly" else cpu_params()
        return render_html_row(REPORTS[key](spark, sf_dir), key, params).select("html_row")
    return q


HTML_KEYS = ("cpu_dashboard_kpis", "cpu_current_snapshot", "cpu_spike_days", "cpu_weekly_trend",
             "cpu_top_spike_events", "cpu_top_consumers_linux", "cpu_top_consumers_aix",
             "asm_diskgroup_usage", "asm_not_applicable", "tablespace_attention",
             "host_cpu_current", "db_growth_monthly")


def html_queries() -> dict[str, Query]:
    out = {f"html_{k}": _html(k) for k in HTML_KEYS}
    out["render_html_row"] = _all_rows
    return out


def _all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered rows of all sections, with the section's name."""
    parts = [_html(k)(spark, sf_dir).select(F.lit(k).alias("section"), "html_row") for k in HTML_KEYS]
    return reduce(DataFrame.unionByName, parts)
