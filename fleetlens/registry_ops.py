"""Operator-level queries: each exercises one operator of the library on
the mapped tables, whole (no subsets), with its own DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import classify as C
from fleetlens.functions.dates import day_label, iso_week_end, minute_label, month_label, month_start
from fleetlens.functions.numbers import (as_double, finite, from_units, growth_pct, text_to_number,
                                         to_units, units_avg2)
from fleetlens.functions.text import number_fixed2, number_plain, short_hostname
from fleetlens.operators import aggregates as A
from fleetlens.operators import filters as FL
from fleetlens.operators import joins as J
from fleetlens.operators import windows as W
from fleetlens.params import DB_TARGET_TYPES, DISKGROUP_COLUMNS
from fleetlens.plans.context import ReportRun
from fleetlens.plans.cpu import host_stats, spike_rows
from fleetlens.plans.growth import db_size_monthly, with_previous_month
from fleetlens.plans.health import tablespace_summary, tablespace_usage
from fleetlens.registry import growth_params, run_for
from fleetlens.sources.testmap import SUBSET_LOOKBACK_DAYS


def _cpu_out(df: DataFrame, *extra) -> DataFrame:
    """Readings as printed: the exact value of ``cpu_units`` as DOUBLE."""
    return df.select("target_name", minute_label("rollup_timestamp").alias("ts_label"),
                     as_double(from_units("cpu_units")).alias("cpu_val"), *extra)


def _latest(run: ReportRun) -> DataFrame:
    return J.latest_left_join(run.hosts, W.latest_per_host(run.fleet_cpu_semi(run.p.snapshot_days)))


def _diskgroup_rows(run: ReportRun) -> DataFrame:
    return run.t.current.where((F.col("metric_name") == "DiskGroup_Usage")
                               & F.col("metric_column").isin(list(DISKGROUP_COLUMNS)))


def _cpu_current(run: ReportRun) -> DataFrame:
    return FL.metric_filter(run.t.current, "Load", "cpuUtil")


def _stats_all(run: ReportRun) -> DataFrame:
    return host_stats(run)


def _op(fn, growth: bool = False):
    def q(spark, sf_dir):
        return fn(run_for(spark, sf_dir, growth_params() if growth else None))
    return q


def fleet_filter(r):
    return FL.fleet_filter(r.t.targets, r.p.name_like).select(
        "target_name", F.col("type_qualifier1").alias("os_type"))


def metric_filter(r):
    h = FL.metric_filter(r.t.hourly, "Load", "cpuUtil", "host")
    return _cpu_out(h.withColumn("cpu_units", to_units("average")))


def lookback_filter(r):
    return _cpu_out(r.cpu_rows(SUBSET_LOOKBACK_DAYS))


def month_window_filter(r):
    d = FL.month_window_filter(r.t.daily, r.p.as_of, r.p.growth_months_back)
    return d.select("target_name", "metric_column", day_label("rollup_timestamp").alias("day"),
                    "maximum")


def threshold_filter(r):
    return _cpu_out(FL.threshold_filter(r.cpu_rows(r.p.lookback_days), "average", r.p.spike_threshold))


def type_in_filter(r):
    return FL.type_in_filter(r.t.targets, "target_type", DB_TARGET_TYPES).select(
        "target_name", "target_type", "type_qualifier1")


def positive_filter(r):
    return FL.positive_filter(r.t.daily, "maximum").select(
        "target_name", "metric_column", day_label("rollup_timestamp").alias("day"), "maximum")


def having_filter(r):
    return FL.having_filter(_diskgroup_rows(r), ["target_name", "key_value"], 1)


def distinct_hosts(r):
    return J.distinct_hosts(r.hosts)


def fleet_semi_join(r):
    return _cpu_out(J.fleet_semi_join(r.cpu_rows(r.p.lookback_days), r.hosts))


def fleet_inner_join(r):
    return _cpu_out(J.fleet_inner_join(r.cpu_rows(r.p.lookback_days), r.hosts),
                    "os_type")


def two_key_join(r):
    h = FL.metric_filter(r.t.hourly, "Load", "cpuUtil").select(
        "target_name", "target_type", "rollup_timestamp",
        to_units("average").alias("cpu_units"))
    t = r.t.targets.select("target_name", "target_type", F.col("type_qualifier1").alias("os_type"))
    return _cpu_out(J.two_key_join(h, t), "os_type")


def latest_left_join(r):
    return _latest(r).select("target_name", as_double(r.value()).alias("cpu_val"),
                             minute_label("rollup_timestamp").alias("ts_label"))


def self_join_hosts(r):
    return J.self_join_hosts(r.t.targets, DB_TARGET_TYPES, ("Linux",))


def instance_join(r):
    return J.instance_join(_diskgroup_rows(r), r.t.targets).select(
        "target_name", "key_value", "metric_column", "value", "instance_host")


def inventory_join(r):
    inv = J.self_join_hosts(r.t.targets, DB_TARGET_TYPES, r.p.os_list)
    return J.inventory_join(_cpu_current(r), inv.select("database_name", "server"),
                            "target_name").select("database_name", "server", "value")


def agg_global(r):
    g = A.agg_global(r.fleet_cpu_semi(r.p.lookback_days), r.spike(), r.p.value_scale)
    return g.select("total_hosts", as_double("avg_cpu").alias("avg_cpu"),
                    as_double("max_cpu").alias("max_cpu"), "spike_count", "hosts_with_spikes")


def agg_by_day(r):
    g = A.agg_by_day(spike_rows(r, r.fleet_cpu_semi(r.p.lookback_days)), r.p.value_scale)
    return g.select(day_label("day").alias("day"), "hosts_affected", "incident_count",
                    as_double("peak_cpu").alias("peak_cpu"))


def agg_by_iso_week(r):
    g = A.agg_by_iso_week(r.fleet_cpu_semi(r.p.lookback_days), r.spike(), r.p.value_scale)
    return g.select(day_label("week_end").alias("week_end"), as_double("avg_cpu").alias("avg_cpu"),
                    as_double("max_cpu").alias("max_cpu"), "spike_count")


def agg_host_stats(r):
    return _stats_all(r).select("target_name", "os_type", "avg_cpu", "min_cpu", "max_cpu",
                                "stddev_cpu", "incidents")


def agg_conditional_count(r):
    return (r.fleet_cpu_semi(r.p.lookback_days).groupBy("target_name")
            .agg(A.conditional_count(r.spike()).alias("incidents")))


def agg_conditional_distinct(r):
    return (r.fleet_cpu_semi(r.p.lookback_days)
            .groupBy(day_label(F.to_date("rollup_timestamp")).alias("day"))
            .agg(A.conditional_distinct(r.spike(), "target_name").alias("hosts_with_spikes")))


def agg_distinct_values(r):
    return _cpu_current(r).groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))


def pivot_max(r):
    p = A.pivot_max(_diskgroup_rows(r), ["target_name", "key_value"], "metric_column",
                    text_to_number("value"), DISKGROUP_COLUMNS)
    return p.select("target_name", "key_value",
                    *[as_double(c).alias(c) for c in DISKGROUP_COLUMNS])


def pivot_sum(r):
    m = db_size_monthly(r)
    return m.select("target_name", day_label("month_dt").alias("month_dt"),
                    as_double("used_gb").alias("used_gb"),
                    as_double("allocated_gb").alias("allocated_gb"))


def agg_monthly_avg(r):
    d = r.t.daily.where(F.col("metric_name") == "DATABASE_SIZE")
    d = FL.positive_filter(FL.month_window_filter(d, r.p.as_of, r.p.growth_months_back), "maximum")
    m = A.agg_monthly_avg(d, ("target_name",), r.p.value_scale)
    return m.select("target_name", day_label("month_dt").alias("month_dt"), "metric_column",
                    as_double("avg_value").alias("avg_value"))


def listagg_ordered(r):
    s = tablespace_summary(r.t.tablespaces, r.p.tablespace_warn)
    return s.select("target_name", "host_name", "critical_tablespaces",
                    as_double("max_used").alias("max_used"), "tablespace_list")


def latest_per_host(r):
    return _cpu_out(W.latest_per_host(r.fleet_cpu_semi(r.p.snapshot_days)))


def latest_per_host_rank(r):
    return _cpu_out(W.latest_by_rank(r.fleet_cpu_semi(r.p.snapshot_days)))


def rank_global(r):
    spikes = spike_rows(r, r.fleet_cpu_semi(r.p.events_days))
    order = [F.col("average").desc(), F.col("rollup_timestamp").desc(), F.col("target_name")]
    return _cpu_out(W.rank_global(spikes, order, r.p.events_k), "rn")


def lag_month(r):
    g = with_previous_month(db_size_monthly(r))
    return g.select("target_name", day_label("month_dt").alias("month_dt"),
                    *[as_double(c).alias(c) for c in
                      ("allocated_gb", "used_gb", "prev_allocated_gb", "prev_used_gb")])


def top_k(r):
    st = _stats_all(r)
    order = [F.col("max_cpu").desc_nulls_first(), F.col("avg_cpu").desc_nulls_first(),
             F.col("target_name")]
    return W.top_k(st, order, r.p.consumers_k).select("target_name", "os_type", "max_cpu", "avg_cpu")


def short_hostname_q(r):
    return r.t.targets.select("target_name", "target_type",
                              short_hostname("target_name").alias("hostname"))


def number_fixed2_q(r):
    u = F.col("cpu_units")
    st = r.fleet_cpu_semi(r.p.lookback_days).groupBy("target_name").agg(
        F.sum(u).alias("s"), F.count(u).alias("n"), F.min(u).alias("m"))
    return st.select("target_name", number_fixed2(units_avg2("s", "n")).alias("avg_text"),
                     number_fixed2(from_units("m")).alias("min_text"))


def number_plain_q(r):
    g = with_previous_month(db_size_monthly(r))
    return g.select("target_name", day_label("month_dt").alias("month_dt"),
                    number_plain(F.coalesce("allocated_gb", F.lit(0))).alias("allocated_text"),
                    number_plain(F.coalesce("used_gb", F.lit(0))).alias("used_text"),
                    number_plain(growth_pct("used_gb", "prev_used_gb")).alias("used_growth_text"))


def text_to_number_q(r):
    return r.t.current.select("target_name", "metric_column", "key_value",
                              as_double(text_to_number("value")).alias("value_num"))


def date_labels(r):
    c = r.fleet_cpu_semi(r.p.lookback_days)
    return c.select("target_name", day_label("rollup_timestamp").alias("day"),
                    minute_label("rollup_timestamp").alias("minute"),
                    month_label("rollup_timestamp").alias("month"))


def date_buckets(r):
    c = r.cpu_rows(r.p.lookback_days)
    return (c.groupBy(day_label(F.to_date("rollup_timestamp")).alias("day"),
                      day_label(iso_week_end("rollup_timestamp")).alias("week_end"),
                      day_label(month_start("rollup_timestamp")).alias("month_start"))
            .agg(F.count(F.lit(1)).alias("samples")))


def unit_conversion(r):
    u = tablespace_usage(r.t.tablespaces)
    return u.select("target_name", "tablespace_name",
                    *[as_double(c).alias(c) for c in ("used_mb", "total_mb", "free_mb", "used_percent")])


def null_default(r):
    return _latest(r).select(
        "target_name", as_double(F.coalesce(r.value(), F.lit(0))).alias("cpu_or_zero"),
        F.coalesce(minute_label("rollup_timestamp"), F.lit("N/A")).alias("last_measured"))


def classify_snapshot_colour(r):
    return _latest(r).select("target_name", C.snapshot_colour(finite("average")).alias("colour"))


def classify_snapshot_badge(r):
    return _latest(r).select("target_name", C.snapshot_badge(finite("average")).alias("status"))


def classify_peak_colour(r):
    return _stats_all(r).select("target_name", "max_cpu", "max_colour")


def classify_avg_colour(r):
    return _stats_all(r).select("target_name", "avg_cpu", "avg_colour")


def classify_incident_colour(r):
    return _stats_all(r).select("target_name", "incidents", "incident_colour")


def classify_action(r):
    return _stats_all(r).select("target_name", "incidents", "avg_cpu", "action")


def classify_asm(r):
    p = A.pivot_max(_diskgroup_rows(r), ["target_name", "key_value"], "metric_column",
                    F.round(text_to_number("value"), 0), ("percent_used",))
    return p.select("target_name", "key_value", C.asm_status("percent_used").alias("status"))


def classify_tablespace(r):
    s = tablespace_summary(r.t.tablespaces, r.p.tablespace_warn)
    return s.select("target_name", C.tablespace_status("max_used").alias("status"))


def classify_host_cpu(r):
    return _cpu_current(r).select("target_name", C.host_cpu_status(
        F.round(text_to_number("value"), 0)).alias("status"))


def growth_pct_q(r):
    g = with_previous_month(db_size_monthly(r))
    return g.select("target_name", day_label("month_dt").alias("month_dt"),
                    as_double(growth_pct("allocated_gb", "prev_allocated_gb")).alias("allocated_growth_pct"),
                    as_double(growth_pct("used_gb", "prev_used_gb")).alias("used_growth_pct"))


_GROWTH_KEYS = {"month_window_filter", "pivot_sum", "agg_monthly_avg", "lag_month",
                "number_plain", "growth_pct"}

_FUNCS = {
    "fleet_filter": fleet_filter, "metric_filter": metric_filter,
    "lookback_filter": lookback_filter, "month_window_filter": month_window_filter,
    "threshold_filter": threshold_filter, "type_in_filter": type_in_filter,
    "positive_filter": positive_filter, "having_filter": having_filter,
    "distinct_hosts": distinct_hosts, "fleet_semi_join": fleet_semi_join,
    "fleet_inner_join": fleet_inner_join, "two_key_join": two_key_join,
    "latest_left_join": latest_left_join, "self_join_hosts": self_join_hosts,
    "instance_join": instance_join, "inventory_join": inventory_join,
    "agg_global": agg_global, "agg_by_day": agg_by_day, "agg_by_iso_week": agg_by_iso_week,
    "agg_host_stats": agg_host_stats, "agg_conditional_count": agg_conditional_count,
    "agg_conditional_distinct": agg_conditional_distinct,
    "agg_distinct_values": agg_distinct_values, "pivot_max": pivot_max, "pivot_sum": pivot_sum,
    "agg_monthly_avg": agg_monthly_avg, "listagg_ordered": listagg_ordered,
    "latest_per_host": latest_per_host, "latest_per_host_rank": latest_per_host_rank,
    "rank_global": rank_global, "lag_month": lag_month,
    "top_k": top_k, "short_hostname": short_hostname_q, "number_fixed2": number_fixed2_q,
    "number_plain": number_plain_q, "text_to_number": text_to_number_q,
    "date_labels": date_labels, "date_buckets": date_buckets, "unit_conversion": unit_conversion,
    "null_default": null_default,
    "classify_snapshot_colour": classify_snapshot_colour,
    "classify_snapshot_badge": classify_snapshot_badge,
    "classify_peak_colour": classify_peak_colour, "classify_avg_colour": classify_avg_colour,
    "classify_incident_colour": classify_incident_colour, "classify_action": classify_action,
    "classify_asm": classify_asm, "classify_tablespace": classify_tablespace,
    "classify_host_cpu": classify_host_cpu, "growth_pct": growth_pct_q,
}

OPERATORS = {k: _op(f, k in _GROWTH_KEYS) for k, f in _FUNCS.items()}
