"""The CPU reports: dashboard, snapshot, spike days, weekly
trend, top spike events and top consumers per OS."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import classify as C
from fleetlens.functions.dates import day_label, minute_label
from fleetlens.functions.numbers import as_double, finite, units_avg2, units_stddev2
from fleetlens.functions.text import short_hostname
from fleetlens.operators.filters import threshold_filter
from fleetlens.operators.joins import latest_left_join
from fleetlens.operators.windows import rank_global, sort_bounded, top_k
from fleetlens.plans.context import ReportRun


def cpu_dashboard_kpis(run: ReportRun) -> DataFrame:
    """One row: hosts with samples in the window, average, peak, spike
    samples, hosts with a spike."""
    k = run.folds.fleet(run.p.lookback_days)
    return k.select("total_hosts", as_double("avg_cpu").alias("avg_cpu"), as_double("max_cpu").alias("max_cpu"),
                    "spike_count", "hosts_with_spikes")


def cpu_current_snapshot(run: ReportRun) -> DataFrame:
    """Latest reading per fleet host in the last ``snapshot_days`` days;
    hosts without one are kept with 0, ``N/A`` and NORMAL.  Colour and
    badge test the raw value, the printed value is rounded."""
    p = run.p
    latest = run.folds.latest(p.snapshot_days)
    v, printed = finite("average"), run.value()
    joined = latest_left_join(run.hosts, latest)
    # raw value first, then the short name (ascending puts NULL names last
    # in the repository's order), then the full name for repeatable ties
    joined = joined.orderBy(F.coalesce(v, F.lit(0.0)).desc(),
                            short_hostname("target_name").asc_nulls_last(), F.col("target_name"))
    return joined.select(
        "target_name",
        short_hostname("target_name").alias("hostname"),
        "os_type",
        as_double(F.round(F.coalesce(printed, F.lit(0)), 2)).alias("cpu_pct"),
        C.snapshot_badge(v, p.high_cutoff, p.warn_cutoff).alias("status"),
        C.snapshot_colour(v, p.high_cutoff, p.warn_cutoff, p.elevated_cutoff).alias("colour"),
        F.coalesce(minute_label("rollup_timestamp"), F.lit("N/A")).alias("last_measured"),
        C.snapshot_status4(v, p.high_cutoff, p.warn_cutoff, p.elevated_cutoff).alias("status4"))


def spike_rows(run: ReportRun, rows: DataFrame) -> DataFrame:
    """Readings at or above the threshold; the test reaches the fact scan."""
    return threshold_filter(rows, "average", run.p.spike_threshold)


def cpu_spike_days(run: ReportRun) -> DataFrame:
    """Calendar days with at least one spike sample: hosts affected,
    incidents, peak."""
    days = run.folds.spike_days(run.p.lookback_days)
    return (days.select(day_label("day").alias("spike_day"), "hosts_affected", "incident_count",
                        as_double("peak_cpu").alias("peak_cpu"))
            .transform(lambda d: sort_bounded(d, [F.col("spike_day").desc()])))


def cpu_weekly_trend(run: ReportRun) -> DataFrame:
    """ISO weeks labelled by their Sunday: average, peak and spike samples;
    the peak colour tests the rounded peak."""
    p = run.p
    wk = run.folds.weeks(p.lookback_days)
    return (wk.select(day_label("week_end").alias("week_end"), as_double("avg_cpu").alias("avg_cpu"),
                      as_double("max_cpu").alias("max_cpu"), "spike_count",
                      C.peak_colour("max_cpu", p.high_cutoff, p.warn_cutoff).alias("colour"))
            .transform(lambda d: sort_bounded(d, [F.col("week_end").desc()])))


def cpu_top_spike_events(run: ReportRun) -> DataFrame:
    """The ``events_k`` highest spike samples of the fixed ``events_days``
    window, newest first among equal values."""
    p = run.p
    spikes = run.folds.spikes(p.events_days)
    order = [F.col("average").desc(), F.col("rollup_timestamp").desc(), F.col("target_name")]
    ranked = rank_global(spikes, order, p.events_k)
    return ranked.select(
        "target_name", short_hostname("target_name").alias("hostname"), "os_type",
        minute_label("rollup_timestamp").alias("event_ts"),
        as_double(F.round(run.value(), 2)).alias("cpu_pct"), "rn",
        F.lit(C.PATTERN_HINT_TEXT).alias("pattern_hint")).orderBy("rn")


def host_stats(run: ReportRun, os_name: str | None = None) -> DataFrame:
    """Per-host average, min, max, standard deviation and incidents over the
    lookback window; ``os_name`` matches the OS case-insensitively."""
    p = run.p
    st = run.folds.host_sums(p.lookback_days, os_name).select(
        "target_name", "os_type", "incidents",
        units_stddev2("s", "n", "sq", p.value_scale).alias("stddev_cpu"),
        units_avg2("s", "n", p.value_scale).alias("avg2"),
        F.round(run.value("mn"), 2).alias("min2"), F.round(run.value("mx"), 2).alias("max2"))
    return st.select(
        "target_name", short_hostname("target_name").alias("hostname"), "os_type",
        as_double("avg2").alias("avg_cpu"), as_double("min2").alias("min_cpu"),
        as_double("max2").alias("max_cpu"), "stddev_cpu", "incidents",
        C.action("incidents", "avg2", p.elevated_cutoff).alias("action"),
        C.avg_colour("avg2", p.warn_cutoff, p.elevated_cutoff).alias("avg_colour"),
        C.peak_colour("max2", p.high_cutoff, p.warn_cutoff).alias("max_colour"),
        C.incident_colour("incidents").alias("incident_colour"))


def cpu_top_consumers(run: ReportRun, os_name: str) -> DataFrame:
    """The ``consumers_k`` hosts of one OS with the highest rounded peak,
    then average (NULLs first, as a descending sort does in the
    repository); the host name breaks remaining ties."""
    st = host_stats(run, os_name)
    order = [F.col("max_cpu").desc_nulls_first(), F.col("avg_cpu").desc_nulls_first(),
             F.col("target_name")]
    return top_k(st, order, run.p.consumers_k)


def cpu_top_consumers_linux(run: ReportRun) -> DataFrame:
    return cpu_top_consumers(run, "LINUX")


def cpu_top_consumers_aix(run: ReportRun) -> DataFrame:
    return cpu_top_consumers(run, "AIX")
