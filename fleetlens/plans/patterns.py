"""Reports the CPU script describes but does not compute: recurring spike
hours, a rolling 7-day average and the ELEVATED class.  Kept apart from the
faithful reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.dates import as_of_literal, day_bucket, day_label, days_before, minute_label
from fleetlens.functions.numbers import as_double, units_avg2
from fleetlens.functions.text import short_hostname
from fleetlens.operators.windows import sort_bounded
from fleetlens.plans.context import ReportRun
from fleetlens.plans.cpu import cpu_current_snapshot, spike_rows

ISOLATED_TEXT = "Isolated"


def cpu_recurring_pattern(run: ReportRun) -> DataFrame:
    """Every spike sample of the events window, marked ``Recurring batch @
    HH:00`` when its host spiked at that hour of day on at least
    ``recurring_min_days`` distinct days, else ``Isolated``.

    The distinct days are counted per (host, hour of day) by an aggregate:
    (host, hour, day) is deduplicated map-side, so a host holding a third
    of all rows, copies included, sends at most one row per hour and day
    from each task to the one shuffle.  The counts (at most 24 per spiking
    host) are joined back with no hint: AQE broadcasts them when their
    measured size is small, else the join shuffles and a hot host is split
    by AQE's skew join."""
    p = run.p
    spikes = (spike_rows(run, run.fleet_cpu_semi(p.events_days))
              .withColumn("spike_hour", F.hour("rollup_timestamp")))
    per_hour = (spikes.groupBy("target_name", "spike_hour")
                .agg(F.count_distinct(day_bucket("rollup_timestamp")).alias("days_at_hour")))
    spikes = spikes.join(per_hour, ["target_name", "spike_hour"], "inner")
    hh = F.lpad(F.col("spike_hour").cast("string"), 2, "0")
    return spikes.select(
        "target_name", short_hostname("target_name").alias("hostname"),
        minute_label("rollup_timestamp").alias("event_ts"),
        as_double(F.round(run.value(), 2)).alias("cpu_pct"),
        F.col("spike_hour").cast("bigint").alias("spike_hour"), "days_at_hour",
        F.when(F.col("days_at_hour") >= p.recurring_min_days,
               F.concat(F.lit("Recurring batch @ "), hh, F.lit(":00")))
        .otherwise(F.lit(ISOLATED_TEXT)).alias("pattern_hint"))


def batches(spikes: DataFrame, grain_minutes: int = 60) -> DataFrame:
    """Runs of spike readings, one row each: ``target_name, first_ts, last_ts,
    samples, peak_units``.  Readings of a host that are at most one grain
    apart are one run, over midnight too (gaps and islands, as session windows:
    readings that touch or overlap merge).  Readings of one instant count
    once; they are folded map-side before the sessions are built."""
    instants = spikes.groupBy("target_name", "rollup_timestamp").agg(F.max("cpu_units").alias("units"))
    run = F.session_window("rollup_timestamp", f"{grain_minutes} minutes")
    return (instants.groupBy("target_name", run)
            .agg(F.min("rollup_timestamp").alias("first_ts"), F.max("rollup_timestamp").alias("last_ts"),
                 F.count(F.lit(1)).alias("samples"), F.max("units").alias("peak_units"))
            .drop("session_window"))


def cpu_spike_batches(run: ReportRun, grain_minutes: int = 60) -> DataFrame:
    """Every batch of the events window: its start and end to the minute,
    length, peak, on how many days a batch of this host started at that
    time of day, and the hint ``Recurring batch @ HH:MI`` from
    ``recurring_min_days`` days on, else ``Isolated``.

    A batch that the window's start or end may have cut is marked
    (``open_start``, ``open_end``); a cut start is no start, so it counts for
    no time of day and is never recurring."""
    p = run.p
    grain = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(grain_minutes))
    rows = batches(run.folds.spikes_semi(p.events_days), grain_minutes).withColumns({
        "open_start": F.col("first_ts") < days_before(p.as_of, p.events_days) + grain,
        "open_end": F.col("last_ts") + grain > as_of_literal(p.as_of),
        "start_hhmi": F.date_format("first_ts", "HH:mm")})
    # readings of one minute are in one batch, so batches with one start are on
    # different days: a window partition holds a row per day at most
    starts = Window.partitionBy("target_name", "start_hhmi")
    rows = rows.withColumn("days_at_start", F.when(F.col("open_start"), F.lit(0)).otherwise(
        F.count(F.when(~F.col("open_start"), F.lit(1))).over(starts)).cast("bigint"))
    return rows.select(
        "target_name", short_hostname("target_name").alias("hostname"),
        minute_label("first_ts").alias("start_ts"), minute_label("last_ts").alias("last_spike_ts"), "start_hhmi",
        (F.timestamp_diff("MINUTE", F.col("first_ts"), F.col("last_ts")) + grain_minutes).alias("length_minutes"),
        "samples", as_double(F.round(run.value("peak_units"), 2)).alias("peak_cpu"), "days_at_start",
        "open_start", "open_end",
        F.when(F.col("days_at_start") >= p.recurring_min_days,
               F.concat(F.lit("Recurring batch @ "), F.col("start_hhmi")))
        .otherwise(F.lit(ISOLATED_TEXT)).alias("pattern_hint"))


def cpu_rolling_7d(run: ReportRun) -> DataFrame:
    """Fleet average over the trailing ``rolling_days`` calendar days, per
    day of the lookback window.  Days are folded to one (sum, count) row
    first; the window then runs over one row per day, so the single
    partition it needs holds at most ``lookback_days + 1`` rows."""
    p = run.p
    daily = run.folds.days(p.lookback_days).select(F.col("bucket").alias("d"), "s", "n")
    w = Window.orderBy(F.unix_date("d")).rangeBetween(-(p.rolling_days - 1), 0)
    out = daily.select(
        "d", F.sum("s").over(w).alias("ws"), F.sum("n").over(w).alias("wn"),
        F.count(F.lit(1)).over(w).alias("days_in_window"),
        units_avg2("s", "n", p.value_scale).alias("day_avg"))
    return out.select(day_label("d").alias("day"),
                      as_double("day_avg").alias("daily_avg_cpu"),
                      as_double(units_avg2("ws", "wn", p.value_scale)).alias("rolling_avg_cpu"),
                      "days_in_window").transform(lambda d: sort_bounded(d, [F.col("day")]))


def cpu_elevated_hosts(run: ReportRun) -> DataFrame:
    """The snapshot with the four-way class, including ELEVATED (50-79)."""
    return cpu_current_snapshot(run).select("target_name", "hostname", "os_type", "cpu_pct",
                                            "status", "status4")
