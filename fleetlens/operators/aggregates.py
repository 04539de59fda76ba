"""Aggregations.  All are algebraic (count, sum, min, max, moments), so Spark
combines them map-side before the shuffle: a host or a day that holds a
third of all rows still sends one partial row per task, not its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.dates import day_bucket, iso_week_end, month_start
from fleetlens.functions.numbers import from_units, to_units, units_avg2, wide_sum


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def conditional_count(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def conditional_distinct(cond: Column, col) -> Column:
    return F.count_distinct(F.when(cond, _c(col)))


def agg_global(cpu: DataFrame, spike: Column, scale: int = 6) -> DataFrame:
    """Whole window to one row (one row, counts 0, on empty input): hosts with
    readings, average, peak, spikes, hosts with a spike.  Folded per host
    first (combined map-side, no Expand for the two distinct counts), then the
    hosts to one row."""
    u = F.col("cpu_units")
    per_host = (cpu.groupBy("target_name")
                .agg(F.count(u).alias("n"), F.sum(u).alias("s"), F.max(u).alias("mx"),
                     conditional_count(spike).alias("spikes")))
    return fold_fleet(per_host, scale)


def fold_fleet(per_host: DataFrame, scale: int = 6) -> DataFrame:
    """The dashboard's row from one row per host: ``n, s, mx, spikes``."""
    return per_host.agg(
        F.count(F.lit(1)).alias("total_hosts"),
        units_avg2(wide_sum("s"), F.sum("n"), scale).alias("avg_cpu"),
        F.round(from_units(F.max("mx"), scale), 2).alias("max_cpu"),
        F.coalesce(F.sum("spikes"), F.lit(0)).cast("bigint").alias("spike_count"),
        F.count(F.when(F.col("spikes") > 0, F.lit(1))).alias("hosts_with_spikes"))


def agg_by_day(spikes: DataFrame, scale: int = 6) -> DataFrame:
    """Per calendar day of spike rows: hosts affected, incidents, peak."""
    return (spikes.groupBy(day_bucket("rollup_timestamp").alias("day"))
            .agg(F.count_distinct("target_name").alias("hosts_affected"),
                 F.count(F.lit(1)).alias("incident_count"),
                 F.round(from_units(F.max("cpu_units"), scale), 2).alias("peak_cpu")))


def fold_hosts(cpu: DataFrame, bucket: Column, spike: Column) -> DataFrame:
    """Sum, count, peak and spikes per ``bucket`` of the whole fleet: per host
    as longs, then over the hosts as decimals, which cannot overflow."""
    u = F.col("cpu_units")
    per_host = (cpu.groupBy("target_name", bucket.alias("bucket"))
                .agg(F.sum(u).alias("s"), F.count(u).alias("n"), F.max(u).alias("mx"),
                     conditional_count(spike).alias("spikes")))
    return per_host.groupBy("bucket").agg(
        wide_sum("s").alias("s"), F.sum("n").alias("n"), F.max("mx").alias("mx"),
        F.sum("spikes").alias("spike_count"))


def agg_by_iso_week(cpu: DataFrame, spike: Column, scale: int = 6) -> DataFrame:
    return week_rows(fold_hosts(cpu, iso_week_end("rollup_timestamp"), spike), scale)


def week_rows(folded: DataFrame, scale: int = 6) -> DataFrame:
    """Weekly figures from ``bucket`` (the week's end), ``s, n, mx, spike_count``."""
    return folded.select(F.col("bucket").alias("week_end"), units_avg2("s", "n", scale).alias("avg_cpu"),
                         F.round(from_units("mx", scale), 2).alias("max_cpu"), "spike_count")


def pivot_max(df: DataFrame, keys, pivot_col: str, value: Column, values) -> DataFrame:
    """Entity-attribute-value rows to columns: ``max(value)`` per attribute,
    with a fixed attribute list (no extra job to discover it)."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(pivot_col) == v, value)).alias(v) for v in values])


def pivot_sum(df: DataFrame, keys, pivot_col: str, value: Column, mapping: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(pivot_col) == v, value)).alias(alias) for v, alias in mapping.items()])


def agg_monthly_avg(daily: DataFrame, keys=("target_name",), scale: int = 6) -> DataFrame:
    """Average of the daily maximum per month and metric column, 2 places:
    exact long sums of unit readings, one exact division per group."""
    u = to_units("maximum", scale)
    return (daily.groupBy(*keys, month_start("rollup_timestamp").alias("month_dt"), "metric_column")
            .agg(F.sum(u).alias("s"), F.count(u).alias("n"))
            .select(*keys, "month_dt", "metric_column",
                    units_avg2("s", "n", scale).cast("decimal(18,2)").alias("avg_value")))


def ordered_list(item_sql: str, order_sql: str, sep: str = ", ") -> Column:
    """``LISTAGG(item, sep) WITHIN GROUP (ORDER BY ...)``; NULL items are
    skipped and an all-NULL group gives NULL."""
    return F.expr(f"listagg({item_sql}, '{sep}') WITHIN GROUP (ORDER BY {order_sql})")
