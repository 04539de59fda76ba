"""Row filters.  All are plain predicates, so Catalyst pushes the metric,
type and time terms into the parquet scan (``PushedFilters``)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.dates import as_of_literal, days_before, months_back_start
from fleetlens.functions.numbers import at_least
from fleetlens.sources.tables import MONTH_PARTITION_COLUMN, PARTITION_COLUMN, YEAR_PARTITION_COLUMN


def fleet_filter(targets: DataFrame, name_like: str = "%-D-%") -> DataFrame:
    """Hosts whose name contains the fleet marker, case-insensitively."""
    return targets.where((F.col("target_type") == "host")
                         & F.upper("target_name").like(name_like.upper()))


def metric_filter(df: DataFrame, name: str, column: str, target_type: str | None = None) -> DataFrame:
    cond = (F.col("metric_name") == name) & (F.col("metric_column") == column)
    if target_type is not None:
        cond = cond & (F.col("target_type") == target_type)
    return df.where(cond)


def lookback_filter(df: DataFrame, as_of, days: int, ts: str = "rollup_timestamp") -> DataFrame:
    """Rows from the instant ``days`` days before ``as_of`` up to ``as_of``.
    When the data is laid out by day, month or year, the same bounds on that column
    prune whole partitions before any file is opened."""
    return _between(df, ts, days_before(as_of, days), as_of_literal(as_of))


def _between(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    out = df.where((F.col(ts) >= start) & (F.col(ts) <= end))
    first, last = F.to_date(start), F.to_date(end)
    if PARTITION_COLUMN in df.columns:
        out = out.where(F.col(PARTITION_COLUMN).between(first, last))
    if MONTH_PARTITION_COLUMN in df.columns:
        out = out.where(F.col(MONTH_PARTITION_COLUMN).between(F.trunc(first, "month"), F.trunc(last, "month")))
    if YEAR_PARTITION_COLUMN in df.columns:
        out = out.where(F.col(YEAR_PARTITION_COLUMN).between(F.trunc(first, "year"), F.trunc(last, "year")))
    return out


def outside_days(df: DataFrame, first: date, last: date, ts: str = "rollup_timestamp") -> DataFrame:
    """Rows before day ``first`` or after day ``last``; prunes day folders."""
    start, end = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (first, last + timedelta(days=1)))
    out = df.where((F.col(ts) < start) | (F.col(ts) >= end))
    if PARTITION_COLUMN in df.columns:
        day = F.col(PARTITION_COLUMN)
        out = out.where((day < F.lit(first)) | (day > F.lit(last)))
    return out


def day_range_filter(df: DataFrame, first: date, last: date, ts: str = "rollup_timestamp") -> DataFrame:
    """Rows of the whole days ``first`` to ``last``; prunes day folders."""
    start, end = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (first, last + timedelta(days=1)))
    out = df.where((F.col(ts) >= start) & (F.col(ts) < end))
    if PARTITION_COLUMN in df.columns:
        out = out.where(F.col(PARTITION_COLUMN).between(F.lit(first), F.lit(last)))
    return out


def month_window_filter(df: DataFrame, as_of, months_back: int, ts: str = "rollup_timestamp") -> DataFrame:
    """Rows from the first day of the month ``months_back`` months before
    ``as_of``'s month up to ``as_of``."""
    return _between(df, ts, months_back_start(as_of, months_back).cast("timestamp_ntz"), as_of_literal(as_of))


def threshold_filter(df: DataFrame, col, cutoff) -> DataFrame:
    """Rows whose stored reading is at or above ``cutoff``."""
    return df.where(at_least(col, cutoff))


def type_in_filter(df: DataFrame, col: str, values) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def positive_filter(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & (F.col(col) > 0))


def having_filter(df: DataFrame, keys, min_rows: int = 1) -> DataFrame:
    """Group, count and keep groups with at least ``min_rows`` rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") >= min_rows))
