"""Ranking, latest-per-key, previous-row and top-k operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(ts: str = "rollup_timestamp", values: tuple[str, ...] = ("average", "cpu_units")) -> Column:
    """Extremum of a total order: the newest reading, of readings at one
    instant the highest (a NULL one comes last).  It can be merged, so
    parts of a series may be folded first, and shuffled rows with ties give
    equal results."""
    return F.max(F.struct(ts, *values))


def latest_per_host(cpu: DataFrame, key: str = "target_name", ts: str = "rollup_timestamp",
                    values: tuple[str, ...] = ("average", "cpu_units")) -> DataFrame:
    """Newest reading per host (:func:`newest`).  Written as an aggregate
    rather than ``row_number() = 1``: it is combined map-side, so a host with a
    third of all rows still ships one partial row per task."""
    return (cpu.groupBy(key).agg(newest(ts, values).alias("_newest"))
            .select(key, *[F.col(f"_newest.{c}") for c in (ts, *values)]))


def latest_by_rank(cpu: DataFrame, key: str = "target_name", ts: str = "rollup_timestamp",
                   value: str = "average") -> DataFrame:
    """The same as :func:`latest_per_host`, written as ``row_number() = 1``
    per host.  Spark plans the filter as a partial ``WindowGroupLimit``
    before the shuffle, so each task also ships one row per host."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col(value).desc_nulls_last())
    return cpu.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows in ``order``: each task keeps its own k best and one
    task merges k rows per task (``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(k)


def rank_global(df: DataFrame, order: list[Column], k: int, rn: str = "rn") -> DataFrame:
    """Top ``k`` with a 1-based rank.  The limit runs first, so the window
    that numbers the rows sees ``k`` rows in one partition, never the input."""
    return (top_k(df, order, k)
            .withColumn(rn, F.row_number().over(Window.orderBy(*order)).cast("bigint")))


def lag_prev(df: DataFrame, partition: str, order: str, cols: dict[str, str]) -> DataFrame:
    """Previous row's value per partition (a missing month compares with the
    month before it; there is no calendar fill)."""
    w = Window.partitionBy(partition).orderBy(order)
    for src, alias in cols.items():
        df = df.withColumn(alias, F.lag(src).over(w))
    return df


def sort_bounded(df: DataFrame, order: list[Column]) -> DataFrame:
    """Order a result that holds at most one row per day (or week) of the
    report window, a few dozen rows: one task sorts it, with no
    range-partition sampling job.  Per-host or per-database results, whose
    size follows the fleet, use a distributed ``orderBy``."""
    return df.coalesce(1).sortWithinPartitions(*order)
