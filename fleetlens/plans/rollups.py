"""CPU sections from a stored table of day partials.

The seven sections and the rolling average read the same readings seven times
and more.  Here a table holds one row per host and day: counts, exact sums and
squares, extremes, spikes at the cutoff, the newest reading.  All of it merges,
so any window is a fold of its days.  The window's whole days come from the
table, its partial first and last day (and days not stored yet) from the
readings, and the sections come out equal to those of the readings, to the
last digit.  A second table keeps the readings at or above the cutoff.

The tables are laid out by day and extended day by day; a new day reads that
day's readings only.  What is covered is a record written after the data, so a
killed extension leaves what was there, and the next one writes its days again.
"""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.dates import iso_week_end
from fleetlens.functions.numbers import at_least, from_units, square_sum, square_sums, to_units, wide_sum
from fleetlens.operators.aggregates import conditional_count, fold_fleet, week_rows
from fleetlens.operators.filters import day_range_filter, metric_filter, threshold_filter
from fleetlens.operators.joins import fleet_inner_join, fleet_semi_join
from fleetlens.operators.windows import newest
from fleetlens.params import Params
from fleetlens.plans.context import ReportRun
from fleetlens.plans.folds import DirectFolds
from fleetlens.sources.files import delete, exists, folders, partition_folder
from fleetlens.sources.tables import PARTITION_COLUMN, MonitoringTables

_PARTIALS = ("target_name string, n bigint, s bigint, mn bigint, mx bigint, sq decimal(38,0), spikes bigint, "
             "spike_mx bigint, latest struct<rollup_timestamp:timestamp_ntz,average:double,cpu_units:bigint>, "
             f"{PARTITION_COLUMN} date")
_SPIKES = ("target_name string, rollup_timestamp timestamp_ntz, average double, cpu_units bigint, "
           f"{PARTITION_COLUMN} date")
_COVERED = "first date, last date, cutoff double, value_scale int, seq bigint"


def day_partials(cpu: DataFrame, spike: Column) -> DataFrame:
    """One row per host and day of readings (``cpu_units`` and ``average``)."""
    u = F.col("cpu_units")
    return (cpu.groupBy("target_name", F.to_date("rollup_timestamp").alias(PARTITION_COLUMN))
            .agg(F.count(u).alias("n"), F.sum(u).alias("s"), F.min(u).alias("mn"), F.max(u).alias("mx"),
                 *square_sums(u), conditional_count(spike).alias("spikes"), F.max(F.when(spike, u)).alias("spike_mx"),
                 newest().alias("latest"))
            .select("target_name", "n", "s", "mn", "mx", square_sum().alias("sq"), "spikes", "spike_mx", "latest",
                    PARTITION_COLUMN))


class DayStore:
    """The stored partials and spikes below ``root`` (a folder that all
    executors share)."""

    def __init__(self, spark: SparkSession, root: str, params: Params):
        self.spark, self.root = spark, root.rstrip("/")
        self.cutoff, self.scale = float(params.spike_threshold), params.value_scale

    def covered(self) -> tuple[date, date] | None:
        """First and last day stored, without a gap."""
        path = f"{self.root}/covered"
        if not exists(self.spark, path):
            return None
        last = self.spark.read.schema(_COVERED).parquet(path).orderBy(F.col("seq").desc()).first()
        if last is None:
            return None
        if (last["cutoff"], last["value_scale"]) != (self.cutoff, self.scale):
            raise ValueError(f"the table was stored at cutoff {last['cutoff']}, scale {last['value_scale']}")
        return last["first"], last["last"]

    def readings(self, tables: MonitoringTables, first: date, last: date) -> DataFrame:
        """CPU readings of any host on these days; reads no other day's folder."""
        h = day_range_filter(metric_filter(tables.hourly, "Load", "cpuUtil", "host"), first, last)
        return h.select("target_name", "rollup_timestamp", "average",
                        to_units("average", self.scale).alias("cpu_units"))

    def extend(self, tables: MonitoringTables, last: date, first: date | None = None) -> tuple[date, date] | None:
        """Store the days from ``first`` (without it: from the day after the
        last one stored) to ``last``, all of which must be over.  Days stored
        before are written anew, for readings that came late.  Returns what is
        covered then."""
        have = self.covered()
        if first is None:
            if have is None:
                raise ValueError("nothing is stored yet: name the first day")
            first = have[1] + timedelta(days=1)
        if have and (first > have[1] + timedelta(days=1) or last < have[0] - timedelta(days=1)):
            raise ValueError(f"days {first} to {last} would leave a gap beside {have[0]} to {have[1]}")
        if first > last:
            return have
        cpu = self.readings(tables, first, last)
        self._write(day_partials(cpu, at_least("average", self.cutoff)), "host_days", first, last)
        spikes = threshold_filter(cpu, "average", self.cutoff)
        self._write(spikes.withColumn(PARTITION_COLUMN, F.to_date("rollup_timestamp")), "spikes", first, last)
        covered = (min(first, have[0]), max(last, have[1])) if have else (first, last)
        row = (*covered, self.cutoff, self.scale, time.time_ns())
        self.spark.createDataFrame([row], _COVERED).coalesce(1).write.mode("append").parquet(f"{self.root}/covered")
        return covered

    def _write(self, df: DataFrame, name: str, first: date, last: date) -> None:
        """Replace the days' folders; a day without rows any more loses its."""
        seen = Observation()
        (df.hint("rebalance", PARTITION_COLUMN)  # files of a good size per day, also of a large one
         .observe(seen, F.collect_set(PARTITION_COLUMN).alias("days"))  # one entry per day written
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN)
         .parquet(f"{self.root}/{name}"))
        written = {partition_folder(self.spark, PARTITION_COLUMN, str(d)) for d in seen.get["days"] or ()}
        days = {partition_folder(self.spark, PARTITION_COLUMN, str(first + timedelta(days=i)))
                for i in range((last - first).days + 1)}
        for gone in (days - written) & {*folders(self.spark, f"{self.root}/{name}")}:
            delete(self.spark, f"{self.root}/{name}/{gone}")

    def _read(self, name: str, schema: str, first: date, last: date) -> DataFrame:
        path = f"{self.root}/{name}"
        if not any("=" in f for f in folders(self.spark, path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).where(
            F.col(PARTITION_COLUMN).between(F.lit(first), F.lit(last)))

    def partials(self, first: date, last: date) -> DataFrame:
        return self._read("host_days", _PARTIALS, first, last)

    def spikes(self, first: date, last: date) -> DataFrame:
        return self._read("spikes", _SPIKES, first, last).drop(PARTITION_COLUMN)


class StoredFolds(DirectFolds):
    """The sections' aggregates, folded from day partials."""

    def __init__(self, run: ReportRun, store: DayStore):
        super().__init__(run)
        if (float(run.p.spike_threshold), run.p.value_scale) != (store.cutoff, store.scale):
            raise ValueError("the run's spike cutoff and scale must be those of the stored table")
        self.store, self.covered = store, store.covered()

    def stored_days(self, days: int) -> tuple[date, date] | None:
        """The window's whole days that are stored.  The window starts and
        ends at an instant, so its first and last day are partial as a rule."""
        end = self.run.p.as_of
        end = end if isinstance(end, datetime) else datetime(end.year, end.month, end.day)
        start = end - timedelta(days=days)
        first = start.date() if start == datetime(start.year, start.month, start.day) else start.date() + timedelta(1)
        last = end.date() - timedelta(days=1)
        if self.covered is None:
            return None
        first, last = max(first, self.covered[0]), min(last, self.covered[1])
        return (first, last) if first <= last else None

    def host_days(self, days: int) -> DataFrame:
        """Partials of all hosts over the window, one row per host and day."""
        whole = self.stored_days(days)
        rest = day_partials(self.run.cpu_rows(days, whole), self.run.spike())
        return self.store.partials(*whole).unionByName(rest) if whole else rest

    def _semi(self, days: int) -> DataFrame:
        return fleet_semi_join(self.host_days(days), self.run.hosts)

    def fleet(self, days: int) -> DataFrame:
        per_host = self._semi(days).groupBy("target_name").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("mx").alias("mx"), F.sum("spikes").alias("spikes"))
        return fold_fleet(per_host, self.run.p.value_scale)

    def spike_days(self, days: int) -> DataFrame:
        return (self._semi(days).where("spikes > 0").groupBy(F.col(PARTITION_COLUMN).alias("day"))
                .agg(F.count(F.lit(1)).alias("hosts_affected"), F.sum("spikes").alias("incident_count"),
                     F.round(from_units(F.max("spike_mx"), self.run.p.value_scale), 2).alias("peak_cpu")))

    def _by(self, days: int, bucket: Column) -> DataFrame:
        return self._semi(days).groupBy(bucket.alias("bucket")).agg(
            wide_sum("s").alias("s"), F.sum("n").alias("n"), F.max("mx").alias("mx"),
            F.sum("spikes").alias("spike_count"))

    def weeks(self, days: int) -> DataFrame:
        return week_rows(self._by(days, iso_week_end(PARTITION_COLUMN)), self.run.p.value_scale)

    def days(self, days: int) -> DataFrame:
        return self._by(days, F.col(PARTITION_COLUMN))

    def latest(self, days: int) -> DataFrame:
        return (self._semi(days).groupBy("target_name").agg(F.max("latest").alias("latest"))
                .select("target_name", "latest.*"))

    def _spikes(self, days: int) -> DataFrame:
        whole = self.stored_days(days)
        rest = threshold_filter(self.run.cpu_rows(days, whole), "average", self.run.p.spike_threshold)
        return self.store.spikes(*whole).unionByName(rest) if whole else rest

    def spikes(self, days: int) -> DataFrame:
        return fleet_inner_join(self._spikes(days), self.run.hosts)

    def spikes_semi(self, days: int) -> DataFrame:
        return fleet_semi_join(self._spikes(days), self.run.hosts)

    def host_sums(self, days: int, os_name: str | None = None) -> DataFrame:
        rows = fleet_inner_join(self.host_days(days), self.run.hosts)
        if os_name is not None:
            rows = rows.where(F.upper("os_type") == os_name.upper())
        return rows.groupBy("target_name", "os_type").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n"), F.min("mn").alias("mn"), F.max("mx").alias("mx"),
            F.sum("sq").cast("decimal(38,0)").alias("sq"), F.sum("spikes").alias("incidents"))


class RollupRun(ReportRun):
    """A run whose CPU sections are folded from a :class:`DayStore`."""

    def __init__(self, tables: MonitoringTables, store: DayStore, params: Params | None = None):
        super().__init__(tables, params)
        self.store = store

    @cached_property
    def folds(self) -> StoredFolds:
        return StoredFolds(self, self.store)
