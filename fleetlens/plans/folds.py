"""The aggregates that the CPU sections are made of, from the readings."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.dates import day_bucket
from fleetlens.functions.numbers import square_sum, square_sums
from fleetlens.operators.aggregates import (agg_by_day, agg_by_iso_week, agg_global, conditional_count,
                                            fold_hosts)
from fleetlens.operators.filters import threshold_filter
from fleetlens.operators.windows import latest_per_host

if TYPE_CHECKING:
    from fleetlens.plans.context import ReportRun


class DirectFolds:
    """Every section folds the readings of its own window."""

    def __init__(self, run: ReportRun):
        self.run = run

    def fleet(self, days: int) -> DataFrame:
        """One row: hosts, average, peak, spikes, hosts with a spike."""
        return agg_global(self.run.fleet_cpu_semi(days), self.run.spike(), self.run.p.value_scale)

    def spike_days(self, days: int) -> DataFrame:
        """``day, hosts_affected, incident_count, peak_cpu`` of days with a spike."""
        rows = threshold_filter(self.run.fleet_cpu_semi(days), "average", self.run.p.spike_threshold)
        return agg_by_day(rows, self.run.p.value_scale)

    def weeks(self, days: int) -> DataFrame:
        """``week_end, avg_cpu, max_cpu, spike_count``."""
        return agg_by_iso_week(self.run.fleet_cpu_semi(days), self.run.spike(), self.run.p.value_scale)

    def days(self, days: int) -> DataFrame:
        """``bucket, s, n, mx, spike_count`` per day of the whole fleet."""
        return fold_hosts(self.run.fleet_cpu_semi(days), day_bucket("rollup_timestamp"), self.run.spike())

    def latest(self, days: int) -> DataFrame:
        """Newest reading per host."""
        return latest_per_host(self.run.fleet_cpu_semi(days))

    def spikes(self, days: int) -> DataFrame:
        """Readings at or above the threshold, with the host's OS."""
        return threshold_filter(self.run.fleet_cpu(days), "average", self.run.p.spike_threshold)

    def spikes_semi(self, days: int) -> DataFrame:
        """The same, each reading once, without the OS."""
        return threshold_filter(self.run.fleet_cpu_semi(days), "average", self.run.p.spike_threshold)

    def host_sums(self, days: int, os_name: str | None = None) -> DataFrame:
        """``target_name, os_type, s, n, mn, mx, sq, incidents``; ``os_name``
        matches the OS case-insensitively."""
        u = F.col("cpu_units")
        cpu = self.run.fleet_cpu(days)
        if os_name is not None:
            cpu = cpu.where(F.upper("os_type") == os_name.upper())
        return (cpu.groupBy("target_name", "os_type")
                .agg(F.sum(u).alias("s"), F.count(u).alias("n"), F.min(u).alias("mn"), F.max(u).alias("mx"),
                     *square_sums(u), conditional_count(self.run.spike()).alias("incidents"))
                .withColumn("sq", square_sum()))
