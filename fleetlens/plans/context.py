"""Shared inputs of one report run."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.numbers import at_least, from_units, to_units
from fleetlens.operators.filters import fleet_filter, lookback_filter, metric_filter, outside_days
from fleetlens.operators.joins import fleet_inner_join, fleet_semi_join, self_join_hosts
from fleetlens.params import DB_TARGET_TYPES, Params
from fleetlens.plans.folds import DirectFolds
from fleetlens.sources.tables import MonitoringTables


class ReportRun:
    """Tables + parameters, plus the few derived frames several reports use.

    ``persist=True`` keeps the fleet's CPU rows of the widest window cached
    (memory, spilling to disk) while several sections run; a lost executor
    only loses cache blocks, which Spark recomputes from the scan.  It pays
    off when the source is expensive to scan (JDBC); over day-partitioned
    parquet with pushed filters a re-scan is cheaper than building the
    cache (see the bench), so the default is off.

    ``ranges`` is the number of tasks that order a section whose rows the
    inventory repeats (:meth:`ordered`); None leaves it to the adaptive plan.
    """

    def __init__(self, tables: MonitoringTables, params: Params | None = None,
                 persist: bool = False, ranges: int | None = None):
        self.t = tables
        self.p = params or Params()
        self.persist = persist
        self.ranges = ranges

    def ordered(self, df: DataFrame, *cols: str) -> DataFrame:
        """``df`` in the order of ``cols``, in ``ranges`` tasks.  The adaptive
        plan merges a sort's partitions by their compressed size, and rows that
        the inventory repeats compress a hundredfold: one task then sorts them
        all.  Ranges of a given number are not merged.  Without one (few rows,
        to be written as few files) it is a plain ``orderBy``."""
        if self.ranges is None:
            return df.orderBy(*cols)
        return df.repartitionByRange(self.ranges, *cols).sortWithinPartitions(*cols)

    # ---- dimension -----------------------------------------------------
    @cached_property
    def hosts(self) -> DataFrame:
        """Fleet hosts (name, OS); the list is not made distinct."""
        return fleet_filter(self.t.targets, self.p.name_like).select(
            "target_name", F.col("type_qualifier1").alias("os_type"))

    def inventory(self, os_list, key: str = "server") -> DataFrame:
        """Databases and the host each runs on, for hosts of the given OS
        values (exact, case-sensitive match); ``key`` is the column that the
        caller joins on."""
        return self_join_hosts(self.t.targets, DB_TARGET_TYPES, os_list)

    def members(self, os_list, key: str = "server") -> DataFrame:
        return self.inventory(tuple(os_list), key).select("database_name", "server", "os")

    # ---- CPU facts -----------------------------------------------------
    def cpu_rows(self, days: int, but: tuple[date, date] | None = None) -> DataFrame:
        """CPU readings of any host in the last ``days`` days, ``but`` those
        of whole days from one to another: the stored ``average``, which tests
        read, and ``cpu_units`` (BIGINT, 10^-value_scale per unit), which sums
        and printed values use."""
        h = metric_filter(self.t.hourly, "Load", "cpuUtil", "host")
        h = lookback_filter(h, self.p.as_of, days)
        if but is not None:
            h = outside_days(h, *but)
        return h.select("target_name", "rollup_timestamp", "average",
                        to_units("average", self.p.value_scale).alias("cpu_units"))

    @cached_property
    def _fleet_cpu_wide(self) -> DataFrame:
        days = max(self.p.lookback_days, self.p.snapshot_days, self.p.events_days)
        return fleet_semi_join(self.cpu_rows(days), self.hosts).persist(StorageLevel.MEMORY_AND_DISK)

    def fleet_cpu_semi(self, days: int) -> DataFrame:
        """Fleet CPU rows in the last ``days`` days (semi join: a host listed
        twice never repeats its rows)."""
        if self.persist:
            return lookback_filter(self._fleet_cpu_wide, self.p.as_of, days)
        return fleet_semi_join(self.cpu_rows(days), self.hosts)

    def fleet_cpu(self, days: int) -> DataFrame:
        """Fleet CPU rows with the host's OS; a host listed twice repeats
        them."""
        rows = self.fleet_cpu_semi(days) if self.persist else self.cpu_rows(days)
        return fleet_inner_join(rows, self.hosts)

    @cached_property
    def folds(self) -> DirectFolds:
        """Where the CPU sections get their aggregates from."""
        return DirectFolds(self)

    def spike(self):
        """The test for a spike, on the stored reading."""
        return at_least("average", self.p.spike_threshold)

    def value(self, units="cpu_units"):
        """Units back to the exact reading (DECIMAL)."""
        return from_units(F.col(units) if isinstance(units, str) else units, self.p.value_scale)

    def unpersist(self) -> None:
        if self.persist and "_fleet_cpu_wide" in self.__dict__:
            self._fleet_cpu_wide.unpersist()
