"""Current metrics split into numbers and what is none, in one pass.

A metric's value is text.  One text that is no number fails a strict health
report for the whole fleet.  Here the values that the reports read are
converted once and written in two parts by one job: numbers, which the
sections read in place of the relation, and a quarantine, which lists every bad
value with its databases.  Both counts come from the write itself.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetlens.functions.numbers import TEXT_NUMBER_TYPE
from fleetlens.operators.joins import inventory_join
from fleetlens.plans.context import ReportRun
from fleetlens.sources.tables import CURRENT_SCHEMA

_BAD = "quarantined"


@dataclass(frozen=True)
class Split:
    """``run``: the run over good values; ``bad``: the other rows; how many of each."""

    run: ReportRun
    bad: DataFrame
    n_good: int
    n_bad: int


def split_current(run: ReportRun, path: str) -> Split:
    """Write the current values that the health sections read below ``path``
    (a folder that all executors share), numbers apart from the rest.  A NULL
    value is no bad one: it stays."""
    wanted = ((F.col("metric_name") == "DiskGroup_Usage")
              | ((F.col("metric_name") == "Load") & (F.col("metric_column") == "cpuUtil")))
    bad = F.col("value").isNotNull() & F.col("value").try_cast(TEXT_NUMBER_TYPE).isNull()
    seen = Observation()
    names = [c for c, _ in CURRENT_SCHEMA]
    (run.t.current.where(wanted).select(*names, bad.alias(_BAD))
     .observe(seen, F.count(F.when(F.col(_BAD), F.lit(1))).alias("bad"), F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").partitionBy(_BAD).parquet(path))
    n_bad, rows = seen.get["bad"], seen.get["rows"]
    spark = run.t.current.sparkSession
    schema = ", ".join(f"{c} {t}" for c, t in CURRENT_SCHEMA) + f", {_BAD} boolean"
    both = spark.read.schema(schema).parquet(path) if rows else spark.createDataFrame([], schema)
    clean = ReportRun(replace(run.t, current=both.where(~F.col(_BAD)).drop(_BAD)), run.p, run.persist)
    return Split(clean, both.where(F.col(_BAD)).drop(_BAD), rows - n_bad, n_bad)


def quarantine(split: Split, os_list=None) -> DataFrame:
    """Every bad value: ``database_name, server, os`` of each database that it
    belongs to (NULL for a target outside the inventory) and the row.  The
    target is a server or a disk-group instance on one."""
    run = split.run
    inv = run.members(run.p.os_list if os_list is None else os_list)
    hosts = run.t.targets.where(F.col("target_type") == "osm_instance").select(
        F.col("target_name").alias("instance"), F.col("host_name").alias("instance_host"))
    bad = split.bad.withColumn("_row", F.xxhash64(*split.bad.columns))
    placed = (bad.join(hosts, bad["target_name"] == hosts["instance"], "left")
              .withColumn("server_name", F.coalesce("instance_host", "target_name")).drop("instance", "instance_host"))
    known = inventory_join(placed, inv, "server_name")
    unknown = placed.join(inv.select(F.col("server").alias("server_name")), "server_name", "left_anti").select(
        *placed.columns, *[F.lit(None).cast("string").alias(c) for c in ("database_name", "server", "os")])
    return known.unionByName(unknown, allowMissingColumns=True).select(
        "database_name", "server", "os", *split.bad.columns).orderBy(
        "os", "database_name", "target_name", "metric_column", "key_value", "value")
