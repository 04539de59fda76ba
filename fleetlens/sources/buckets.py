"""The health relations laid out by the key they are joined on.

Every health section joins facts of a database, host or instance with the
inventory.  Here the facts are written in buckets by target name, and the
inventory (the dimension's self join, computed once) twice: by database and by
server.  Joins and folds on these keys then need no exchange: bucket ``i`` of
one side meets bucket ``i`` of the other, whatever the size of either.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.filters import type_in_filter
from fleetlens.operators.joins import self_join_hosts
from fleetlens.params import DB_TARGET_TYPES, Params
from fleetlens.plans.context import ReportRun
from fleetlens.sources.files import exists
from fleetlens.sources.tables import (PARTITION_COLUMNS, SCHEMAS, TARGET_SCHEMA, YEAR_PARTITION_COLUMN, MonitoringTables)

_INVENTORY = (("database_name", "string"), ("database_version", "string"), ("server", "string"), ("os", "string"),
              ("os_version", "string"))
# table -> columns, bucket key, partition column
LAYOUT = {
    "targets": (TARGET_SCHEMA, "target_name", None),
    "current": (SCHEMAS["mon_metric_current"], "target_name", None),
    "daily": (SCHEMAS["mon_metric_daily"], "target_name", YEAR_PARTITION_COLUMN),
    "tablespaces": (SCHEMAS["mon_db_tablespaces"], "target_name", None),
    "inventory_by_database": (_INVENTORY, "database_name", None),
    "inventory_by_server": (_INVENTORY, "server", None),
}


def write_buckets(tables: MonitoringTables, root: str, buckets: int) -> None:
    """Write the relations below ``root`` in ``buckets`` buckets each.  One
    shuffle per relation on the bucket key, so each bucket (of a year, for
    the daily facts) is one file; take so many buckets that one fits a task.
    Folders of a year, not of a month: every bucket has a file in each folder,
    and a long history would be mostly the making of small files."""
    inventory = self_join_hosts(tables.targets, DB_TARGET_TYPES, None).persist()
    frames = {"targets": tables.targets, "current": tables.current, "tablespaces": tables.tablespaces,
              "daily": tables.daily.drop(*PARTITION_COLUMNS).withColumn(
                  YEAR_PARTITION_COLUMN, F.trunc(F.to_date("rollup_timestamp"), "year")),
              "inventory_by_database": inventory, "inventory_by_server": inventory}
    spark = tables.targets.sparkSession
    for name, df in frames.items():
        columns, key, folder = LAYOUT[name]
        cols = [*(c for c, _ in columns), *([folder] if folder else [])]
        table = f"fleetlens_{uuid.uuid4().hex[:12]}"
        w = (df.select(*cols).repartition(buckets, key).write.format("parquet").mode("overwrite")
             .bucketBy(buckets, key).sortBy(key).option("path", f"{root.rstrip('/')}/{name}"))
        (w.partitionBy(folder) if folder else w).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay
    inventory.unpersist()
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{root}/layout")


def open_buckets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The relations of :func:`write_buckets`; the bucket layout is declared to
    this session's catalog."""
    if not exists(spark, f"{root}/layout"):
        raise ValueError(f"{root} holds no relations in buckets")
    buckets = spark.read.schema("buckets int").parquet(f"{root}/layout").first()["buckets"]
    out = {}
    for name, (columns, key, folder) in LAYOUT.items():
        table = f"fleetlens_{name}_{uuid.uuid4().hex[:12]}"
        cols = ", ".join(f"{c} {t}" for c, t in (*columns, *([(folder, "date")] if folder else [])))
        path = f"{root.rstrip('/')}/{name}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet "
                  + (f"PARTITIONED BY ({folder}) " if folder else "")
                  + f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        if folder:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        out[name] = spark.table(table)
    return out


class BucketedRun(ReportRun):
    """A run of the health sections over relations in buckets."""

    def __init__(self, spark: SparkSession, root: str, hourly: DataFrame, params: Params | None = None,
                 ranges: int | None = None):
        t = open_buckets(spark, root)
        super().__init__(MonitoringTables(t["targets"], hourly, t["daily"], t["current"], t["tablespaces"]), params,
                         ranges=ranges)
        self.stored = t

    def inventory(self, os_list, key: str = "server") -> DataFrame:
        stored = self.stored["inventory_by_server" if key == "server" else "inventory_by_database"]
        return type_in_filter(stored, "os", os_list)
