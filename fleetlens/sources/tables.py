"""The five monitoring relations, their schemas and typed readers.

The reports only ever see these DataFrames, whether they come from parquet
files, a JDBC connection to the monitoring repository, or the test mapping
of :mod:`fleetlens.sources.testmap`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_SCHEMA = (
    ("target_name", "string"),
    ("target_type", "string"),
    ("type_qualifier1", "string"),
    ("type_qualifier2", "string"),
    ("host_name", "string"),
)
HOURLY_SCHEMA = (
    ("target_name", "string"),
    ("target_type", "string"),
    ("metric_name", "string"),
    ("metric_column", "string"),
    ("rollup_timestamp", "timestamp_ntz"),
    ("average", "double"),
)
DAILY_SCHEMA = (
    ("target_name", "string"),
    ("target_type", "string"),
    ("metric_name", "string"),
    ("metric_column", "string"),
    ("rollup_timestamp", "timestamp_ntz"),
    ("maximum", "double"),
)
CURRENT_SCHEMA = (
    ("target_name", "string"),
    ("metric_name", "string"),
    ("metric_column", "string"),
    ("key_value", "string"),
    ("value", "string"),
)
TABLESPACE_SCHEMA = (
    ("target_name", "string"),
    ("host_name", "string"),
    ("tablespace_name", "string"),
    ("status", "string"),
    ("contents", "string"),
    ("tablespace_size", "bigint"),
    ("tablespace_used_size", "bigint"),
    ("collection_timestamp", "timestamp_ntz"),
)

SCHEMAS = {
    "mon_target": TARGET_SCHEMA,
    "mon_metric_hourly": HOURLY_SCHEMA,
    "mon_metric_daily": DAILY_SCHEMA,
    "mon_metric_current": CURRENT_SCHEMA,
    "mon_db_tablespaces": TABLESPACE_SCHEMA,
}

# Optional partition columns of the time-series tables: the hourly series by
# day, the daily series by month (in buckets: by year).  When present, window filters also prune
# partitions (see operators.filters).
PARTITION_COLUMN = "rollup_date"
MONTH_PARTITION_COLUMN = "rollup_month"
YEAR_PARTITION_COLUMN = "rollup_year"
PARTITION_COLUMNS = (PARTITION_COLUMN, MONTH_PARTITION_COLUMN, YEAR_PARTITION_COLUMN)


def conform(df: DataFrame, schema) -> DataFrame:
    """Project and cast ``df`` to a fixed schema (extra columns dropped, a
    partition column kept).  Casting is a no-op when types already match."""
    cols = [F.col(n).cast(t).alias(n) for n, t in schema]
    cols += [F.col(c) for c in PARTITION_COLUMNS if c in df.columns]
    return df.select(*cols)


@dataclass(frozen=True)
class MonitoringTables:
    """The monitoring repository as lazy DataFrames."""

    targets: DataFrame
    hourly: DataFrame
    daily: DataFrame
    current: DataFrame
    tablespaces: DataFrame


def read_parquet_tables(spark: SparkSession, root: str) -> MonitoringTables:
    """Read ``root/<table>`` parquet datasets (optionally date-partitioned)."""
    def rd(name):
        return conform(spark.read.parquet(f"{root.rstrip('/')}/{name}"), SCHEMAS[name])
    return MonitoringTables(rd("mon_target"), rd("mon_metric_hourly"), rd("mon_metric_daily"),
                            rd("mon_metric_current"), rd("mon_db_tablespaces"))


def read_jdbc_tables(spark: SparkSession, url: str, tables: dict[str, str],
                     properties: dict[str, str] | None = None, *,
                     lower_bound: str, upper_bound: str,
                     num_partitions: int = 64, fetch_size: int = 10_000) -> MonitoringTables:
    """Read the relations over JDBC.  The hourly and daily facts are split
    into ``num_partitions`` parallel range reads on ``rollup_timestamp``
    between the bounds (rows outside fall to the first and last part), so no
    fact is read by one task; the small relations are read in one query
    each."""
    props = dict(properties or {})

    def rd(name, partitioned=False):
        r = spark.read.format("jdbc").option("url", url).option("dbtable", tables[name])
        r = r.option("fetchsize", fetch_size)
        for k, v in props.items():
            r = r.option(k, v)
        if partitioned:
            r = (r.option("partitionColumn", "rollup_timestamp")
                 .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                 .option("numPartitions", num_partitions))
        df = r.load()
        return conform(df.toDF(*[c.lower() for c in df.columns]), SCHEMAS[name])

    return MonitoringTables(rd("mon_target"), rd("mon_metric_hourly", True),
                            rd("mon_metric_daily", True), rd("mon_metric_current"),
                            rd("mon_db_tablespaces"))


def write_partitioned_hourly(df: DataFrame, path: str, mode: str = "overwrite",
                             grain: str = "day", files_per_period: int | None = None) -> None:
    """Lay a metric time series out by day (or month) so window filters
    prune whole folders.

    Rows are sorted by period, then metric and target, so the row groups of
    a file are clustered by metric and the pushed ``metric_name`` /
    ``metric_column`` filters skip other metrics' row groups by their
    min/max statistics.

    * ``files_per_period=None``: no shuffle; each task writes one file per
      period it holds (right for data already arriving in time order).
    * ``files_per_period=k``: rows are shuffled on (period, hash of target
      mod k), so each period is written as about ``k`` files of similar
      size; no period funnels into one task unless ``k`` is 1.
    """
    if grain == "day":
        col, period = PARTITION_COLUMN, F.to_date("rollup_timestamp")
    else:
        col, period = MONTH_PARTITION_COLUMN, F.trunc(F.to_date("rollup_timestamp"), "month")
    out = df.withColumn(col, period)
    if files_per_period:
        out = out.repartition(col, F.pmod(F.xxhash64("target_name"), F.lit(files_per_period)))
    (out.sortWithinPartitions(col, "metric_name", "metric_column", "target_name")
        .write.mode(mode).partitionBy(col).parquet(path))


def tables_from_rows(spark: SparkSession, targets=(), hourly=(), daily=(), current=(),
                     tablespaces=()) -> MonitoringTables:
    """Small in-memory relations (unit tests, examples).  Rows are tuples in
    schema order."""
    def mk(rows, schema):
        ddl = ", ".join(f"{n} {t}" for n, t in schema)
        return spark.createDataFrame(list(rows), ddl)
    return MonitoringTables(mk(targets, TARGET_SCHEMA), mk(hourly, HOURLY_SCHEMA),
                            mk(daily, DAILY_SCHEMA), mk(current, CURRENT_SCHEMA),
                            mk(tablespaces, TABLESPACE_SCHEMA))


def materialize_tables(tables, root: str, mode: str = "overwrite",
                       files_per_period: int | None = None) -> MonitoringTables:
    """Write the five relations under ``root`` (hourly series by day, daily
    series by month) and return readers over the written copy.  Use a
    shared folder (e.g. under ``spark.checkpoint.dir``) on a cluster: the
    written tables cut the lineage of whatever produced them and survive
    executor loss."""
    root = root.rstrip("/")
    tables.targets.write.mode(mode).parquet(f"{root}/mon_target")
    write_partitioned_hourly(tables.hourly, f"{root}/mon_metric_hourly", mode,
                             files_per_period=files_per_period)
    write_partitioned_hourly(tables.daily, f"{root}/mon_metric_daily", mode, grain="month",
                             files_per_period=files_per_period)
    tables.current.write.mode(mode).parquet(f"{root}/mon_metric_current")
    tables.tablespaces.write.mode(mode).parquet(f"{root}/mon_db_tablespaces")
    spark = tables.targets.sparkSession
    return read_parquet_tables(spark, root)
