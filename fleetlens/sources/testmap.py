"""Map the driver's generated tables onto the five monitoring relations.

This is the test fixture of ``FIXTURES.md`` section C: users of ``events``
become hosts with a disk-group instance each, tens of ``customer`` become
databases, ``orders`` become daily database sizes, ``supplier`` rows become
disk groups and idle hosts, parts become tablespaces.  Every relation is derived by Spark from the given
tables, so its size grows with the scale factor.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.dates import as_of_literal
from fleetlens.sources.tables import (CURRENT_SCHEMA, DAILY_SCHEMA, HOURLY_SCHEMA,
                                      TABLESPACE_SCHEMA, TARGET_SCHEMA, conform)

# Fixture constants (our own test mapping, not reference values).
CPU_AS_OF = datetime(2024, 1, 25, 12, 30)
GROWTH_AS_OF = datetime(2001, 7, 15)
TABLESPACE_TS = datetime(2024, 1, 31)
SUBSET_LOOKBACK_DAYS = 14


def _lp(c: Column, n: int = 5) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def host_of(u: Column) -> Column:
    """``Srv-d-00007.example.com`` (``-P-`` for every fourth user)."""
    return F.concat(F.lit("Srv"), F.when(u % 4 == 0, F.lit("-P-")).otherwise(F.lit("-d-")),
                    _lp(u), F.lit(".example.com"))


def os_of(k: Column) -> Column:
    return F.when(k % 3 == 0, F.lit("AIX")).otherwise(F.lit("Linux"))


def db_of(b: Column) -> Column:
    return F.concat(F.lit("DB"), _lp(b, 3))


def db_type_of(b: Column) -> Column:
    return (F.when(b % 3 == 0, F.lit("oracle_database"))
            .when(b % 3 == 1, F.lit("rac_database")).otherwise(F.lit("oracle_pdb")))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Numbers of databases: ten customers, or thirteen parts, belong to one.
def _customer_db(key: str) -> Column:
    return F.floor(F.col(key) / 10).cast("int")


def _part_db(key: str) -> Column:
    return F.floor(F.col(key) / 13).cast("int")


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    users = events.select(F.col("user_id").alias("u")).distinct()
    u = F.col("u")
    hosts = users.select(host_of(u).alias("target_name"), F.lit("host").alias("target_type"),
                         os_of(u).alias("type_qualifier1"),
                         F.concat(F.lit("v"), (u % 3).cast("string")).alias("type_qualifier2"),
                         host_of(u).alias("host_name"))
    s = F.col("s_suppkey")
    idle_name = F.concat(F.lit("Idle-d-"), _lp(s), F.lit(".example.com"))
    idle = (_read(spark, sf_dir, "supplier")
            .select(idle_name.alias("target_name"), F.lit("host").alias("target_type"),
                    os_of(s).alias("type_qualifier1"), F.lit("v0").alias("type_qualifier2"),
                    idle_name.alias("host_name")))
    b = F.col("b")
    dbs = (_read(spark, sf_dir, "customer").select(_customer_db("c_custkey").alias("b")).distinct()
           .select(db_of(b).alias("target_name"), db_type_of(b).alias("target_type"),
                   F.concat(F.lit("19."), (b % 5).cast("string")).alias("type_qualifier1"),
                   F.lit(None).cast("string").alias("type_qualifier2"),
                   host_of(b).alias("host_name")))
    asm = users.select(
        F.concat(F.lit("+ASM_"), _lp(u)).alias("target_name"),
        F.lit("osm_instance").alias("target_type"),
        F.lit(None).cast("string").alias("type_qualifier1"),
        F.lit(None).cast("string").alias("type_qualifier2"),
        host_of(u).alias("host_name"))
    return conform(hosts.unionByName(idle).unionByName(dbs).unionByName(asm), TARGET_SCHEMA)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    g = (ev.groupBy(F.col("user_id").alias("u"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"))
         .agg(F.avg("value").alias("a")))
    u, a = F.col("u"), F.col("a")
    # users live up to fifteen days earlier, so the window cuts at both ends
    g = g.withColumn("h", F.col("h") - F.make_dt_interval((u % 4 * 5).cast("int")))
    cpu_avg = (F.when(u % 10 == 7, F.lit(50.0) + a * F.lit(0.05))
               .otherwise(F.least(F.lit(100.0), a * (F.lit(1) + u % 5) * F.lit(0.4))))
    # one pass over the groups: every group yields its CPU row, even users
    # also a distractor row of another metric column (filtered by reports)
    rows = F.when(u % 2 == 0, F.array(
        F.struct(F.lit("cpuUtil").alias("mc"), cpu_avg.alias("v")),
        F.struct(F.lit("memUsedPct").alias("mc"), F.lit(99.0).alias("v")),
    )).otherwise(F.array(F.struct(F.lit("cpuUtil").alias("mc"), cpu_avg.alias("v"))))
    out = g.select(host_of(u).alias("target_name"), F.col("h"), F.explode(rows).alias("r"))
    return conform(out.select("target_name", F.lit("host").alias("target_type"),
                              F.lit("Load").alias("metric_name"),
                              F.col("r.mc").alias("metric_column"),
                              F.col("h").alias("rollup_timestamp"),
                              F.col("r.v").alias("average")), HOURLY_SCHEMA)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    b = _customer_db("o_custkey")
    used = F.when(F.col("o_orderkey") % 50 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice") / 1000)
    alloc = F.when(b % 2 == 0, F.lit(1000.0) + b).otherwise(F.col("o_totalprice") / 500)
    rows = F.array(F.struct(F.lit("USED_GB").alias("mc"), used.alias("v")),
                   F.struct(F.lit("ALLOCATED_GB").alias("mc"), alloc.alias("v")))
    out = o.select(db_of(b).alias("target_name"), db_type_of(b).alias("target_type"),
                   F.col("o_orderdate").alias("rollup_timestamp"), F.explode(rows).alias("r"))
    return conform(out.select("target_name", "target_type", F.lit("DATABASE_SIZE").alias("metric_name"),
                              F.col("r.mc").alias("metric_column"), "rollup_timestamp",
                              F.col("r.v").alias("maximum")), DAILY_SCHEMA)


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    last = ev.groupBy(F.col("user_id").alias("u")).agg(F.max_by("value", "event_id").alias("v"))
    u = F.col("u")
    # exact decimal arithmetic, so the text value does not depend on how an
    # engine rounds binary doubles (users 2 and 3 sit on rounding edges)
    pct = (F.when(u == 1, F.lit(Decimal("85.0"))).when(u == 2, F.lit(Decimal("79.5")))
           .when(u == 3, F.lit(Decimal("89.5")))
           .otherwise(F.least(F.lit(Decimal("100.0")),
                              F.col("v").cast("decimal(18,2)") * F.lit(Decimal("0.9")))))
    cpu = last.select(host_of(u).alias("target_name"), F.lit("Load").alias("metric_name"),
                      F.lit("cpuUtil").alias("metric_column"), F.lit(" ").alias("key_value"),
                      pct.cast("decimal(10,2)").cast("string").alias("value"))
    s = F.col("s_suppkey")
    p = (F.abs(F.col("s_acctbal")) % 100).cast("decimal(10,2)")
    tot = F.lit(102400) + s * 1024
    free = (tot.cast("decimal(20,0)") * (F.lit(100) - p) * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
    rows = F.array(F.struct(F.lit("percent_used").alias("mc"), p.cast("string").alias("v")),
                   F.struct(F.lit("total_mb").alias("mc"), tot.cast("string").alias("v")),
                   F.struct(F.lit("free_mb").alias("mc"), free.cast("string").alias("v")))
    dg = (_read(spark, sf_dir, "supplier")
          .select(F.concat(F.lit("+ASM_"), _lp(s)).alias("target_name"),
                  F.concat(F.lit("DG"), s.cast("string")).alias("key_value"),
                  F.explode(rows).alias("r"))
          .select("target_name", F.lit("DiskGroup_Usage").alias("metric_name"),
                  F.col("r.mc").alias("metric_column"), "key_value", F.col("r.v").alias("value")))
    return conform(cpu.unionByName(dg), CURRENT_SCHEMA)


def tablespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    b = _part_db("p_partkey")
    k = F.col("p_partkey")
    size = F.when(k % 97 == 96, F.lit(0).cast("bigint")).otherwise(F.lit(5000).cast("bigint") * 1048576)
    factor = F.when(b % 3 == 0, 60).when(b % 3 == 1, 88).otherwise(100)
    used = (size * F.col("p_size") * factor / 5000).cast("bigint")
    out = part.select(db_of(b).alias("target_name"), host_of(b).alias("host_name"),
                      F.concat(F.lit("TS"), _lp(k, 6)).alias("tablespace_name"),
                      F.lit("ONLINE").alias("status"), F.lit("PERMANENT").alias("contents"),
                      size.alias("tablespace_size"), used.alias("tablespace_used_size"),
                      as_of_literal(TABLESPACE_TS).alias("collection_timestamp"))
    return conform(out, TABLESPACE_SCHEMA)


class TestTables:
    """The five relations for one scale-factor folder, each built on first
    use (a report that needs two relations never plans the other three)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def targets(self) -> DataFrame:
        return targets(self.spark, self.sf_dir)

    @cached_property
    def hourly(self) -> DataFrame:
        return hourly(self.spark, self.sf_dir)

    @cached_property
    def daily(self) -> DataFrame:
        return daily(self.spark, self.sf_dir)

    @cached_property
    def current(self) -> DataFrame:
        return current(self.spark, self.sf_dir)

    @cached_property
    def tablespaces(self) -> DataFrame:
        return tablespaces(self.spark, self.sf_dir)


def load(spark: SparkSession, sf_dir: str) -> TestTables:
    """The relations of ``sf_dir``, lazily."""
    return TestTables(spark, sf_dir)
