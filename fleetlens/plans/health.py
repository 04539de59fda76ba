"""The database health reports: inventory, disk groups, tablespaces,
current host CPU and (in growth.py) monthly database growth.

The repository script runs one statement per inventory row.  Here each
section is one set-based join with the inventory; a host that carries two
databases appears once per database, as the per-row loop printed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import classify as C
from fleetlens.functions.numbers import as_double, text_to_number
from fleetlens.functions.text import number_plain
from fleetlens.operators.aggregates import conditional_count, ordered_list, pivot_max
from fleetlens.operators.filters import metric_filter, type_in_filter
from fleetlens.operators.joins import in_inventory, instance_join, instances, inventory_join
from fleetlens.params import DISKGROUP_COLUMNS
from fleetlens.plans.context import ReportRun


def db_host_inventory(run: ReportRun, os_list=None) -> DataFrame:
    """Databases and the host each runs on, for hosts of the given OS
    values (exact, case-sensitive match)."""
    return run.inventory(tuple(run.p.os_list if os_list is None else os_list))


def db_host_inventory_sorted(run: ReportRun, os_list=None) -> DataFrame:
    """The inventory ordered by OS and database name, as the per-OS, per-row
    loop over it printed every section."""
    return db_host_inventory(run, os_list).orderBy("os", "database_name")


def _members(run: ReportRun, os_list, key: str = "server") -> DataFrame:
    return run.members(run.p.os_list if os_list is None else os_list, key)


def asm_diskgroup_usage(run: ReportRun, os_list=("Linux",), strict: bool = True) -> DataFrame:
    """Disk groups of the instances on each inventory server: total and
    free GB, used %, status on the integer-rounded used %.  Instances outside
    the inventory are cut first; then the three metric rows of a group are
    folded to one row before the joins that repeat it."""
    p = run.p
    inv = _members(run, os_list)
    cur = type_in_filter(run.t.current.where(F.col("metric_name") == "DiskGroup_Usage"), "metric_column",
                         DISKGROUP_COLUMNS)
    inst = in_inventory(instances(run.t.targets), inv, "instance_host")
    cur = in_inventory(cur, inst, "target_name", "target_name")
    groups = pivot_max(cur, ["target_name", "key_value"], "metric_column", text_to_number("value", strict),
                       DISKGROUP_COLUMNS)
    rows = inventory_join(instance_join(groups, run.t.targets), inv, "instance_host")
    return run.ordered(rows.select(
        "database_name", "server", "os", "target_name", F.col("key_value").alias("diskgroup"),
        as_double(F.round(F.col("total_mb") / 1024, 2)).alias("total_gb"),
        as_double(F.round(F.col("free_mb") / 1024, 2)).alias("free_gb"),
        as_double(F.round("percent_used", 2)).alias("used_pct"),
        C.asm_status(F.round("percent_used", 0), p.health_critical, p.health_warn).alias("status"),
    ), "os", "database_name", "target_name", "diskgroup")


def asm_not_applicable(run: ReportRun, os_list=("AIX",)) -> DataFrame:
    """The disk-group section of an AIX report is one fixed row per OS value of
    ``os_list``, whether the inventory has databases there or not."""
    inv = db_host_inventory(run, tuple(os_list))
    names = F.array(*[F.lit(o) for o in os_list]) if os_list else F.array().cast("array<string>")
    return (inv.agg(F.count(F.lit(1)).alias("databases"))
            .select(F.explode(names).alias("os"), F.lit(C.ASM_NOT_APPLICABLE_TEXT).alias("status")))


def tablespace_usage(tablespaces: DataFrame) -> DataFrame:
    """Sizes in MB and used percent, 2 places, on exact decimals; zero-size
    rows are dropped."""
    used = F.col("tablespace_used_size").cast("decimal(20,0)")
    size = F.col("tablespace_size").cast("decimal(20,0)")
    mb = F.lit(1048576)
    return tablespaces.where(F.col("tablespace_size") > 0).select(
        "target_name", "host_name", "tablespace_name", "status", "contents",
        F.round(used / mb, 2).alias("used_mb"), F.round(size / mb, 2).alias("total_mb"),
        F.round((size - used) / mb, 2).alias("free_mb"),
        F.round(used * 100 / size, 2).cast("decimal(18,2)").alias("used_percent"))


def tablespace_summary(tablespaces: DataFrame, cutoff) -> DataFrame:
    """Per database and host: count, peak and ordered list of the
    tablespaces at or above ``cutoff`` percent used."""
    pct = F.col("used_percent")
    hot = pct >= cutoff
    ts = tablespace_usage(tablespaces).withColumn(
        "item", F.when(hot, F.concat("tablespace_name", F.lit("("), number_plain(pct), F.lit("%)"))))
    return ts.groupBy("target_name", "host_name").agg(
        conditional_count(hot).alias("critical_tablespaces"),
        F.max(F.when(hot, pct)).alias("max_used"),
        ordered_list("item", "used_percent DESC, tablespace_name").alias("tablespace_list"))


def tablespace_attention(run: ReportRun, os_list=None) -> DataFrame:
    """Per inventory database: tablespaces at or above the cutoff, their
    peak, their list by used % descending, and a status."""
    p = run.p
    inv = _members(run, os_list, "database_name")
    own = in_inventory(run.t.tablespaces, inv, "target_name", "database_name")
    rows = inventory_join(tablespace_summary(own, p.tablespace_warn), inv, "target_name", "database_name")
    n = F.coalesce(F.col("critical_tablespaces"), F.lit(0))
    return run.ordered(rows.select(
        "database_name", "host_name", "server", "os", "critical_tablespaces",
        as_double("max_used").alias("max_used_pct"),
        F.when(n > 0, F.col("tablespace_list")).otherwise(F.lit(C.NO_TABLESPACE_TEXT))
        .alias("tablespace_list"),
        C.tablespace_status("max_used", p.tablespace_critical, p.tablespace_warn).alias("status"),
    ), "os", "database_name", "host_name")


def host_cpu_current(run: ReportRun, os_list=None, strict: bool = True) -> DataFrame:
    """Current CPU of each inventory server, one row per distinct value
    text; status tests the value rounded to an integer."""
    p = run.p
    inv = _members(run, os_list)
    cur = metric_filter(run.t.current, "Load", "cpuUtil").select(F.col("target_name").alias("cpu_target"), "value")
    rows = inventory_join(in_inventory(cur, inv, "cpu_target").distinct(), inv, "cpu_target")
    num = text_to_number("value", strict)
    return run.ordered(rows.select(
        "database_name", "server", "os",
        as_double(F.round(num, 2)).alias("cpu_pct"),
        C.host_cpu_status(F.round(num, 0), p.health_critical, p.health_warn).alias("status"),
    ), "os", "database_name", "server", "cpu_pct")
