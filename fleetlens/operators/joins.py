"""Joins between the metric facts and the target dimension.

No side is broadcast by hint: Catalyst broadcasts a side whose estimated size
in bytes is below ``spark.sql.autoBroadcastJoinThreshold``, the adaptive plan
one whose measured size is; beyond it the join shuffles on its key, and the
adaptive plan splits a skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.filters import type_in_filter


def distinct_hosts(hosts: DataFrame) -> DataFrame:
    return hosts.select("target_name").distinct()


def fleet_semi_join(facts: DataFrame, hosts: DataFrame) -> DataFrame:
    """Keep fact rows of fleet hosts.  A semi join never repeats a fact
    row, so it equals the join to a DISTINCT host list."""
    return facts.join(hosts.select("target_name"), "target_name", "left_semi")


def fleet_inner_join(facts: DataFrame, hosts: DataFrame) -> DataFrame:
    """Facts with the host's OS; a host listed twice repeats its rows."""
    return facts.join(hosts.select("target_name", "os_type"), "target_name")


def two_key_join(facts: DataFrame, targets: DataFrame) -> DataFrame:
    return facts.join(targets, ["target_name", "target_type"])


def latest_left_join(hosts: DataFrame, latest: DataFrame) -> DataFrame:
    """Every host, with its latest reading when it has one."""
    return hosts.join(latest, "target_name", "left")


def self_join_hosts(targets: DataFrame, db_types, os_list) -> DataFrame:
    """Database targets joined to the host they run on (``os_list`` None: of
    any OS)."""
    db = type_in_filter(targets, "target_type", db_types).select(
        F.col("target_name").alias("database_name"),
        F.col("type_qualifier1").alias("database_version"),
        F.col("host_name").alias("db_host"))
    of_os = F.lit(True) if os_list is None else F.col("type_qualifier1").isin(list(os_list))
    os_ = targets.where((F.col("target_type") == "host") & of_os).select(
        F.col("target_name").alias("server"), F.col("type_qualifier1").alias("os"),
        F.col("type_qualifier2").alias("os_version"))
    return (db.join(os_, F.col("db_host") == F.col("server"))
            .select("database_name", "database_version", "server", "os", "os_version"))


def instances(targets: DataFrame) -> DataFrame:
    """Disk-group instances and the host each runs on."""
    return targets.where(F.col("target_type") == "osm_instance").select(
        "target_name", F.col("host_name").alias("instance_host"))


def instance_join(current: DataFrame, targets: DataFrame) -> DataFrame:
    """Current metrics of disk-group instances, with the instance's host."""
    return current.join(instances(targets), "target_name")


def in_inventory(facts: DataFrame, inventory: DataFrame, fact_key: str, inventory_key: str = "server") -> DataFrame:
    """Facts of inventory members, each once: the cut that comes before an
    aggregate, so that nothing outside the inventory is folded or converted."""
    keys = inventory.select(F.col(inventory_key).alias(fact_key))
    return facts.join(keys, fact_key, "left_semi")


def inventory_join(facts: DataFrame, inventory: DataFrame, fact_key: str,
                   inventory_key: str = "server") -> DataFrame:
    """One set-based join in place of one statement per inventory row.  Each
    inventory row that matches repeats the fact rows, as the per-row loop
    printed them once per database."""
    return facts.join(inventory, facts[fact_key] == inventory[inventory_key])
