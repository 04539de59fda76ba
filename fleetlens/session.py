"""Session helpers.  On a cluster the session comes from the platform, which
these helpers leave as it is; local sessions and the driver's queries get the
settings below."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

REPORT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a fleet too large to broadcast still cuts the facts before their shuffle:
    # a Bloom filter of its names, up to 64 MB of them, on fact scans from 1 GB
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fleetlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("FLEETLENS_DRIVER_MEM", "8g")))
    for k, v in REPORT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_report_conf(spark: SparkSession) -> SparkSession:
    """Set the options above on a session that the caller hands over for it
    (the driver's queries)."""
    for k, v in REPORT_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.
    Only a local session without one gets a scratch folder: on a cluster a
    machine-local folder would be seen by one machine alone."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
