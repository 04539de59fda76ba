"""Folders of written datasets, by the file system that holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none if it is absent)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.delete(p, True)


def modified_ms(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """The folder of one partition value, as Spark names it."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={utils.escapePathName(value)}"
