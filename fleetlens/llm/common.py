"""Helpers shared by the operators: the word definition, tables written to
the cluster's shared folder, block counts and row pass-through."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import ensure_checkpoint_dir

# A word is a maximal run of anything but ASCII white space.  ``bytes.split()``
# without an argument splits UTF-8 text exactly there.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ROW = "_row"  # struct column that carries a row through an operator untouched


# Rows and bytes of one Arrow batch that a Python worker gets: what a worker
# holds at a time is a few times this, however long the texts are.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded_batches(df: DataFrame) -> DataFrame:
    """Bound the batches of the session's Arrow functions (never raise them)."""
    conf = df.sparkSession.conf
    for name, most in BATCH.items():
        now = conf.get(name, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= int(most):
            conf.set(name, most)
    return df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, seen by all executors."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-{name}-{uuid.uuid4().hex[:12]}"


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as parquet in the shared folder and
    read it back.  A lost executor loses nothing that was written; the shuffle
    files behind the table are not needed any more and go at once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_shared(df: DataFrame) -> None:
    """Delete the folder of a :func:`write_shared` table that no later step
    reads (the input of a finished iteration)."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/fleetlens-" in f:
            p = jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def blocks_for(docs: DataFrame, text_col: str, block_mb: int) -> int:
    """How many blocks of about ``block_mb`` MB of text the whole input makes,
    at least the session's shuffle partitions."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("bigint"))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (block_mb << 20)), 1)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def with_row(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """The columns to carry (all, or ``keep``) as one struct, so that no name
    of theirs can clash with an operator's own columns."""
    cols = docs.columns if keep is None else keep
    if not cols:
        return F.struct(F.lit(True).alias("_present")).alias(ROW)
    return F.struct(*[F.col(f"`{c}`") for c in cols]).alias(ROW)
