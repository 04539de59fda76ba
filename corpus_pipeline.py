"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; what it decides takes effect.  All but the last return the
columns of ``documents``; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import fertility, lines, mixing, packing, simhash
from fleetlens.llm.common import write_shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tokeniser-fertility rules reject go."""
    return fertility.keep_fluent(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, but for their first occurrence; documents stay,
    with ``text`` and ``n_chars`` as they are afterwards."""
    cleaned = lines.remove_boilerplate(docs, keep=[c for c in docs.columns if c not in ("text", "n_chars")])
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cleaned.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their token ids: the sequences
    are the ids of one ``sequence_id`` in the order of ``offset``."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# Tokenisers, hashes of shingles and packing are not expressible in SQL; the
# stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_shared(docs, f"pipeline-{name}")
    return docs
