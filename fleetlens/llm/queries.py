"""Queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (alignment, chat, chunking, fertility, hard_negatives, lang_crf, lines, lm, mixing,
                           neighbours, packing, simhash, token_files)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, F.col("id") % 100 == 0)


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fertility.fertility_signals(docs, keep=["doc_id"]).select("_row.doc_id", "signals.*")


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.repeated_passages(_table(spark, sf_dir, "documents"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, keep=["doc_id"]).select(
        "_row.doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read_back(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lines.remove_boilerplate(docs, keep=["doc_id"]).select("_row.doc_id", "text", "n_lines", "n_removed")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


# A conversation whose texts are made of control strings.
_CONTROLS = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", _CONTROLS), (-7, 1, "assistant", _CONTROLS)],
                                "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_conversations(turns.unionByName(own)))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # a document without an id is learned from
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = lang_crf.fit(docs, "text", F.col("lang"), ~held_out)
    found = lang_crf.predict(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])
    return found.select("_row.doc_id", "_row.held_out", "language.lang_pred", "language.score", "language.n_words",
                        F.size("language.spans").alias("n_spans"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, label=label)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_corpus(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_neighbours": op1_neighbours,
        "op2_fertility": op2_fertility,
        "op3_chunk_dedup": op3_chunk_dedup,
        "op4_lm": op4_lm,
        "op5_mixing": op5_mixing,
        "op6_packing": op6_packing,
        "op7_token_files": op7_token_files,
        "op8_line_dedup": op8_line_dedup,
        "op9_simhash": op9_simhash,
        "op10_chat": op10_chat,
        "op11_language": op11_language,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": lines.ORACLE.format(min_sites=lines.MIN_SITES),
            "op12_hard_negatives": hard_negatives.ORACLE}
