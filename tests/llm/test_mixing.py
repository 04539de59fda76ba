"""Mixing against plain water filling, bounds and repeatability."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from fleetlens.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3 * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        open_ -= over or open_
    return target


def result(docs):
    return mixing.mix(docs).select("_row.doc_id", "_row.text", "source", "size", "source_size", "target", "copies")


def check(docs, near):
    rows = result(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == words(r["text"]) and 0 <= r["copies"] <= 3
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    target = plain_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) <= 1e-6 * max(1, target[r["source"]])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= near * largest[s] + 1e-6
    return sorted(map(str, rows))


def test_targets_and_taken_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # half the words of the last unsettled document is the largest error
    assert check(docs, 0.5) == check(docs.repartition(5), 0.5)


def test_odd_rows(odd, nothing):
    check(odd, 0.5)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_rows(nothing).count() == 0


def test_expected_copies_stay(spark):
    """Over many keys, documents of one size are taken as often as asked."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
                                    F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    rows = mixing.mix(docs).groupBy("source", "size").agg(F.avg("copies").alias("mean"), F.first("target").alias("t"),
                                                          F.first("source_size").alias("n")).collect()
    for r in rows:
        assert abs(r["mean"] - r["t"] / r["n"]) < 0.02


def test_rows_repeat(odd):
    mixed = mixing.mixed_rows(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == mixing.mix(odd).agg(F.sum("copies")).first()[0]


def test_many_equal_rows_land_on_the_target(spark, monkeypatch):
    """Rows equal in id, source and text are taken by their number."""
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 64)  # several chunks per key
    rows = [(None, "one two three four", s) for s in ("s1", "s2") for _ in range(1000)]
    rows += [(i, "w " * (i % 5 + 1), "s3") for i in range(700)] + [(7, "w w", "s3")] * 333 + [(8, None, "s3")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [check(docs.repartition(n), 0.5) for n in (1, 6)]
    assert got[0] == got[1]
    assert mixing.mixed_rows(docs).count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]


def test_native(sample):
    for docs in (sample, sample.unionByName(sample.limit(20))):
        plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
