"""NN-descent and greedy search: recall against brute force."""

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import neighbours


def brute(ids, x, query, k):
    d = np.sqrt(((x - x[ids.index(query)]) ** 2).sum(1))
    order = sorted((float(v), i) for v, i in zip(d, ids) if i != query)
    return order[:k]


def test_recall_and_scores(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    table = {r["vec_id"]: r["embedding"] for r in rows.collect()}
    ids, x = list(table), np.array(list(table.values()), np.float32).astype(np.float64)
    got = neighbours.nearest(rows, F.col("id") % 20 == 0).collect()
    hits = total = 0
    for q in [i for i in ids if i % 20 == 0]:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        want = brute(ids, x, q, 10)
        assert [m[0] for m in mine] == list(range(1, 11))
        exact = {i: v for v, i in brute(ids, x, q, len(ids))}
        assert all(abs(v - exact[i]) < 1e-12 for _, i, v in mine)
        hits += len({m[1] for m in mine} & {i for _, i in want})
        total += len(want)
    assert hits >= 0.9 * total


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).tolist(), 0, "x") for i in range(60)]
    rows += [(100 + i, [1.0] * 8, 0, "x") for i in range(30)]  # copies: ties go to smaller ids
    rows += [(200, None, 0, "x"), (300, [0.0] * 8, 0, "x"), (400, [1.0, None] * 4, 0, "x"),
             (500, [float("nan")] * 8, 0, "x"), (600, [float("inf")] * 8, 0, "x"), (700, [1.0, 2.0], 0, "x"),
             (None, [2.0] * 8, 0, "x"), (0, rows[0][1], 0, "x")]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int, vec string")
    got = neighbours.nearest(docs, F.col("id") % 100 == 0).collect()
    by = {q: sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q) for q in (0, 100)}
    assert {r["query_id"] for r in got} == {0, 100}
    assert [(i, s) for _, i, s in by[100]] == [(101 + i, 0.0) for i in range(10)]
    table = {r[0]: np.array(r[1], np.float32).astype(float) for r in rows if r[0] is not None and (r[0] < 200)}
    want = brute(list(table), np.array(list(table.values())), 0, 10)
    assert [i for _, i, _ in by[0]] == [i for _, i in want]
    few = docs.where("vec_id in (0, 1, 2)")
    assert neighbours.nearest(few, F.col("id") == 0).count() == 2
    assert neighbours.nearest(docs.where("false"), F.col("id") == 0).count() == 0
    assert neighbours.nearest(docs.where("vec_id = 0"), F.col("id") == 0).count() == 0


def test_every_group_of_close_vectors_is_reached(spark):
    # many more groups than pivots: a query must find the group of its own
    rng = np.random.default_rng(3)
    x = (np.repeat(rng.standard_normal((200, 16)), 30, axis=0) + 0.02 * rng.standard_normal((6000, 16))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.nearest(rows, F.col("id") % 30 == 0).collect()
    ids, x = list(range(6000)), x.astype(np.float64)
    hits = sum(r["vec_id"] in {i for _, i in brute(ids, x, r["query_id"], 10)} for r in got)
    assert len(got) == 2000 and hits >= 0.98 * len(got)
