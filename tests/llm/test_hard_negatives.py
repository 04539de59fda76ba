"""Hard negatives against a plain version that scores every pair."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm import hard_negatives as H

ROWS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.IntegerType()), T.StructField("id", T.StringType()),
    T.StructField("v", T.StringType()), T.StructField("windows", T.StringType()), T.StructField("w", T.StringType()),
])


def plain(rows, every, positives=5, negatives=3):
    """All rows of the result, from scores of all pairs."""
    used = {}
    for i, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        used[(i, label, tuple(min(max(math.floor(256 * x), -H.LARGEST), H.LARGEST) for x in vec))] = True
    used = list(used)

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    out = []
    for a in used:
        if a[0] is None or a[0] % every:
            continue
        scored = [(score(a, b), b) for b in used if b != a]
        scored.sort(key=lambda s: (-s[0], s[1][0] is None, s[1][0] or 0))
        for p, b in [s for s in scored if s[1][1] == a[1]][:positives]:
            fit = [s for s in scored if s[1][1] != a[1] and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(a[0], b[0], r + 1, n[0], p, s) for r, (s, n) in enumerate(fit[:negatives])]
    return sorted(out, key=str)


def mined(spark, rows, every=5):
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], ROWS).repartition(4)
    got = H.mine(df, F.col("vec_id") % every == 0)
    return sorted([(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"],
                    r["negative_score"]) for r in got.collect()], key=str)


def some(n, dims=20, labels=4, seed=1, ids=None):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dims)) * np.linspace(2, 0.05, dims)
    return [(i if ids is None else ids[i], [float(x) for x in v], int(rng.integers(labels))) for i, v in enumerate(m)]


def test_equals_plain_version(spark):
    rows = some(400)
    assert mined(spark, rows) == plain(rows, 5) != []


def test_small_blocks_batches_and_panels_change_nothing(spark, monkeypatch):
    rows = some(300, dims=13, seed=2)
    whole = mined(spark, rows)
    monkeypatch.setattr(H, "BLOCK_ROWS", 37)
    monkeypatch.setattr(H, "GROUP_ANCHORS", 11)
    monkeypatch.setattr(H, "ROUNDS", 1)
    monkeypatch.setattr(H, "NEAR", (0.0,))
    assert mined(spark, rows) == whole == plain(rows, 5)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = some(60, dims=6, labels=3, seed=3)
    rows += [(100, None, 1), (105, [1.0, None, 2.0], 1), (110, [nan, 1.0], 1), (115, [1.0, inf], 2), (120, [], 1),
             (125, [0.0] * 6, 1), (130, [1.0, 0.5], 2), (135, [0.4] * 6, None), (None, [0.5] * 6, 1),
             (None, [0.25] * 6, 2), (140, [1e300, -1e300, 1.0], 1), (-5, [0.3] * 6, 0), (-10, [0.3] * 6, 0)]
    rows += [(145, [0.5, 0.4, 0.3, 0.2, 0.1, 0.6], 1)] * 4  # one row, repeated
    rows += [(150, [0.5, 0.4, 0.3, 0.2, 0.1, 0.6], 1), (150, [0.5, 0.4, 0.3, 0.2, 0.1, 0.6], 2)]  # one id, two rows
    rows += [(200 + i, [0.2] * 6, i % 3) for i in range(40)]  # ties
    got = mined(spark, rows)
    assert got == plain(rows, 5)
    assert {r[0] for r in got} >= {-5, 145, 150, 200}


def test_empty_and_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(5, [1.0], 1)]) == []


def test_index_leaves_dimensions_out_and_loses_nothing():
    rng = np.random.default_rng(4)
    m = np.floor(rng.normal(size=(500, 40)) * np.linspace(300, 1, 40))
    q = np.floor(rng.normal(size=(30, 40)) * np.linspace(300, 1, 40))
    norms = np.sqrt((q ** 2).sum(axis=1))
    least = np.ceil(norms * 700).astype(np.int64)
    index = H.InvertedIndex(m, 700.0)
    assert (index.cut < 40).mean() > 0.9 and sum(len(r) for r, _ in index.lists) < 0.9 * 500 * len(index.lists)
    x, y, s = index.at_least(q, least)
    exact = (m @ q.T).astype(np.int64)
    want = {(i, j, int(exact[i, j])) for i, j in zip(*np.nonzero(exact >= least))}
    assert {(int(a), int(b), int(c)) for a, b, c in zip(x, y, s)} == want and want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_the_test_tables(spark, sf):
    import duckdb
    from fleetlens.llm.queries import op12_hard_negatives
    table = duckdb.sql(f"select vec_id, embedding, label from '/root/testdata/{sf}/embeddings.parquet'").fetchall()
    rows = [(i, None if v is None else [*v], None if c is None else (c + 1) % 10 if i % 7 == 0 else c)
            for i, v, c in table]
    got = op12_hard_negatives(spark, f"/root/testdata/{sf}").collect()
    assert sorted([(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"],
                    r["negative_score"]) for r in got], key=str) == plain(rows, 50)
