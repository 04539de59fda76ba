"""Approximate nearest neighbours: NN-descent builds a neighbour graph by
Spark joins, a greedy search walks it.

Building: equal vectors are one node.  The nearest nodes within blocks of
several orders are first neighbours: random orders, and orders by the sides of
random planes that the vectors lie on, which bring close vectors together.
Then rounds: every node gathers its neighbours, some nodes it is
a neighbour of, and their vectors; among these neighbours of neighbours, each
pair with a new edge is compared, and who is nearer than a node's farthest
neighbour becomes its neighbour.  Rounds end when few edges change.

Searching: a query starts from its own node, which is in the graph, and from
its nearest pivots.  Again and again, it looks at the neighbours of its nearest
nodes that it has not yet looked from, until its ``BEAM`` nearest nodes are all
looked from.  A few random long edges per node, kept apart from the nearest
ones, join the parts that a graph of close groups falls into.  Distances that count are
Euclidean, in double precision, on the original vectors.

The pivots are all that is broadcast: ``PIVOTS`` vectors, or twice the square
root of the number of nodes where that is more.  The sample of
reverse neighbours (``REVERSE`` of each node) and the beam are what makes the
search approximate; recall is measured against brute force in the tests.

Defined results: vectors that are NULL, zero, hold NULL or non-finite
components, or differ in length from most others take no part, as rows without
an id do; repeated rows count as one; a query finds every row but itself,
equal vectors in the order of their ids; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded_batches, drop_shared, write_shared

DEGREE = 24
REVERSE = 24
OFFERS = 8  # candidates that one local comparison offers to each node
ROUNDS = 10
FEW = 0.02  # of all edges changed: the last round
PIVOTS = 256  # at least; they grow with the square root of the table
BLOCK = 64  # nodes compared with each other for the first neighbours
ORDERS = 3  # random orders that blocks are cut from, and as many by planes
PLANES = 24  # sides of random planes that an order goes by
LONG = 3  # random orders whose next nodes are long edges of the search
BEAM = 320
LOOKS = 80  # nodes a query looks from in one step
REMEMBERED = 4  # beams of nodes that a query keeps the distance of
STARTS = 16

_EDGES = "node bigint, nbr bigint, dist float, fresh boolean"


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays, in double precision."""
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part, each once."""
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    good = rows.select(F.col(id_col).cast("bigint").alias("id"), vec.cast("array<float>").alias("vec")).where(
        F.col(id_col).isNotNull() & vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0))
    common = good.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(
        F.col("rows").desc(), "n").first()
    return good.where(F.size("vec") == (common["n"] if common else 0)).distinct()


def _matrix(vectors: pa.Array) -> np.ndarray:
    """A list array of equally long vectors as a matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.maximum(d, 0)


def _edge_batch(node, nbr, dist) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node, pa.int64()), pa.array(nbr, pa.int64()), pa.array(dist, pa.float32()),
         pa.array(np.ones(len(node), bool))], ["node", "nbr", "dist", "fresh"])


def by_planes(nodes: DataFrame, seed: int) -> DataFrame:
    """``node, vec, at``: ``at`` has one bit for each of ``PLANES`` random
    planes, the side of it that the vector lies on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1)).astype(np.float64)
            if not len(x):
                continue
            planes = np.random.default_rng(seed).standard_normal((x.shape[1], PLANES))
            at = ((x @ planes) > 0) @ (1 << np.arange(PLANES, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64())], ["node", "vec", "at"])

    return nodes.select("node", "vec").mapInArrow(run, "node bigint, vec array<float>, at bigint")


def first_edges(nodes: DataFrame, degree: int, orders: int = ORDERS) -> DataFrame:
    """First neighbours: the nearest within blocks of nodes.  Every node lies
    in a block of each of several random orders, so the blocks hang together
    and a better neighbour can be reached from any of them; and in a block of
    as many orders by planes, where close vectors meet however many nodes
    there are."""
    k_each = -(-degree // orders)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x = b.column(0).to_numpy(), _matrix(b.column(1))
            for lo in range(0, len(ids), BLOCK):
                # a short last block reaches back, so that it is not alone
                a = max(0, min(lo, len(ids) - BLOCK))
                own, part = ids[a:lo + BLOCK], x[a:lo + BLOCK]
                d = _squares(part, part)
                np.fill_diagonal(d, np.inf)
                k = min(k_each, len(own) - 1)
                if k > 0:
                    near = np.argpartition(d, k - 1, axis=1)[:, :k]
                    yield _edge_batch(np.repeat(own, k), own[near].ravel(), np.sqrt(np.take_along_axis(d, near, 1)).ravel())

    found = []
    keyed = [nodes.select("node", "vec", F.xxhash64(F.lit(t), "node").alias("at")) for t in range(orders)]
    for order in [*keyed, *(by_planes(nodes, t) for t in range(orders))]:
        ordered = order.repartitionByRange("at", "node").sortWithinPartitions("at", "node")
        found.append(ordered.select("node", "vec").mapInArrow(compare, _EDGES))
    return reduce(DataFrame.unionByName, found)


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest distinct neighbours of each node; an edge that
    was there before is not fresh."""
    once = edges.groupBy("node", "nbr").agg(F.min("dist").alias("dist"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("dist", "nbr"))
    return once.withColumn("_rank", rank).where(F.col("_rank") <= degree).drop("_rank")


def with_reverse(edges: DataFrame, sample: int) -> DataFrame:
    """Edges in both directions; of the reverse ones, a random ``sample`` per
    node, fresh ones first."""
    back = edges.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "dist", "fresh")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("fresh").desc(), F.xxhash64("node", "nbr")))
    back = back.withColumn("_rank", rank).where(F.col("_rank") <= sample).drop("_rank")
    return (edges.unionByName(back).groupBy("node", "nbr")
            .agg(F.min("dist").alias("dist"), F.max("fresh").alias("fresh")))


def compare_around(edges: DataFrame, nodes: DataFrame, sample: int = REVERSE, offers: int = OFFERS) -> DataFrame:
    """One round's join of neighbours of neighbours: edges that are better
    than those their nodes have."""
    worst = edges.groupBy("node").agg(F.max("dist").alias("worst"))
    known = nodes.join(worst, "node").select(F.col("node").alias("nbr"), "vec", "worst")
    around = with_reverse(edges, sample).select("node", "nbr", "fresh").join(known, "nbr")
    gathered = around.groupBy("node").agg(F.collect_list(F.struct("nbr", "fresh", "worst", "vec")).alias("around"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            ids, fresh, limit = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            x = _matrix(flat.field(3))
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            out: list[tuple] = []
            for a, b in zip(at, at[1:]):
                d = np.sqrt(_squares(x[a:b], x[a:b]))
                useful = (fresh[a:b, None] | fresh[None, a:b]) & (d < limit[a:b, None])
                np.fill_diagonal(useful, False)
                d[~useful] = np.inf
                k = min(offers, b - a - 1)
                if k < 1:
                    continue
                near = np.argpartition(d, k - 1, axis=1)[:, :k]
                dist = np.take_along_axis(d, near, 1)
                who, which = np.nonzero(np.isfinite(dist))
                out.append((ids[a:b][who], ids[a:b][near[who, which]], dist[who, which]))
            if out:
                yield _edge_batch(*(np.concatenate(c) for c in zip(*out)))

    return gathered.select("around").mapInArrow(run, _EDGES)


def build_graph(nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """``node, nbr, dist, fresh``: about the ``degree`` nearest neighbours of
    each node (``node, vec``)."""
    edges = write_shared(_nearest(first_edges(nodes, degree), degree), "knn")
    total = edges.count()
    for _ in range(rounds):
        old = edges.withColumn("fresh", F.lit(False))
        new = write_shared(_nearest(old.unionByName(compare_around(edges, nodes)), degree), "knn")
        drop_shared(edges)
        edges = new
        if edges.where("fresh").count() <= FEW * total:
            break
    return edges


def long_edges(nodes: DataFrame, orders: int = LONG) -> DataFrame:
    """``node, nbr``: each node's next one in several random orders, in both
    directions.  Only ids move."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros(0, np.int64)
        for b in batches:
            ids = np.concatenate([last, b.column(0).to_numpy()])
            a, z, last = ids[:-1], ids[1:], ids[-1:]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, z])), pa.array(np.concatenate([z, a]))],
                                             ["node", "nbr"])

    found = []
    for t in range(orders):
        at = F.xxhash64(F.lit(orders + t), F.lit("long"), "node")
        ordered = nodes.select("node", at.alias("at")).repartitionByRange("at", "node").sortWithinPartitions("at", "node")
        found.append(ordered.select("node").mapInArrow(run, "node bigint, nbr bigint"))
    return reduce(DataFrame.unionByName, found)


def _beam(seen: DataFrame, width: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy("dist", "node"))
    return seen.withColumn("_rank", rank).where(F.col("_rank") <= width).drop("_rank")


def nearest_pivots(queries: DataFrame, ids: np.ndarray, pivots: np.ndarray, starts: int = STARTS) -> DataFrame:
    """``query, node, dist``: the pivots that each query starts from."""
    k, wide = min(starts, len(ids)), pivots.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1)).astype(np.float64)
            if not len(x):
                continue
            near = np.argsort(_squares(x, wide), axis=1, kind="stable")[:, :k]
            d = np.sqrt(((x[:, None, :] - wide[near]) ** 2).sum(2))  # as exact as every distance that counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), k)), pa.array(ids[near].ravel()), pa.array(d.ravel())],
                ["query", "node", "dist"])

    return queries.mapInArrow(run, "query bigint, node bigint, dist double")


def greedy_search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, start: DataFrame, beam: int = BEAM) -> DataFrame:
    """``query, node, dist``: the nodes nearest to each query (``query, vec``)
    that a walk over the graph finds from its ``start`` (``query, node,
    dist``)."""
    seen = write_shared(start.withColumn("looked", F.lit(False)), "walk")
    near = with_reverse(edges, REVERSE).select("node", "nbr")
    links = write_shared(near.unionByName(long_edges(nodes)), "links")
    while True:
        near = _beam(seen, beam).where(~F.col("looked"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy("dist", "node"))
        looking = write_shared(near.withColumn("_rank", rank).where(F.col("_rank") <= LOOKS).select("query", "node"), "walk")
        if looking.isEmpty():
            break
        found = (looking.join(links, "node").select("query", F.col("nbr").alias("node")).distinct()
                 .join(seen.select("query", "node"), ["query", "node"], "left_anti"))
        scored = (found.join(nodes.withColumnRenamed("vec", "nv"), "node").join(queries, "query")
                  .select("query", "node", distance(F.col("vec"), F.col("nv")).alias("dist"), F.lit(False).alias("looked")))
        marked = (seen.join(looking.withColumn("now", F.lit(True)), ["query", "node"], "left")
                  .select("query", "node", "dist", (F.col("looked") | F.coalesce("now", F.lit(False))).alias("looked")))
        # a node that is not among the nearest now never will be: it may be
        # forgotten, and if it is found again it is only measured again
        new = write_shared(_beam(marked.unionByName(scored), REMEMBERED * beam), "walk")
        drop_shared(seen)
        drop_shared(looking)
        seen = new
    return seen.select("query", "node", "dist")


def nearest(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", *,
            degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows nearest to each row
    that ``is_query`` (a condition on ``id``) holds for, itself left out."""
    bounded_batches(rows)
    usable = write_shared(usable_vectors(rows, id_col, vec_col), "vectors")
    nodes = write_shared(usable.groupBy("vec").agg(F.min("id").alias("node")).select("node", "vec"), "nodes")
    n_pivots = max(PIVOTS, 2 * isqrt(nodes.count()))
    pivots = write_shared(nodes.orderBy(F.xxhash64("node")).limit(n_pivots), "pivots")
    chosen = pivots.collect()  # n_pivots rows at most
    ids = np.array([r["node"] for r in chosen], np.int64)
    matrix = np.array([r["vec"] for r in chosen], np.float32)
    at_home = write_shared(usable.where(is_query).join(nodes, "vec").select(F.col("id").alias("query"), "vec", "node"),
                           "queries")
    queries = at_home.select("query", "vec")
    if not len(matrix):
        return usable.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                             F.lit(0.0).alias("score")).where("false")
    edges = build_graph(nodes, degree)
    own = at_home.select("query", "node", F.lit(0.0).alias("dist"))
    start = (nearest_pivots(queries, ids, matrix).unionByName(own).groupBy("query", "node")
             .agg(F.min("dist").alias("dist")))
    found = _beam(greedy_search(queries, nodes, edges, start, max(beam, k + 1)), max(beam, k + 1))
    # of equal vectors, the k + 1 smallest ids are all that a query can need
    rank = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    members = (usable.join(nodes, "vec").select("node", "id").withColumn("_rank", rank)
               .where(F.col("_rank") <= k + 1).select("node", "id"))
    by = Window.partitionBy("query").orderBy("dist", "id")
    return (found.join(members, "node").where("id <> query")
            .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), F.col("dist").alias("score")))
