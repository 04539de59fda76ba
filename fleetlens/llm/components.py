"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import drop_shared, write_shared


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node of each neighbourhood.

    Large star: every larger neighbour of ``a`` gets an edge to the smallest
    node around ``a``.  Small star: the same for ``a`` and its smaller
    neighbours.  A node with very many neighbours is one partial row per task
    in the aggregate and a join key that the adaptive join splits.
    """
    around = _both_ways(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = around.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return out.where("a <> b").distinct()


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b`` BIGINT);
    the component is the smallest node that can be reached.

    Large-star and small-star rounds alternate until no edge changes; then
    each node hangs on its component's smallest one.  Every round is written
    to the shared folder, so a lost executor costs one round at most.
    """
    clean = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = write_shared(clean, name)
    mark = None
    while True:
        new = write_shared(_star(_star(now, True), False), name)
        drop_shared(now)
        now = new
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
