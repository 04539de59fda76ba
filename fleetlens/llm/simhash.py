"""SimHash near-duplicates, linked through BK-trees.

A text's fingerprint has a bit set where more than half of its shingles'
hashes have it set.  Fingerprints at most ``max_bits`` bits apart are linked;
documents that links connect form one component.

Two fingerprints within ``max_bits`` differ in that many of ``BLOCKS`` blocks
at most, so they agree on some choice of ``BLOCKS - max_bits`` blocks.  Each
choice, with the bits it agrees on, names a shard; every linked pair meets in
a shard.  A shard's fingerprints form a BK-tree whose children are keyed by
their distance to the parent, and a search follows the edges within the radius
alone.  A shard tree is sent to the tasks that search it by a shuffle: to
broadcast all trees from the driver would collect every fingerprint there.
Shards of more than ``PIECE`` fingerprints are cut into pieces, each a tree of
its own that all fingerprints of the shard search, in separate tasks.

Defined results: NULL and empty texts have fingerprint zero and are linked
like any other; equal fingerprints are one node of the graph, whatever the
number of copies; a NULL id forms a component by itself and links nothing.
Rows that share an id but not the text are documents of their own: each belongs
to its own fingerprint's component, and the id links nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded_batches, free_name, write_shared
from fleetlens.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
BLOCKS = 5  # for 3 bits: ten shard keys of 25 or 26 bits per fingerprint
PIECE = 2048  # fingerprints of a tree


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text."""
    words = text.lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[width - 1:].tolist() if len(words) >= width else [len(flat)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        set_bits += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc: Column, text: Column, width: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, text_hash`` (the 64 bits as a signed long), one row per
    document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pc.fill_null(b.column(1), "").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2)],
                                             ["doc_id", "fp", "text_hash"])

    return (bounded_batches(docs).select(doc.cast("bigint").alias("doc_id"), text.cast("string").alias("text"),
                                         F.xxhash64(text.cast("string")).alias("text_hash"))
            .mapInArrow(run, "doc_id bigint, fp bigint, text_hash bigint"))


class BKTree:
    """A BK-tree over distinct 64-bit values, built and searched level by
    level for many values at once."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        # every value starts at the root and moves down along the edge of its
        # distance; the first to ask for a missing edge becomes that child
        here, left = np.zeros(n, np.int64), np.arange(1, n)
        while len(left):
            d = np.bitwise_count(values[left] ^ values[here[left]]).astype(np.int64)
            slot = here[left] * 65 + d
            _, first, inverse = np.unique(slot, return_index=True, return_inverse=True)
            child = left[first]
            parent[child], edge[child] = here[child], d[first]
            here[left] = child[inverse]
            settled = np.zeros(len(left), bool)
            settled[first] = True
            left = left[~settled]
        # children of a node lie side by side, ordered by their edge
        key = parent[1:] * 65 + edge[1:]
        order = np.argsort(key, kind="stable")
        self.child, self.key = order + 1, key[order]

    def search(self, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (number of the searched value, number of the tree's value)
        within ``radius``, by levels."""
        who, node = np.arange(len(values)), np.zeros(len(values), np.int64)
        while len(who):
            d = np.bitwise_count(values[who] ^ self.values[node]).astype(np.int64)
            hit = d <= radius
            yield who[hit], node[hit]
            lo = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right")
            count = hi - lo
            at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
            who, node = np.repeat(who, count), self.child[at]


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def links_within(tree: np.ndarray, seekers: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the tree and its seekers connect: a forest, so
    at most one link per value.  ``tree`` and ``seekers`` hold values; the
    result holds numbers into their concatenation."""
    parent = list(range(len(tree) + len(seekers)))
    out = []
    bk = BKTree(tree)
    for a in range(0, len(seekers), 1024):
        for who, node in bk.search(seekers[a:a + 1024], radius):
            for i, j in zip((who + a + len(tree)).tolist(), node.tolist()):
                x, y = _root(parent, i), _root(parent, j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((i, j))
    return out


def shard_keys(fp: Column, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> Column:
    """One (choice of blocks, agreeing bits) struct per choice."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = []
    for choice in combinations(range(blocks), blocks - max_bits):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in choice)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m).cast("bigint")).alias("bits"))
                     for i, m in enumerate(masks)])


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a, b`` between nodes (``node`` BIGINT, ``fp`` distinct) that
    connect all nodes whose fingerprints are within ``max_bits``."""
    placed = nodes.select("node", "fp", F.explode(shard_keys(F.col("fp"), max_bits, blocks)).alias("s")).select(
        "s.choice", "s.bits", "node", "fp")
    sizes = placed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # nodes alone in a shard have nothing to search; large shards are cut into
    # pieces: a node is stored in one piece and searches that one and those before
    held = placed.join(sizes, ["choice", "bits"])
    pieces = F.ceil(F.col("n") / PIECE).cast("int")
    own = F.pmod(F.xxhash64("fp"), pieces).cast("int")
    routed = held.withColumn("own", own).select(
        "choice", "bits", "node", "fp", "own", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece")).where(
        "piece <= own")
    groups = routed.groupBy("choice", "bits", "piece")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        node, fp = table["node"].to_numpy(), table["fp"].to_numpy().view(np.uint64)
        stored = table["own"].to_numpy() == table["piece"].to_numpy()
        a, b = _forest(node, fp, stored)
        yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    def _forest(node, fp, stored):
        order = np.argsort(~stored, kind="stable")
        node, fp, n = node[order], fp[order], int(stored.sum())
        pairs = links_within(fp[:n], fp, max_bits) if n else []
        left = [(node[i - n], node[j]) for i, j in pairs if i - n != j]
        return pa.array([x for x, _ in left], pa.int64()), pa.array([y for _, y in left], pa.int64())

    return groups.applyInArrow(link, "a bigint, b bigint")


def _classes(docs: DataFrame, doc_col: str, text_col: str, width: int, max_bits: int) -> DataFrame:
    """``doc_id, fp, text_hash, root, component_id``, one row per document;
    ``root`` (the smallest fingerprint) names the component, also where two
    components hold documents with the same smallest id."""
    fps = write_shared(fingerprints(docs, F.col(doc_col), F.col(text_col), width), "simhash")
    nodes = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(fingerprint_links(nodes.select(F.col("fp").alias("node"), "fp"), max_bits), "simhash-cc")
    placed = (nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first", F.coalesce("component", "fp").alias("root")))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.join(smallest, "root").select("fp", "root", "component_id")
    nameless = F.col("doc_id").isNull()
    return fps.join(classes, "fp", "left").select(
        "doc_id", "fp", "text_hash", F.when(~nameless, F.col("root")).alias("root"),
        F.when(~nameless, F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", *, width: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document."""
    return _classes(docs, doc_col, text_col, width, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", *, width: int = SHINGLE,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """The first document of each component (smallest id, of texts that share
    it the one with the smallest fingerprint, then hash), once, with its
    columns unchanged.  Of rows equal in id and text one stays; rows without an
    id all stay."""
    found = _classes(docs, doc_col, text_col, width, max_bits).where("doc_id is not null")
    text_hash = free_name(docs, "_text_hash")
    key = [doc_col, text_hash]
    names = [F.col("doc_id").alias(doc_col), F.col("text_hash").alias(text_hash)]
    firsts = (found.groupBy("root").agg(F.min(F.struct("doc_id", "fp", "text_hash")).alias("f"))
              .select("f.*").select(*names))
    firsts = write_shared(firsts, "simhash-firsts")
    hashed = docs.withColumn(text_hash, F.xxhash64(F.col(text_col).cast("string")))
    # the keys are hashed, so the texts need not be sorted to meet them
    kept = hashed.join(firsts.hint("shuffle_hash"), key, "left_semi")
    repeated = (found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*names))
    if not repeated.isEmpty():  # else no row is held back to be compared with others
        repeated = write_shared(repeated, "simhash-repeated")
        kept = kept.join(repeated, key, "left_anti").unionByName(
            kept.join(repeated, key, "left_semi").dropDuplicates(key))
    return kept.drop(text_hash).unionByName(docs.where(F.col(doc_col).isNull()))
