"""Hard negatives by threshold joins over an inverted index.

An anchor's positives are its best rows of the same label; a positive's hard
negatives are the best rows of other labels inside a window below the
positive's score.  Both are found by joins "all rows that score at least t
with this anchor", repeated with lower thresholds until every window is full
or its lower end is reached.

One join deals the rows into blocks and the anchors into groups and works on
each (block, group) apart, in bounded memory:

- dimensions come in one order for the whole table, largest energy first, so
  the norm of what is left of a vector falls fast;
- a block's inverted index lists, per panel of dimensions, the rows and their
  values there; a row's dimensions are left out from where the norm of the
  rest times the longest anchor stays under the threshold: what is left out
  cannot reach it alone;
- scores add up panel by panel, a pair is dropped as soon as its partial score
  plus the product of both remaining norms stays under the threshold;
- pairs that are left get their left-out dimensions, and with them the exact
  integer score.

Each (block, group) hands on the first ``k`` rows of a window at most, so a
vector that very many rows share adds ``k`` rows per block.  Results do not
depend on thresholds, blocks or groups: those decide on cost only.

Defined results: rows with a NULL label or vector, or a NULL or non-finite
component, take no part; rows equal in id, label and vector are one row; rows
with one id and different contents are different rows (and anchors); ties go
to the smaller id, then to the smaller hash of the content, a NULL id comes
last and is no anchor; a vector that is shorter than another has zeros there;
components are held at +-2**28 so that scores fit a long; an empty table gives
an empty table; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import drop_shared, write_shared

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # the window, in percent of the positive's score
LARGEST = 1 << 28
BLOCK_ROWS, GROUP_ANCHORS = 4096, 2048
BATCH = 128  # anchors scored at a time
PANEL = 8  # dimensions of one list
DROP, ROUNDS = 0.6, 5  # thresholds of positives: DROP**1..ROUNDS of the largest score possible, then 0
NEAR = (0.9, 0.7, 0.0)  # thresholds of negatives, as shares of the window's upper end

_HIT = "q_id bigint, q_tag bigint, w int, id bigint, tag bigint, score bigint"
_RESULT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
           "negative_score bigint, positive_rank int")


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component."""
    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.greatest(F.least(y.cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST))).cast("bigint")
    held = F.transform(vector, lambda x: F.greatest(F.least(x.cast("double"), F.lit(1e15)), F.lit(-1e15)))
    return F.transform(held, one)


def usable_rows(rows: DataFrame, id_: Column, vector: Column, label: Column, anchor: Column,
                scale: int = SCALE) -> DataFrame:
    """Distinct usable rows: ``id, lab, v, tag, norm, anchor``."""
    good = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    kept = rows.where(label.isNotNull() & vector.isNotNull() & good)
    integral = isinstance(rows.select(label).schema[0].dataType, T.IntegralType)
    lab = label.cast("bigint") if integral else F.xxhash64(label.cast("string"))
    out = kept.select(id_.cast("bigint").alias("id"), lab.alias("lab"), whole_numbers(vector, scale).alias("v"),
                      F.coalesce(anchor, F.lit(False)).alias("anchor"))
    energy = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return out.withColumns({"tag": F.xxhash64("lab", "v"), "norm": F.sqrt(energy),
                            "anchor": F.col("anchor") & F.col("id").isNotNull()}).distinct()


def dimension_order(rows: DataFrame) -> list[int]:
    """All dimensions, those with the largest energy over the table first."""
    energy = (rows.select(F.posexplode("v").alias("k", "x"))
              .groupBy("k").agg(F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("e")))
    return [r["k"] for r in energy.orderBy(F.col("e").desc(), "k").collect()]  # one row per dimension


def _matrix(lists: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
    """Vectors as rows, dimensions in ``order``; zeros where one is shorter."""
    lists = lists.combine_chunks()
    lengths = np.diff(np.asarray(lists.offsets, np.int64))
    out = np.zeros((len(lists), len(order)), np.int64)
    out[np.repeat(np.arange(len(lists)), lengths),
        np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(lists.flatten())
    return out[:, order]


def _rest_norms(m: np.ndarray) -> np.ndarray:
    """``[row, c]``: norm of the dimensions from ``c`` on."""
    squares = np.cumsum(np.square(m.astype(np.float64))[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(m), 1))], axis=1)) * (1 + 1e-9)


class InvertedIndex:
    """Lists of rows and values per panel of dimensions, for scores of at
    least ``ratio`` times the anchor's norm."""

    def __init__(self, m: np.ndarray, ratio: float):
        self.m, self.rest = m, _rest_norms(m)
        dims = m.shape[1]
        self.edges = np.append(np.arange(0, dims, PANEL), dims)
        # first panel edge from where on the row's dimensions are left out
        out = self.rest[:, self.edges] < ratio
        self.cut = self.edges[np.where(out.any(axis=1), out.argmax(axis=1), len(self.edges) - 1)]
        self.lists = []
        for a, b in zip(self.edges, self.edges[1:]):
            rows = np.flatnonzero((self.cut > a) & m[:, a:b].any(axis=1))
            self.lists.append((rows, m[rows, a:b]))

    def at_least(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ``row, anchor, score`` with a score of ``least[anchor]`` or more."""
        q_rest = _rest_norms(q)
        partial = np.zeros((len(self.m), len(q)), self.m.dtype)
        alive = np.ones(len(self.m), bool)
        near = np.ones(partial.shape, bool)
        for (rows, values), a, b in zip(self.lists, self.edges, self.edges[1:]):
            here = alive[rows]
            if not here.all():
                rows, values = rows[here], values[here]
            partial[rows] += values @ q[:, a:b].T
            level = np.minimum(self.cut, b)
            live = np.flatnonzero(alive)
            bound = partial[live] + self.rest[live, level[live]][:, None] * q_rest[:, level[live]].T
            near[live] = bound * (1 + 1e-12) + 1e-3 >= least
            alive[live] = near[live].any(axis=1)
        x, y = np.nonzero(near & alive[:, None])
        score = partial[x, y].astype(np.int64)
        short = np.flatnonzero(self.cut[x] < self.m.shape[1])
        for part in np.array_split(short, len(short) // 50_000 + 1):
            left_out = np.arange(self.m.shape[1]) >= self.cut[x[part]][:, None]
            score[part] += (self.m[x[part]] * q[y[part]] * left_out).sum(axis=1).astype(np.int64)
        kept = score >= least[y]
        return x[kept], y[kept], score[kept]


def _cell(order: np.ndarray, k: int, same: bool):
    """The join of one block of rows with one group of anchors."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        schema = pa.schema([("q_id", pa.int64()), ("q_tag", pa.int64()), ("w", pa.int32()), ("id", pa.int64()),
                            ("tag", pa.int64()), ("score", pa.int64())])
        if not len(rows) or not len(anchors):
            return schema.empty_table()
        m, q = _matrix(rows["v"], order), _matrix(anchors["v"], order)
        largest = max(int(np.abs(m).max(initial=1)), int(np.abs(q).max(initial=1)))
        if largest * largest * max(1, m.shape[1]) < 1 << 52:  # whole numbers that doubles hold exactly
            m, q = m.astype(np.float64), q.astype(np.float64)
        ids = np.asarray(rows["id"].combine_chunks().fill_null(0), np.int64)
        nameless = np.asarray(rows["id"].is_null())
        tags, labs = np.asarray(rows["tag"], np.int64), np.asarray(rows["lab"], np.int64)
        q_ids, q_tags, q_labs = (np.asarray(anchors[c], np.int64) for c in ("id", "tag", "lab"))
        norms = np.asarray(anchors["norm"], np.float64)
        windows = [[(w["w"], w["bar"], w["high"]) for w in ws] for ws in anchors["windows"].to_pylist()]
        least = np.array([min(bar for _, bar, _ in ws) for ws in windows], np.int64)
        index = InvertedIndex(m, float((least / np.maximum(norms, 1e-300)).min()) * (1 - 1e-9))
        hits: list[tuple] = []
        for at in range(0, len(q), BATCH):
            x, y, score = index.at_least(q[at:at + BATCH], least[at:at + BATCH])
            y = y + at
            kept = (labs[x] == q_labs[y]) == same
            kept &= (ids[x] != q_ids[y]) | (tags[x] != q_tags[y]) | nameless[x]
            x, y, score = x[kept], y[kept], score[kept]
            rank = np.lexsort((tags[x], ids[x], nameless[x], -score, y))
            x, y, score = x[rank], y[rank], score[rank]
            starts = np.searchsorted(y, np.arange(at, at + BATCH + 1))
            for i in range(at, min(at + BATCH, len(q))):
                a, b = starts[i - at], starts[i - at + 1]
                falling = -score[a:b]
                for w, bar, high in windows[i]:
                    first, end = np.searchsorted(falling, -high), np.searchsorted(falling, -bar, "right")
                    hits += [(q_ids[i], q_tags[i], w, None if nameless[x[j]] else ids[x[j]], tags[x[j]], score[j])
                             for j in range(a + first, a + min(first + k, end))]
        return pa.table([pa.array([h[j] for h in hits], f.type) for j, f in enumerate(schema)], schema=schema)
    return run


def threshold_join(rows: DataFrame, anchors: DataFrame, order: list[int], n_rows: int, n_anchors: int, k: int,
                   same: bool) -> DataFrame:
    """For each window of each anchor the first ``k`` rows that score from
    ``bar`` to ``high``: of the anchor's label (``same``) or of others."""
    blocks, groups = -(-n_rows // BLOCK_ROWS), -(-n_anchors // GROUP_ANCHORS)

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64("id", "tag"), F.lit(n)).cast("int").alias(key)

    left = rows.select("id", "tag", "lab", "v", dealt("block", blocks),
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = anchors.select("id", "tag", "lab", "v", "norm", "windows", dealt("group", groups),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    hits = (left.groupBy("block", "group").cogroup(right.groupBy("block", "group"))
            .applyInArrow(_cell(np.array(order, np.int64), k, same), _HIT))
    return _first(hits, ["q_id", "q_tag", "w"], k)


def _first(hits: DataFrame, key: list[str], k: int) -> DataFrame:
    from pyspark.sql import Window
    order = Window.partitionBy(*key).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "tag")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fill_windows(rows: DataFrame, anchors: DataFrame, order: list[int], n_rows: int, bars: list[Column], k: int,
                 same: bool, name: str) -> DataFrame:
    """Joins with thresholds that fall round by round (``bars``: of a window
    ``x`` of an anchor, the last one its lower end) until each window has
    ``k`` rows or its lower end was the threshold.  ``q_id, q_tag, w, id, tag,
    score, rank``."""
    done: list[DataFrame] = []
    open_ = anchors
    for i, bar in enumerate(bars):
        last = i == len(bars) - 1
        wanted = open_.withColumn("windows", F.transform("windows", lambda x: F.struct(
            x.w.alias("w"), x.low.alias("low"), x.high.alias("high"),
            (x.low if last else F.least(F.greatest(bar(x), x.low), F.greatest(x.high, x.low))).alias("bar"))))
        wanted = write_shared(wanted, f"{name}-open")
        n_open = wanted.count()
        if not n_open:
            drop_shared(wanted)
            break
        hits = write_shared(threshold_join(rows, wanted, order, n_rows, n_open, k, same), f"{name}-hits")
        full = (hits.groupBy("q_id", "q_tag", "w").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("q_id", "q_tag").agg(F.collect_list(F.when(F.col("n") == k, F.col("w"))).alias("full")))
        # windows are few per anchor: as many as it has positives
        state = (wanted.join(full.withColumnsRenamed({"q_id": "id", "q_tag": "tag"}), ["id", "tag"], "left")
                 .withColumn("full", F.coalesce("full", F.array().cast("array<int>")))
                 .withColumn("left", F.filter("windows", lambda x: (x.bar > x.low)
                                              & ~F.array_contains(F.col("full"), x.w))))
        pending = state.select(F.col("id").alias("q_id"), F.col("tag").alias("q_tag"),
                               F.explode("left.w").alias("w"))
        done.append(hits.join(pending, ["q_id", "q_tag", "w"], "left_anti"))
        open_ = (state.where(F.size("left") > 0)
                 .withColumn("windows", F.transform("left", lambda x: F.struct(
                     x.w.alias("w"), x.low.alias("low"), x.high.alias("high"))))
                 .select(*anchors.columns))
    if not done:
        return rows.sparkSession.createDataFrame([], _HIT + ", rank int")
    return reduce(DataFrame.unionByName, done)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | None = None, *, scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank`` for the rows where ``anchor`` holds: per
    positive its first ``negatives`` rows of other labels that score from
    ``low`` to ``high`` percent of the positive's score.

    Positives with a score below 0 have an empty window, so no threshold need
    fall below 0."""
    label = F.col("label") if label is None else label
    used = write_shared(usable_rows(rows, F.col(id_col), F.col(vector_col), label, anchor, scale), "negatives-rows")
    n_rows, top, n_anchors = used.agg(F.count(F.lit(1)), F.max("norm"),
                                      F.count(F.when(F.col("anchor"), F.lit(1)))).first()
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], _RESULT)
    order = dimension_order(used)
    anchors = used.where("anchor").select("id", "tag", "lab", "v", "norm")
    whole = F.array(F.struct(F.lit(0).alias("w"), F.lit(0).cast("bigint").alias("low"),
                             F.lit((1 << 62)).alias("high")))
    falling = [lambda x, r=top * DROP ** (i + 1): F.ceil(F.col("norm") * r) for i in range(ROUNDS)]
    near = fill_windows(used, anchors.withColumn("windows", whole), order, n_rows, [*falling, None], positives,
                        True, "positives")
    near = write_shared(near.select("q_id", "q_tag", "id", "score", F.col("rank").alias("positive_rank")), "positives")
    # 100 n >= low p and 100 n <= high p, in whole numbers; p >= 0
    p = F.col("score")
    lower, upper = F.expr(f"(score * {low} + 99) div 100"), F.expr(f"(score * {high}) div 100")
    asked = (near.where(p >= 0)
             .groupBy("q_id", "q_tag").agg(F.collect_list(F.struct(
                 F.col("positive_rank").alias("w"), lower.alias("low"), upper.alias("high"))).alias("windows"))
             .withColumnsRenamed({"q_id": "id", "q_tag": "tag"}))
    asked = anchors.join(asked, ["id", "tag"]).select("id", "tag", "lab", "v", "norm", "windows")
    shares = [lambda x, s=s: F.ceil(x.high * s) for s in NEAR]
    far = fill_windows(used, asked, order, n_rows, shares, negatives, False, "negatives")
    pairs = near.select("q_id", "q_tag", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                        "positive_rank")
    found = far.select("q_id", "q_tag", F.col("w").alias("positive_rank"), F.col("id").alias("negative_id"),
                       F.col("score").alias("negative_score"), "rank")
    return (found.join(pairs, ["q_id", "q_tag", "positive_rank"])
            .select(F.col("q_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score", "positive_rank"))


# The rows of the query in DuckDB: all scores of all anchors.
ORACLE = """
with r as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as lab,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
scored as (
    select a.vec_id as anchor_id, b.vec_id as id, a.lab = b.lab as same,
           list_dot_product(a.v, b.v)::bigint as score
    from r a join r b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (
    select anchor_id, id, score, row_number() over (partition by anchor_id order by score desc, id) as place
    from scored where same qualify place <= 5)
select p.anchor_id, p.id as positive_id,
       (row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id))::int as rank,
       n.id as negative_id, p.score as positive_score, n.score as negative_score, p.place::int as positive_rank
from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
     and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""
