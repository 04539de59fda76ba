"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source whose target is ``c`` times its size is wanted ``c``
times: ``floor(c)`` copies are certain, the rest is a probability.  Pivotal
rounding settles these: two documents meet, and words move from one to the
other at random until the copies of one of them are 0 or 1; the other goes on
with what is left.  The expected copies of each document stay what they were,
and so does the sum of words, up to the last unsettled document of a source,
which is rounded to the nearer side: half its words is the largest error.

Documents meet in a reduction tree ordered by size: a leaf holds some sixteen
documents of one source and size, each level joins up to sixteen neighbouring
cells, and a cell hands at most one unsettled document to the next.  No cell
grows with a hot source.  Every step is a DataFrame operation; random numbers
are hashes of the documents' keys and the seed, so reruns agree.

Defined results: a NULL text has size 0; a NULL source is a source of its own,
after all others; a source without words has target 0 and takes nothing; rows
equal in id, source and text are taken by their number, as nearly as single
rows allow, whichever of them; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import ROW, with_row, word_count, write_shared

WEIGHTS = (5, 2, 1)  # of the sources in code-point order, repeating
MAX_COPIES = 3
SEED = 20
FAN_BITS = 4  # a level joins sixteen cells
HASH_BITS = 31


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    A source's target is its weight's share of all sizes, at most
    ``max_copies`` times its size; the excess is shared out again by weight.
    Filled up together, sources reach their limit in the order of limit per
    weight; the level they share is the first that does not pass the next
    limit.  One row per source is all that these windows see.
    """
    by = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(by) - 1, len(weights)) + 1)
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("w", weight)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    table = table.withColumn("cap", F.col("source_size") * max_copies).withColumn("level", left / open_weight)
    shared = F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct(F.col("cap") / F.col("w"), "level")))
    return (table.withColumn("shared", shared.over(everything)["level"])
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("shared") * F.col("w")).alias("target")))


def _uniform(*parts) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11).cast("double") / float(1 << 53)


ITEM = "struct<ord:bigint,k1:bigint,k2:bigint,w:double,p:double>"


def _with(x: Column, p: Column) -> Column:
    return F.struct(x.ord.alias("ord"), x.k1.alias("k1"), x.k2.alias("k2"), x.w.alias("w"), p.alias("p"))


def _meet(level: int):
    """One step of the fold over a cell: the unsettled document ``carry`` meets
    ``x``.  Words move from one to the other, either way, as far as one of
    them allows; the odds of the two ways keep both expectations.  Whoever is
    settled goes to ``done``."""
    def step(acc: Column, x: Column) -> Column:
        a, b = acc.carry, x
        up_room, up_mass = a.w * (1 - a.p), b.w * b.p  # if ``a`` gains
        down_mass, down_room = a.w * a.p, b.w * (1 - b.p)  # if ``b`` gains
        up, down = F.least(up_room, up_mass), F.least(down_mass, down_room)
        gains = _uniform(F.lit(level), a.k1, a.k2, b.k1, b.k2) * (up + down) < down
        a_ends = F.when(gains, up_room <= up_mass).otherwise(down_mass <= down_room)
        moved = F.when(gains, up).otherwise(-down)
        # the one that ends has all of its room or mass moved
        ends, goes = F.when(a_ends, a).otherwise(b), F.when(a_ends, b).otherwise(a)
        p = F.when(a_ends, b.p - moved / b.w).otherwise(a.p + moved / a.w)
        bit = F.when(a_ends == gains, 1).otherwise(0)
        settled = F.concat(acc.done, F.array(F.struct(ends.k1.alias("k1"), ends.k2.alias("k2"), bit.alias("bit"))))
        carry = _with(goes, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
        return F.when(a.isNull(), F.struct(b.alias("carry"), acc.done.alias("done"))).otherwise(
            F.struct(carry.alias("carry"), settled.alias("done")))
    return step


def pivotal_round(items: DataFrame, name: str = "mix") -> DataFrame:
    """``k1, k2, bit`` for items ``source, k1, k2, size, p`` (0 < p < 1): the
    items' probabilities rounded to 0 or 1."""
    size = F.least(F.col("size"), F.lit((1 << HASH_BITS) - 1))
    most, largest = (items.groupBy("source", size.alias("size")).agg(F.count(F.lit(1)).alias("n"))
                     .agg(F.max("n"), F.max("size")).first())
    if most is None:
        return items.select("k1", "k2", F.lit(0).alias("bit"))
    # large documents meet first: what is left over is mostly small
    order = (largest - size) * (1 << HASH_BITS) + F.shiftrightunsigned(
        F.xxhash64(F.lit(SEED + 1), "k1", "k2"), 64 - HASH_BITS)
    now = items.select("source", F.struct(order.alias("ord"), "k1", "k2", F.greatest("size", F.lit(1)).cast("double")
                                          .alias("w"), "p").alias("x"))
    # leaves of some sixteen items even where most share one source and size
    shift = HASH_BITS - min(HASH_BITS, max(0, (most >> FAN_BITS).bit_length()))
    top = HASH_BITS + int(largest).bit_length()
    empty = F.struct(F.lit(None).cast(ITEM).alias("carry"),
                     F.array().cast("array<struct<k1:bigint,k2:bigint,bit:int>>").alias("done"))
    levels, level = [], 0
    while True:
        folded = (now.groupBy("source", F.shiftright("x.ord", shift).alias("cell"))
                  .agg(F.array_sort(F.collect_list("x")).alias("xs"))
                  .select("source", F.aggregate("xs", empty, _meet(level)).alias("s"))
                  .select("source", "s.carry", "s.done"))
        table = write_shared(folded, f"{name}-{level}")
        levels.append(table.select(F.explode("done").alias("d")).select("d.*"))
        if shift >= top:
            break
        now = table.select("source", F.col("carry").alias("x"))
        shift, level = min(shift + FAN_BITS, top), level + 1
    # one document of each source is left: it goes where its words are nearest
    levels.append(table.select("carry.k1", "carry.k2", F.when(F.col("carry.p") >= 0.5, 1).otherwise(0).alias("bit")))
    return reduce(DataFrame.unionByName, levels)


CHUNK_ROWS = 65_536  # of equal rows that are numbered together


def _numbered(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Of rows whose key ``k1, k2`` comes more than once, each with its
    ``number`` (from 1) among those of its key.

    Equal rows are dealt into chunks at random and written, which fixes the
    deal; a window then numbers the rows of a chunk, and another one the chunks
    of a key, so that no task holds a key that very many rows share."""
    dealt = rows.join(repeated.select("k1", "k2", "rows"), ["k1", "k2"]).withColumn(
        "chunk", F.floor(F.rand(SEED) * F.ceil(F.col("rows") / CHUNK_ROWS)).cast("int")).withColumn("at", F.rand(SEED + 2))
    dealt = write_shared(dealt, "mix-repeated")
    inside = Window.partitionBy("k1", "k2", "chunk").orderBy("at")
    ahead = Window.partitionBy("k1", "k2").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (dealt.groupBy("k1", "k2", "chunk").agg(F.count(F.lit(1)).alias("n"))
              .select("k1", "k2", "chunk", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")))
    return (dealt.withColumn("inside", F.row_number().over(inside)).join(chunks, ["k1", "k2", "chunk"])
            .withColumn("number", F.col("ahead") + F.col("inside")).select(*rows.columns, "number"))


def mix(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        keep: list[str] | None = None, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: ``_row`` (its columns, or those in ``keep``),
    ``source``, ``size`` (words), ``source_size``, ``target`` and ``copies``.

    Rows equal in id, source and text are taken as often as their number
    asks for: of ``n`` of them with probability ``p`` the first ``floor(n p)`` are,
    and one goes into the rounding with what is left."""
    text, source = F.col(text_col), F.col(source_col).cast("string")
    key = [F.col(doc_col).cast("string"), source, text]
    k1, k2 = F.xxhash64(*key), F.xxhash64(F.lit(1), *key)
    sized = docs.select(source.alias("source"), k1.alias("k1"), k2.alias("k2"), word_count(text).alias("size"))
    sized = write_shared(sized, "mix-sizes")
    targets = source_targets(sized, weights, max_copies)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = write_shared(targets.withColumn("wanted", wanted), "mix-targets")
    several = F.col("rows") * (F.col("wanted") - F.floor("wanted"))
    items = write_shared(
        sized.groupBy("source", "k1", "k2", "size").agg(F.count(F.lit(1)).alias("rows"))
        .withColumnRenamed("source", "own")
        .join(rates.select("source", "wanted"), F.col("own").eqNullSafe(F.col("source")))
        # a hair above, so that 0.1 + 0.2 is not just under a whole number
        .withColumn("whole", F.floor(several + F.lit(1e-9)))
        .select("source", "k1", "k2", "size", "rows", "whole", F.greatest(several - F.col("whole"), F.lit(0.0)).alias("p")),
        "mix-items")
    bits = pivotal_round(items.where("p > 0").select("source", "k1", "k2", "size", "p")).where("bit = 1")
    bits = bits.select("k1", "k2", "bit")
    rows = docs.select(with_row(docs, keep), source.alias("own"), k1.alias("k1"), k2.alias("k2"),
                       word_count(text).alias("size"))
    repeated = items.where("rows > 1").select("k1", "k2", "rows", "whole")
    if repeated.isEmpty():
        taken = rows.join(bits, ["k1", "k2"], "left")
    else:
        once = rows.join(repeated.select("k1", "k2"), ["k1", "k2"], "left_anti").join(bits, ["k1", "k2"], "left")
        quota = repeated.join(bits, ["k1", "k2"], "left").select(
            "k1", "k2", (F.col("whole") + F.coalesce("bit", F.lit(0))).alias("quota"))
        more = (_numbered(rows, repeated).join(quota, ["k1", "k2"])
                .withColumn("bit", (F.col("number") <= F.col("quota")).cast("int")))
        taken = once.unionByName(more.select(*once.columns))
    return (taken.join(rates, F.col("own").eqNullSafe(F.col("source")))
            .select(ROW, F.col("own").alias("source"), "size", "source_size", "target",
                    (F.floor("wanted") + F.coalesce("bit", F.lit(0))).cast("int").alias("copies")))


def mixed_rows(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """The mix itself: each document as many times as it was given copies."""
    taken = mix(docs, doc_col, text_col, source_col, **options).where("copies > 0")
    return taken.select(ROW, F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(f"{ROW}.*")
