"""Cross-site boilerplate lines, by the spread of each line over sites.

A line's spread is the number of distinct sites it appears on.  Lines on two
sites at least get a HyperLogLog sketch of their sites, built from the raw
lines (a partial sketch per line and task, merged by the aggregation); only
lines whose estimate lies near the threshold get an exact set of sites.  A line
that spreads over ``min_sites`` sites or more is boilerplate: its first
occurrence stays (smallest document id, then first in the text), every other
one is removed.

Lines are cut at ``\\n``; they are compared without the ASCII white space
around them.  Blank lines are never removed.  Defined results: a NULL text
stays NULL and has no lines; a NULL site is no site and adds no spread; rows
with one id count as copies of one document, and each text among them keeps
its first occurrence; a NULL id comes after all others, and of rows without an
id those with one text count as copies of one document, documents being ordered
by the hash of the text; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import ROW, with_row

MIN_SITES = 8
LG_K = 12  # sketch of 4096 registers: 1.6 % standard error
BAND = 0.10  # six standard errors: estimates this near the threshold are recounted

_KEY = ["h1", "h2"]
SALTS = 16  # tasks that share the rows of one line in a join


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\n\x0b\x0c\r"))


def _hash(line: Column) -> Column:
    """128 bits of a line, as two hashes with different seeds."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def document_key(doc: Column, text: Column) -> Column:
    """What tells documents apart, in their order: the id, and without one
    the text."""
    return F.struct(doc.isNull().alias("nameless"), doc.alias("id"),
                    F.when(doc.isNull(), F.xxhash64(text)).alias("text"))


def line_hashes(docs: DataFrame, text: Column, doc: Column, site: Column) -> DataFrame:
    """One row per non-blank line: ``doc`` (:func:`document_key`),
    ``text_hash``, ``site``, ``pos`` (from 0) and the line's hash."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), _trimmed(x).alias("line")))
    hashes = F.transform(F.filter(lines, lambda x: x.line != ""), lambda x: F.struct(x.pos, _hash(x.line).alias("h")))
    return (docs.select(document_key(doc, text).alias("doc"), F.xxhash64(text).alias("text_hash"), site.alias("site"),
                        F.explode(hashes).alias("x"))
            .select("doc", "text_hash", "site", "x.pos", "x.h.h1", "x.h.h2"))


def _salt() -> Column:
    """A number below ``SALTS`` by document: the rows of a very common line
    meet their partner in so many tasks, and each aggregates its own."""
    return F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int").alias("salt")


def _salted(keys: DataFrame) -> DataFrame:
    """Each row once per salt; rows are lines that several sites share, or fewer."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """Lines on ``min_sites`` sites or more: their hash, spread and the
    document that keeps them.

    A line needs two different sites to be a candidate at all; that cut is a
    plain map-side aggregate, so sketches are built for few lines only.
    """
    several = (lines.groupBy(*_KEY)
               .agg(F.min("site").alias("lo"), F.max("site").alias("hi"), F.min("doc").alias("keeper"))
               .where("lo < hi").select(*_KEY, "keeper"))
    with_site = lines.where("site is not null").select(*_KEY, "site", _salt())
    spread = (with_site.join(_salted(several.select(*_KEY)), [*_KEY, "salt"], "left_semi").groupBy(*_KEY)
              .agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
              .select(*_KEY, F.hll_sketch_estimate("sketch").alias("estimate"))
              .where(F.col("estimate") >= min_sites * (1 - band)))
    far = F.col("estimate") > min_sites * (1 + band)
    exact = (with_site.join(_salted(spread.where(~far).select(*_KEY)), [*_KEY, "salt"], "left_semi")
             .select(*_KEY, "site").distinct()
             .groupBy(*_KEY).agg(F.count(F.lit(1)).alias("spread")))
    found = (spread.where(far).select(*_KEY, F.col("estimate").alias("spread"))
             .unionByName(exact.where(F.col("spread") >= min_sites)))
    return found.join(several, _KEY)


def remove_boilerplate(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                       *, keep: list[str] | None = None, min_sites: int = MIN_SITES) -> DataFrame:
    """One row per document: ``_row`` (its columns, or those in ``keep``),
    ``text`` without boilerplate, ``n_lines`` (non-blank ones) and
    ``n_removed``.

    Shuffles line hashes, never lines; texts move once, to meet the places of
    the lines that go.  A line that a third of all rows hold is one partial
    row per task in every aggregate, and dealt over ``SALTS`` tasks in joins.
    """
    doc, text = F.col(doc_col), F.col(text_col)
    lines = line_hashes(docs, text, doc, F.col(site_col).cast("string"))
    marked = boilerplate(lines, min_sites)
    of_text = ["doc", "text_hash"]
    # of a line's places in its keeper's text the first one stays; copies of a
    # text have the same places
    gone = (lines.select(*of_text, "pos", *_KEY, _salt())
            .join(_salted(marked.select(*_KEY, "keeper")), [*_KEY, "salt"])
            .groupBy(*of_text, *_KEY, "salt", (F.col("doc") == F.col("keeper")).alias("keeps"))
            .agg(F.collect_set("pos").alias("places"))
            .withColumn("places", F.when(F.col("keeps"), F.array_except("places", F.array(F.array_min("places"))))
                        .otherwise(F.col("places")))
            .groupBy(*of_text).agg(F.flatten(F.collect_list("places")).alias("gone")))
    rows = docs.select(with_row(docs, keep), document_key(doc, text).alias("doc"),
                       F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    joined = rows.join(gone.withColumnsRenamed({"doc": "_doc", "text_hash": "_hash"}),
                       F.col("doc.nameless").eqNullSafe(F.col("_doc.nameless"))
                       & F.col("doc.id").eqNullSafe(F.col("_doc.id")) & (F.col("text_hash") == F.col("_hash")), "left")
    cut = F.split("_text", "\n")
    # linear in the lines: a set of places, then each line that stays by its place
    stays = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("gone"))
    left = F.array_join(F.transform(stays, lambda i: F.get(F.col("cut"), i)), "\n")
    return (joined.withColumn("cut", cut)
            .select(ROW,
                    F.when(F.col("gone").isNull(), F.col("_text")).otherwise(left).alias("text"),
                    F.when(F.col("_text").isNull(), 0)
                    .otherwise(F.size(F.filter("cut", lambda x: _trimmed(x) != ""))).cast("bigint").alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed")))


# The same rows in DuckDB: first occurrences of lines on MIN_SITES sources or
# more stay, the others go.
ORACLE = r"""
with doc_lines as (
    select doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) as pos,
           unnest(string_split(text, chr(10))) as line
    from documents),
trimmed as (select *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from doc_lines),
spread as (
    select body, min(doc_id) as keeper from trimmed where body <> ''
    group by body having count(distinct source) >= {min_sites}),
verdict as (
    select t.*, s.body is not null and not (t.doc_id = s.keeper and t.pos = min(t.pos) over (
        partition by t.doc_id, t.body)) as gone
    from trimmed t left join spread s on t.body = s.body)
select d.doc_id, v.text, coalesce(v.n_lines, 0) as n_lines, coalesce(v.n_removed, 0) as n_removed
from documents d left join (
    select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text,
           count(*) filter (where body <> '') as n_lines, count(*) filter (where gone) as n_removed
    from verdict group by doc_id) v using (doc_id)
"""
