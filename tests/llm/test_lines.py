"""Line dedup against SQL and a plain version."""

from collections import defaultdict

import duckdb
import pytest
import xxhash

from fleetlens.llm import lines

WHITE = " \t\n\x0b\x0c\r"


def document(doc, text):
    """Documents in order: by id, those without one after the others by their text's hash."""
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return (False, doc) if doc is not None else (True, h - (1 << 64) if h >> 63 else h)


def plain(rows, min_sites):
    sites, keeper = defaultdict(set), {}
    for doc, text, site in rows:
        doc = document(doc, text)
        for x in (text or "").split("\n"):
            if x.strip(WHITE):
                if site is not None:
                    sites[x.strip(WHITE)].add(site)
                keeper[x.strip(WHITE)] = min(keeper.get(x.strip(WHITE), doc), doc)
    out = []
    for doc, text, _ in rows:
        seen, left = set(), []
        for x in ([] if text is None else text.split("\n")):
            body = x.strip(WHITE)
            wide = body and len(sites[body]) >= min_sites
            if not wide or (document(doc, text) == keeper[body] and body not in seen):
                left.append(x)
            seen.add(body)
        out.append((doc, None if text is None else "\n".join(left)))
    return sorted(out, key=repr)


def test_same_as_sql(spark):
    d = "/root/testdata/sf0.01/documents.parquet"
    got = lines.remove_boilerplate(spark.read.parquet(d), keep=["doc_id"]).select(
        "_row.doc_id", "text", "n_lines", "n_removed").collect()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}'")
    want = con.sql(lines.ORACLE.format(min_sites=lines.MIN_SITES)).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("min_sites", [2, 3])
def test_odd_rows(odd, nothing, min_sites):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    got = lines.remove_boilerplate(odd, min_sites=min_sites).select("_row.doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, min_sites)
    assert lines.remove_boilerplate(nothing).count() == 0


def test_sketches_decide_far_lines_and_counts_near_ones(spark):
    rows = [(i, f"wide line\nline of {i % 9}", f"site{i % 60}") for i in range(600)]
    rows += [(1000 + i, "edge line", f"site{i}") for i in range(7)]
    rows += [(2000 + i, "full line", f"site{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hashes = lines.line_hashes(docs, docs.text, docs.doc_id, docs.source)
    assert hashes.columns == ["doc", "text_hash", "site", "pos", "h1", "h2"]
    got = lines.remove_boilerplate(docs, min_sites=8).select("_row.doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 8)


def test_lines_of_documents_without_an_id_stay_once(spark):
    """Nothing but NULL ids: the first document by its text's hash keeps the line."""
    rows = [(None, f"common line\nown {i}\ncommon line", f"site{i}") for i in range(9)] * 2
    rows += [(None, "common line", None), (None, None, "site1"), (None, "", "site2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = sorted(map(tuple, lines.remove_boilerplate(docs).select("_row.doc_id", "text").collect()), key=repr)
    assert got == plain(rows, lines.MIN_SITES)
    assert sum("common" in (t or "") for _, t in got) in (1, 2)


def test_one_id_with_several_texts(spark):
    rows = [(i % 4, f"a {i}\nwide\n wide\nb\nwide", f"site{i}") for i in range(20)] + [(0, "wide\nx", "site1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(map(tuple, lines.remove_boilerplate(docs, min_sites=4).select("_row.doc_id", "text").collect()),
                 key=repr)
    assert got == plain(rows, 4)


def test_no_distinct_sites_of_all_lines_are_shuffled(spark):
    """Sketches come from raw lines; only lines near the threshold get sets of sites."""
    docs = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    plan = lines.boilerplate(lines.line_hashes(docs, docs.text, docs.doc_id, docs.source))._jdf.queryExecution()\
        .optimizedPlan().toString()
    sketches = [p for p in plan.split("\n") if "hll_sketch_agg" in p]
    assert sketches and all("Aggregate [h1" in p for p in sketches)
    distinct = [i for i, p in enumerate(plan.split("\n")) if "Aggregate" in p and "site" in p.split("], [")[0]]
    below = plan.split("\n")
    assert distinct and all(any("LeftSemi" in p for p in below[i + 1:i + 3]) for i in distinct)
