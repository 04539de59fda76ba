"""Chunk dedup: planted passages, shifts, a plain version of the runs."""

import random
from collections import defaultdict

import numpy as np

from fleetlens.llm import chunking
from tests.llm.conftest import prose


def spans(docs, **options):
    return chunking.repeated_passages(docs, **options).collect()


def test_rolling_hash_is_the_gear_hash():
    data = np.frombuffer(prose(60).encode(), np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(chunking.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert chunking.gear_hashes(data).tolist() == want


def test_planted_passages(spark):
    rng = random.Random(5)
    rows, planted = [], set()
    passages = [prose(70, 1000 + i) for i in range(20)]
    for i in range(400):
        text = prose(rng.randrange(60, 300), 5000 + i)
        if i % 5 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + " " + passages[i // 5 % 20] + " " + text[at:]
            planted.add(i)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = spans(docs)
    hit = {r["doc_id"] for r in found} | {r["first_doc_id"] for r in found}
    assert hit == planted
    for r in found:
        passage = texts[r["doc_id"]][r["start"]:r["start"] + r["chars"]]
        assert len(passage.split()) == r["words"] >= chunking.MIN_RUN
        assert " ".join(passage.split()) in " ".join(texts[r["first_doc_id"]].split())
        assert r["first_doc_id"] < r["doc_id"]


def test_insertions_shift_chunks_only():
    raw = prose(600, 3).encode()
    grown = b"some inserted words " + raw

    def digests(x):
        data = np.frombuffer(x, np.uint8)
        rows = chunking._chunk_text(data, chunking.gear_hashes(data), x, (1 << 32) // 4, 5, 64)
        return {r[-2:] for r in rows}
    old, new = digests(raw), digests(grown)
    assert len(old & new) >= 0.9 * len(old)


def plain_passages(rows, min_run=chunking.MIN_RUN):
    """The passages from all pairs of documents and loops."""
    docs = {}
    for doc, text in rows:
        if doc is not None and text is not None:
            data = np.frombuffer(text.encode(), np.uint8)
            hashes = chunking.gear_hashes(chunking.normal_bytes(data))
            docs[(doc, text)] = [*chunking._chunk_text(data, hashes, text.encode(), (1 << 32) // chunking.CUT_ONE_IN,
                                                       chunking.MIN_WORDS, chunking.MAX_WORDS)]
    ones, twos = defaultdict(set), defaultdict(set)
    for (doc, _), cs in docs.items():
        for c in cs:
            ones[c[-2:]].add(doc)
        for c, d in zip(cs, cs[1:]):
            twos[c[-2:] + d[-2:]].add(doc)
    out = []
    for (doc, text), cs in docs.items():
        links, covers = [], defaultdict(int)
        for k in range(1, len(cs)):
            first = min(twos[cs[k - 1][-2:] + cs[k][-2:]])
            if first < doc:
                links.append((k - 1, k, first))
        for k, c in enumerate(cs):
            if c[3] >= min_run and min(ones[c[-2:]]) < doc:
                links.append((k, k, min(ones[c[-2:]])))
        links.sort(key=lambda x: (x[1], x[0]))
        runs = []
        for a, b, first in links:
            if not runs or a > runs[-1][1]:
                runs.append([a, b, defaultdict(int)])
            runs[-1][0], runs[-1][1] = min(runs[-1][0], a), b
            runs[-1][2][first] += cs[b][3]
        for a, b, covers in runs:
            words = sum(c[3] for c in cs[a:b + 1])
            if words >= min_run:
                source = min(covers, key=lambda d: (-covers[d], d))
                out.append((doc, cs[a][1], cs[b][1] + cs[b][2] - cs[a][1], words, source))
    return sorted(out)


def found_in(docs):
    return sorted((r["doc_id"], r["start"], r["chars"], r["words"], r["first_doc_id"]) for r in spans(docs))


def test_equals_the_plain_version(spark, odd, sample):
    for docs in (odd, sample.select("doc_id", "text")):
        assert found_in(docs) == plain_passages([(r["doc_id"], r["text"]) for r in docs.collect()]) != []


def test_reflowed_copies_and_repeated_rows(spark):
    text = prose(400, 3)
    rng = random.Random(2)
    reflowed = "".join(c if c != " " else rng.choice(["\n", "  ", "\t", " \r\n", " "]) for c in text)
    rows = [(1, text), (2, reflowed), (2, reflowed), (2, reflowed), (3, "\n" + text.upper()), (3, prose(50, 9)), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = found_in(docs)
    assert found == plain_passages(rows) == [(2, 0, len(reflowed), 400, 1)]


def test_third_holders_break_no_passage(spark):
    """Documents 0 hold chunks of a passage that 500 and 900 share."""
    rows, hit = [], 0
    passages = [prose(60, 700 + i) for i in range(60)]
    for i, p in enumerate(passages):
        w = p.split()
        rows.append((i, prose(30, i) + " " + " ".join(w[20:33]) + " " + prose(30, 100 + i)))
        rows.append((500 + i, prose(40, 200 + i) + " " + p + " " + prose(40, 300 + i)))
        rows.append((900 + i, prose(50, 400 + i) + " " + p + " " + prose(20, 500 + i)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = spans(docs)
    assert found_in(docs) == plain_passages(rows)
    for i in range(60):
        own = [r for r in found if r["doc_id"] == 900 + i]
        hit += len(own) == 1 and own[0]["first_doc_id"] == 500 + i and own[0]["words"] >= 30
    assert hit >= 0.95 * 60


def test_odd_rows(odd, nothing):
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r["doc_id"]].add(r["text"])
    found = spans(odd)
    for r in found:
        (text,) = texts[r["doc_id"]]
        (first,) = texts[r["first_doc_id"]]
        part = text[r["start"]:r["start"] + r["chars"]]
        assert " ".join(part.split()) in " ".join(first.split())
    pairs = {(r["doc_id"], r["first_doc_id"]) for r in found}
    assert {(2, 1), (3, 1), (8, 7)} <= pairs
    cleaned = chunking.remove_passages(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == odd.count()
    assert len(cleaned.where("doc_id = 8").first()["text"]) < 1000
    assert spans(nothing) == [] and chunking.remove_passages(nothing).count() == 0


def test_chunks_have_bounded_words(odd):
    for r in chunking.chunks(odd, odd.doc_id, odd.text).collect():
        assert 1 <= r["words"] <= chunking.MAX_WORDS
