"""Automaton scores against a plain n-gram model."""

import math
import re
import zlib
from collections import Counter

import pytest

from fleetlens.llm import lm


def plain(rows, order, mass):
    """(n_tokens, n_known, N, base, score) of each (doc_id, text)."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    seqs = [["<b>", *re.findall(r"[^\x20\x09-\x0D]+", low(t)), None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    count, context = Counter(), Counter()
    for s, h in zip(seqs, held):
        for i in range(1, len(s)):
            for k in range(order):
                if not h and i >= k:
                    count[tuple(s[i - k:i + 1])] += 1
                    context[tuple(s[i - k:i])] += 1
    n, v = context[()], sum(len(g) == 1 for g in count)
    out = []
    for s, h in zip(seqs, held):
        score = base = known = 0
        for i in range(1, len(s)):
            p = (count[(s[i],)] + 1) / (n + v + 1)
            base += math.log10(p)
            known += count[(s[i],)] > 0
            for k in range(1, order):
                if i >= k:
                    p = (count[tuple(s[i - k:i + 1])] + mass * p) / (context[tuple(s[i - k:i])] + mass)
            score += math.log10(p)
        out.append((h, len(s) - 1, known, n, base, score))
    return out


def check(docs, order, mass):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 6))
    want = sorted(((d, *x) for (d, _), x in zip(rows, plain(rows, order, mass))),
                  key=lambda r: (str(r[0]), r[2], r[3], round(r[5], 6)))
    got = sorted((tuple(r) for r in lm.score_texts(docs, order=order, mass=mass, block_mb=1).collect()),
                 key=lambda r: (str(r[0]), r[2], r[3], round(r[5], 6)))
    assert len(got) == len(want) and key
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_documents(sample, order):
    check(sample, order, 300.0)


def test_odd_rows(odd, nothing):
    check(odd, 2, lm.MASS)
    assert lm.score_texts(nothing).count() == 0


def test_better_than_unigrams_on_held_out_texts(spark):
    rows = lm.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.98 * sum(r["base_score"] for r in rows)
