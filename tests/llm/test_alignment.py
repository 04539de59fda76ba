"""Alignment against a plain version, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import alignment as A
from tests.llm.conftest import DOCS, prose

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def pair():
    return A.tokenizer_pair(public_tokenizers.path(A.A_FILE), public_tokenizers.path(A.B_FILE))


def plain(rows):
    """All rows of the result, from the two libraries and loops."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    ta = Tokenizer.from_file(public_tokenizers.path(A.A_FILE))
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.B_FILE))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    docs, total = [], Counter()
    for i, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a = ta.encode(" " + text, add_special_tokens=False).ids
            b = tb.encode(text)
            pa_ = [bytes(byte[c] for c in ta.id_to_token(x)) for x in a]
            pb = [bytes([int(tb.id_to_piece(x)[1:-1], 16)]) if tb.is_byte(x)
                  else tb.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(pa_) != (" " + text).encode() or b"".join(pb) != (" " + text).encode():
                a, b = [], []
        if a:
            x = y = start = 0
            ea, eb = len(pa_[0]), len(pb[0])
            ga, gb = [a[0]], [b[0]]
            while True:
                links.append((a[x], b[y]))
                if ea == eb:
                    groups.append((ga, gb))
                    x, y = x + 1, y + 1
                    if x == len(a):
                        break
                    ga, gb = [a[x]], [b[y]]
                    ea, eb = ea + len(pa_[x]), eb + len(pb[y])
                elif ea < eb:
                    x += 1
                    ga.append(a[x])
                    ea += len(pa_[x])
                else:
                    y += 1
                    gb.append(b[y])
                    eb += len(pb[y])
        total.update(links)
        text_of = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        docs.append((i, len(a), len(b), len(groups), links, hashlib.sha256(text_of.encode()).hexdigest() if a else ""))
    highest = Counter()
    for (x, y), n in total.items():
        highest[y] = max(highest[y], n)
    return sorted([(i, na, nb, g, len(ls), sum(total[p] == highest[p[1]] for p in ls), sum(total[p] for p in ls), h)
                   for i, na, nb, g, ls, h in docs], key=str), total


def aligned(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in A.align_corpus(df).collect()], key=str)


def test_odd_documents(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert aligned(odd) == plain(rows)[0]


def test_small_chunks_blocks_shards_and_cells_change_nothing(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, prose(rng.randrange(1, 400), i)) for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate((
        "<|endoftext|> and </s> <s> <0x0A>", " led", "trail ", "two  spaces", "tab\there", "a▁b", "fi ﬁ é é",
        "x\n\ny", "\nnext", "漢字 かな", "end.\nNext, line.", "nul \x00 byte", "　", ".", "1234567 89.5,6", "😀 ok 😀"))]
    df = spark.createDataFrame([(i, t, *[None] * (len(DOCS) - 2)) for i, t in rows], DOCS).repartition(5)
    want, total = plain(rows)
    monkeypatch.setattr(A, "CELL", 400)
    monkeypatch.setattr(A, "SHARD", 900)
    monkeypatch.setattr(A, "FAN", 2)
    # the tasks take these sizes from the module, so they are small in this process only; shards and cells are many
    tables = A.pair_tables(df)
    assert tables.shards.count() > 3 and tables.n_groups > 2
    got = sorted([tuple(r[c] for c in COLUMNS) for r in tables.documents().collect()], key=str)
    assert got == want
    assert {(r["a"], r["b"]): r["n"] for r in tables.pairs().collect()} == dict(total)


def test_several_blocks_in_a_task(pair, monkeypatch):
    """Blocks of one task hold all pairs between them, each block its own."""
    monkeypatch.setattr(A, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(A, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(A.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda self: 3})()))
    rows = [(i, prose(60, i)) for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["i", "t"])
    paths = (public_tokenizers.path(A.A_FILE), public_tokenizers.path(A.B_FILE))
    out = [r for b in A._encode(paths)(iter([batch])) for r in b.to_pylist()]
    assert [i for r in out if r["ids"] for i in r["ids"]] == list(range(60))
    ends = [r for r in out if r["keys"]]
    assert len(ends) > 2 and {r["block"] for r in out} == {r["block"] for r in ends}
    total = Counter()
    for r in ends:
        for k, n in zip(A._unpress_sorted(r["keys"]).tolist(), A._unpressed(r["counts"], np.int64).tolist()):
            total[(k >> 32, k & 0xFFFFFFFF)] += n
    assert total == plain(rows)[1]


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        found = A.PerfectHash.from_bytes(A.PerfectHash.build(keys).to_bytes())
        assert found.size == len(keys) and sorted(found.numbers(keys).tolist()) == list(range(len(keys)))
    table = A.Table({"hash": found.to_bytes(), "pairs": A._pressed(keys[np.argsort(found.numbers(keys))])})
    with pytest.raises(ValueError):
        table.numbers(np.array([1 << 50], np.uint64))


def test_words_apart_is_the_library(pair, sample):
    """Encoding word by word gives the libraries' own ids."""
    texts = [r[0] for r in sample.select("text").where("text is not null and text <> ''").collect()]
    a, b = pair.encode(pa.array(texts))
    assert [x.tolist() for x in a] == [x.ids for x in pair.a.encode_batch([" " + t for t in texts],
                                                                           add_special_tokens=False)]
    assert [x.tolist() for x in b] == pair.b.encode(texts)


def test_empty(spark, nothing):
    assert aligned(nothing) == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert aligned(none) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_is_whole(spark, sample):
    from fleetlens.llm.queries import op13_alignment
    got = op13_alignment(spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect()]
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got.collect()], key=str) == plain(rows)[0]
    assert got.where(F.col("n_links") != F.col("n_a") + F.col("n_b") - F.col("n_groups")).count() == 0
