"""Packing: every id once, gapless, close to the bound."""

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from fleetlens.llm import packing
from fleetlens.llm.tokens import hf_tokenizer
from tests.llm.conftest import prose


def ids_of(text):
    tk = hf_tokenizer(packing.default_tokenizer())
    return np.array([*tk.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


def check(docs, **options):
    rows = packing.pack(docs, **options).collect()
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append(ids_of(r["text"]))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    length = options.get("length", packing.LENGTH)
    for d, texts in want.items():
        got = sorted((p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces[d])
        expected = []
        for ids in texts:
            cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
            expected += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert got == sorted(expected)
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= length
    total = sum(r["length"] for r in rows)
    return len(bins), -(-total // length)


def test_whole_texts(sample):
    used, bound = check(sample.repartition(5))
    assert used <= 1.06 * bound


def test_rounds_join_what_partitions_leave(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(40)
    used, bound = check(docs, group=50)  # several rounds
    assert used <= 1.03 * bound


def test_odd_rows(odd, nothing):
    check(odd)
    assert packing.pack(nothing).count() == 0


def test_ids_are_given_on_request(sample):
    r = packing.pack(sample, with_ids=True).first()
    assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


class OneTask:
    """Stands for a frame and a task's context: keeps the task's function."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def get(self):
        return self

    def partitionId(self):
        return 3


def one_task(monkeypatch, **options):
    task = OneTask()
    monkeypatch.setattr(packing, "TaskContext", task)
    monkeypatch.setattr(packing, "bounded_batches", lambda docs: docs)
    return packing.pack_partitions(task, "doc_id", "text", packing.default_tokenizer(), **options).run


def batches_of(texts, rows):
    for at in range(0, len(texts), rows):
        part = texts[at:at + rows]
        yield pa.RecordBatch.from_arrays([pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.string())],
                                         ["doc_id", "text"])


def test_a_task_holds_its_ids_once(spark, monkeypatch):
    run = one_task(monkeypatch, with_ids=True)
    texts = [prose(1200, k) for k in range(50)] * 24
    list(run(batches_of(texts[:100], 50)))  # words are known from here on
    tracemalloc.start()
    n = 0
    for out in run(batches_of(texts, 50)):
        n += sum(out.column("length").to_pylist())
        assert out.num_rows <= 512 and out.get_total_buffer_size()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 2_000_000 < n < packing.HELD_IDS
    assert peak < 2.5 * 4 * n


def test_parts_end_anywhere(spark, monkeypatch):
    """The ids are right wherever a part ends: within a batch or a chunk, at
    its end, at a null, an empty or a long text."""
    monkeypatch.setattr(packing, "HELD_IDS", 3000)
    monkeypatch.setattr(packing, "CHUNK_WITH_IDS", 4000)
    texts = [prose(n, n) for n in (5, 700, 2500, 1, 40)] + [None, "", " <|endoftext|> a  b"] + [prose(9, k) for k in range(400)]
    for with_ids in (True, False):
        got, bins = defaultdict(list), defaultdict(list)
        for out in one_task(monkeypatch, with_ids=with_ids)(batches_of(texts, 90)):
            for r in out.to_pylist():
                got[r["doc_id"]].append(r)
                bins[r["bin"]].append((r["place"], r["length"], r["fill"]))
        assert len({r["row_id"] for rows in got.values() for r in rows}) == len(got) == len(texts)
        for d, rows in got.items():
            ids, rows = ids_of(texts[d]), sorted(rows, key=lambda r: r["piece"])
            assert [r["start"] for r in rows] == [0, *np.cumsum([r["length"] for r in rows])[:-1]]
            assert sum(r["length"] for r in rows) == len(ids)
            for r in rows:
                own = ids[r["start"]:r["start"] + r["length"]]
                assert r["ids_crc32"] == zlib.crc32(own.tobytes()) and (not with_ids or r["ids"] == own.tolist())
        for items in bins.values():
            assert [p for p, _, _ in sorted(items)] == [0, *np.cumsum([n for _, n, _ in sorted(items)])[:-1]]
            assert {f for _, _, f in items} == {sum(n for _, n, _ in items)} and items[0][2] <= packing.LENGTH


def test_best_fit_prefers_the_tightest_bin():
    bins, offsets, fill = packing.best_fit(np.array([6, 7, 3, 4, 1, 9]), 10)
    assert sorted(fill) == [10, 10, 10]
