"""The pipeline, stage by stage and as a whole."""

import importlib
import re
import sys
from collections import Counter, defaultdict

import corpus_pipeline
from fleetlens.llm import fertility, mixing, simhash
from tests.llm.test_simhash import plain_components, plain_fingerprint

D = "/root/testdata/sf0.001"


def check_sequences(packed, texts, times):
    """The rows alone give the sequences, and each copy's whole text."""
    import public_tokenizers
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sequences, rows = defaultdict(list), defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], list(r["ids"])))
        rows[(r["doc_id"], r["row_id"])].append((r["piece"], list(r["ids"])))
    for parts in sequences.values():
        at = 0
        for offset, ids in sorted(parts):
            assert offset == at
            at += len(ids)
        assert at <= 1024
    assert Counter(d for d, _ in rows) == times
    for (d, _), parts in rows.items():
        assert [k for k, _ in sorted(parts)] == list(range(len(parts)))
        assert [i for _, ids in sorted(parts) for i in ids] == [
            *tk.encode(texts[d] or "", add_special_tokens=False).ids, 2]


def test_stages(spark, sample):
    docs, columns = sample, sample.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, D).cache()
        after[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns, name
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    quality, lines, unique, mixed, packed = after.values()
    assert {r["doc_id"]: r["text"] for r in quality}.items() <= texts.items()
    signals = {r["doc_id"]: r["kept"] for r in fertility.fertility_signals(sample, keep=["doc_id"])
               .select("_row.doc_id", "signals.kept").collect()}
    assert {r["doc_id"] for r in quality} == {i for i, kept in signals.items() if kept} and not all(signals.values())
    assert {r["doc_id"] for r in lines} == {r["doc_id"] for r in quality}
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    groups = plain_components(sorted((r["doc_id"], plain_fingerprint(r["text"])) for r in lines))
    assert sorted(r["doc_id"] for r in unique) == sorted(set(groups.values()))
    times = Counter(r["doc_id"] for r in mixed)
    assert set(times) <= {r["doc_id"] for r in unique} and max(times.values()) <= mixing.MAX_COPIES
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == times
    check_sequences(packed, {r["doc_id"]: r["text"] for r in mixed}, times)
    whole = corpus_pipeline.run(spark, D)
    assert whole.columns == docs.columns and whole.count() == len(packed)


def test_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, D)
            assert out.count() >= 0
            if name == "best_fit_packing":
                assert out.columns[:3] == ["doc_id", "row_id", "piece"]
            else:
                assert out.columns == docs.columns
                docs = out


def test_registered_when_present():
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline"} == set(range(1, 14))
    assert "pipeline" in names and simhash.MAX_BITS == 3
