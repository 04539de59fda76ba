"""The chain model against sums over all label sequences, and the learned
labels against held-out and code-switched texts."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import lang_crf as C

TABLES = "/root/testdata/sf0.01"


def plain_marginals(emission, moves):
    """Probabilities from every sequence of labels of one chain."""
    n, k = emission.shape
    total, out = 0.0, np.zeros((n, k))
    enter = np.log(np.exp(moves).mean(axis=0))
    for seq in itertools.product(range(k), repeat=n):
        w = enter[seq[0]] + sum(emission[i, s] for i, s in enumerate(seq))
        w = np.exp(w + sum(moves[a, b] for a, b in zip(seq, seq[1:])))
        total += w
        out[range(n), seq] += w
    return out / total


@pytest.mark.parametrize("segment", [1, 2, 3, 32])
def test_forward_backward_is_the_sum_over_all_sequences(monkeypatch, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    lengths = np.array([1, 5, 2, 7, 1, 3])
    emission, moves = rng.normal(size=(lengths.sum(), 3)) * 2, rng.normal(size=(3, 3))
    before, after = C.forward_backward(emission, lengths, moves)
    got, at = C.posteriors(before, after, moves), 0
    for n in lengths:
        assert np.allclose(got[at:at + n], plain_marginals(emission[at:at + n], moves))
        at += n


def test_long_chains_stay_finite():
    rng = np.random.default_rng(1)
    emission = rng.normal(size=(100_000, 4)) * 60
    p = C.posteriors(*C.forward_backward(emission, np.array([100_000]), rng.normal(size=(4, 4)) * 5),
                     np.zeros((4, 4)))
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1)


def test_gradient_is_that_of_the_likelihood():
    """One small step along the gradient raises the likelihood as its slope says."""
    rng = np.random.default_rng(2)
    emission, moves = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    truth = np.array([0, 1, 1, 0, 1, 0])

    def likelihood(e, m):
        weights = []
        for seq in itertools.product(range(2), repeat=6):
            enter = np.log(np.exp(m).mean(axis=0))
            weights.append(enter[seq[0]] + sum(e[i, s] for i, s in enumerate(seq))
                           + sum(m[a, b] for a, b in zip(seq, seq[1:])))
        own = np.log(np.exp(m).mean(axis=0))[truth[0]] + sum(e[i, s] for i, s in enumerate(truth))
        own += sum(m[a, b] for a, b in zip(truth, truth[1:]))
        return own - np.log(np.exp(weights).sum())

    p = C.posteriors(*C.forward_backward(emission, np.array([6]), moves), moves)
    error = -p
    error[np.arange(6), truth] += 1
    for i, k in ((0, 0), (3, 1), (5, 0)):
        moved = emission.copy()
        moved[i, k] += 1e-6
        assert abs((likelihood(moved, moves) - likelihood(emission, moves)) / 1e-6 - error[i, k]) < 1e-4


def test_words_and_places():
    texts = [None, "", "Ab, cd-é1x", "  ", "ÄÖ"]
    words = C.Words(texts)
    assert [(int(d), texts[d][s:e]) for d, s, e in zip(words.doc, words.start, words.end)] == [
        (2, "Ab"), (2, "cd"), (2, "é"), (2, "x"), (4, "ÄÖ")]
    lower = C.Words(["ab cd é x äö"])
    assert (words.hashes() == lower.hashes()).all() and (words.grams() == lower.grams()).all()
    some = np.array([3, 0, 4])
    assert (words.take(some).hashes() == words.hashes()[some]).all()
    assert (words.take(some).affixes() == words.affixes()[:, some]).all()


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    return C.fit(docs, "text", F.col("lang"), F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def test_held_out_texts(spark, model):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").where(
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & F.col("lang").isNotNull())
    rows = C.predict(docs, model, keep=["lang"]).select("_row.lang", "language.*").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)
    assert all(0 < r["score"] <= 1 for r in rows)


def test_words_of_code_switched_texts(spark, model):
    """Spans of held-out texts of two languages, one after another: nearly all
    words get their own span's language."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").where(
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & F.col("lang").isNotNull())
    by = {}
    for r in docs.select("lang", "text").orderBy("doc_id").collect():
        by.setdefault(r["lang"], []).append(r["text"].split())
    langs, right, total, switches = sorted(by), 0, 0, 0
    for i in range(20):
        a, b = langs[i % len(langs)], langs[(i + 1) % len(langs)]
        parts = [(a, by[a][i % len(by[a])][:25]), (b, by[b][i % len(by[b])][:25]), (a, by[a][(i + 1) % len(by[a])][:25])]
        text, truth = "", []
        for lang, ws in parts:
            for w in ws:
                truth.append((len(text), len(text) + len(w), lang))
                text += w + " "
        found = C.label_texts(model, [text]).to_pylist()[0]
        switches += len(found["spans"]) >= 3
        for s, e, lang in truth:
            if any(c.isalpha() for c in text[s:e]):
                total += 1
                right += any(x["lang"] == lang for x in found["spans"] if x["start"] < e and s < x["end"])
    assert right >= 0.9 * total and switches >= 15


def test_learned_moves_favour_staying(model):
    assert all(model.moves[i, i] > model.moves[i, j] for i in range(4) for j in range(4) if i != j)


def test_learning_again_gives_the_same(spark, model):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").repartition(7)
    again = C.fit(docs, "text", F.col("lang"), F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    assert (again.weights == model.weights).all() and (again.moves == model.moves).all()


def test_batches_change_nothing(model, sample):
    texts = [r[0] for r in sample.select("text").collect()]
    whole = C.label_texts(model, texts).to_pylist()
    apart = [C.label_texts(model, [t]).to_pylist()[0] for t in texts]
    for a, b in zip(whole, apart):
        assert a["lang_pred"] == b["lang_pred"] and a["n_words"] == b["n_words"]
        assert abs(a["score"] - b["score"]) < 1e-9


def test_odd_documents(odd, model):
    rows = C.predict(odd, model, keep=["doc_id", "text"]).select("_row.*", "language.*").collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in model.labels and 0 < r["score"] <= 1) if letters else \
            (r["lang_pred"], r["score"], r["n_words"], r["spans"]) == ("und", 0.0, 0, [])
        assert sum(1 for s in r["spans"] if s["start"] >= s["end"]) == 0


def test_nothing_to_learn_and_empty(spark, odd, nothing):
    for docs, learn in ((nothing, F.lit(True)), (odd, F.lit(False))):
        model = C.fit(docs, "text", F.col("lang"), learn)
        rows = C.predict(docs, model, keep=["doc_id"]).select("language.*").collect()
        assert len(rows) == docs.count() and all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows)


def test_one_language(odd):
    model = C.fit(odd, "text", F.col("lang"), F.col("lang") == "en")
    assert model.labels == ["en"]
    found = C.label_texts(model, ["a word", None])
    assert found.to_pylist()[0]["lang_pred"] == "en" and found.to_pylist()[0]["score"] == 1.0


def test_query(spark):
    from fleetlens.llm.queries import op11_language
    rows = op11_language(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and {r["held_out"] for r in rows} == {True, False}
    assert {r["lang_pred"] for r in rows} <= {"de", "en", "es", "fr", "und"}
