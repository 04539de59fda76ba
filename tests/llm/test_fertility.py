"""Quality rules against plain counts."""

import math
import re
from collections import Counter

import pyarrow as pa

from fleetlens.llm import fertility
from tests.llm.conftest import odd_documents, prose


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(sample, odd):
    for docs in (sample, odd):
        rows = fertility.fertility_signals(docs).select("_row.doc_id", "_text", "signals.*").collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r[c] for c in BASE) == plain_counts(r["_text"]), r["doc_id"]
            assert not (r["kept"] and r["base_failed"])


def test_token_figures_follow_the_vocabulary(odd):
    sp, is_byte = fertility._vocabulary(fertility.default_vocabulary())
    for r in fertility.fertility_signals(odd).select("_text", "signals.*").collect():
        ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", r["_text"] or "") for i in sp.encode(w)]
        assert r["n_tokens"] == len(ids)
        if ids:
            assert r["byte_share"] == sum(map(bool, is_byte[ids])) / len(ids)
            assert abs(r["chars_per_token"] - r["word_chars"] / len(ids)) < 1e-12


def test_bands(spark):
    clean = prose(400, 1)
    texts = {"clean": clean, "symbols": " ".join(w + "***" for w in clean.split()), "list": clean.replace(" ", " | "),
             "one phrase": " ".join(f"again and again {i % 7}" for i in range(200))}
    rows = [(i, t, "en") for i, t in enumerate(texts.values())]
    band = fertility.Band(1.8, 6.5, 0.02, 0.70)
    got = fertility.fertility_signals(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                                      bands={"en": band}).select("_row.doc_id", "signals.*").collect()
    entropy = {list(texts)[r["doc_id"]]: r["token_entropy"] for r in got}
    assert entropy["clean"] > entropy["list"] > entropy["one phrase"]
    assert entropy["clean"] > entropy["symbols"]


def test_labelled_clean_documents_stay(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = (fertility.fertility_signals(spark.read.parquet(f"{d}/documents.parquet"), keep=["doc_id"])
            .select("_row.doc_id", "signals.*").join(labels, "doc_id").where("not base_failed").collect())
    clean = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) == len(clean)
    assert sum(junk) <= 0.1 * len(junk)


def test_script_of_unknown_languages(odd):
    names = {r["doc_id"]: r["band"] for r in fertility.fertility_signals(odd).select("_row.doc_id", "signals.band").collect()}
    assert names[13] == "cyrillic" and names[14] == "han" and names[5] == "other"


def test_filter_keeps_rows_as_they_are(odd, nothing):
    kept = fertility.keep_fluent(odd, bands={})  # by script: the test's prose has few words
    assert kept.columns == odd.columns
    inputs = {str(r) for r in odd.collect()}
    rows = kept.collect()
    assert rows and all(str(r) in inputs for r in rows)
    assert sum(r["doc_id"] == 3 for r in rows) == 2  # repeated rows are judged each
    assert fertility.keep_fluent(nothing).count() == 0
    assert len(odd_documents()) == odd.count()


def test_labels_the_floors_were_not_fitted_on(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").where("doc_id % 2 = 1")
    docs = spark.read.parquet(f"{d}/documents.parquet").join(labels, "doc_id")
    rows = (fertility.fertility_signals(docs, keep=["doc_id", "quality"]).select("_row.*", "signals.kept", "signals.base_failed")
            .where("not base_failed").collect())
    assert [r["doc_id"] for r in rows if r["quality"] == 1 and not r["kept"]] == []
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(junk) <= 0.15 * len(junk)


def plain_entropy(ids):
    """Mean over windows of 256 tokens, the last one reaching back, relative
    to the most that a window can have."""
    width = min(len(ids), 256)
    if width < 2:
        return 0.0
    starts = [*range(0, len(ids) - width + 1, width)]
    if len(ids) % width:
        starts.append(len(ids) - width)
    bits = [-sum(n / width * math.log2(n / width) for n in Counter(ids[a:a + width]).values()) for a in starts]
    return sum(bits) / len(bits) / math.log2(width)


def test_entropy_and_verdict(sample, odd):
    """Each text's entropy, band and verdict from loops over its tokens."""
    sp, is_byte = fertility._vocabulary(fertility.default_vocabulary())
    verdicts = Counter()
    for docs in (sample, odd):
        for r in fertility.fertility_signals(docs).select("_row.lang", "_text", "signals.*").collect():
            text = r["_text"] or ""
            ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", text) for i in sp.encode(w)]
            failed = plain_counts(text)[-1]
            if not ids:
                assert r["token_entropy"] is None and not r["kept"]
                continue
            entropy = plain_entropy(ids)
            assert abs(r["token_entropy"] - entropy) < 1e-9
            band = fertility.LANGUAGE_BANDS.get(r["lang"]) or fertility.SCRIPT_BANDS[fertility._script(text)]
            wider = math.sqrt(max(1, 256 / len(ids))) - 1
            chars = sum(len(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)) / len(ids)
            kept = (not failed and band.min_chars_per_token - wider * band.chars_margin <= chars <= 6.5
                    and sum(bool(is_byte[i]) for i in ids) / len(ids) <= band.max_byte_share
                    and entropy >= band.min_entropy - wider * band.entropy_margin)
            assert r["kept"] == kept
            verdicts[(failed, kept)] += 1
    assert all(verdicts[k] for k in ((True, False), (False, True), (False, False)))


def test_fitting_gives_the_bands(spark, nothing):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").where("doc_id % 2 = 0 and quality = 1").select("doc_id")
    clean = spark.read.parquet(f"{d}/documents.parquet").join(labels, "doc_id", "left_semi")
    bands = fertility.fit_bands(clean)
    assert set(bands) == set(fertility.LANGUAGE_BANDS)
    for lang, band in bands.items():
        want = fertility.LANGUAGE_BANDS[lang]
        assert abs(band.min_chars_per_token - want.min_chars_per_token) < 0.02
        assert abs(band.min_entropy - want.min_entropy) < 0.005
    assert fertility.fit_bands(nothing) == {}


def test_the_processor_gets_some_words_at_a_time(monkeypatch):
    """Its lists of Python numbers take many times the room of the tokens."""
    sp, is_byte = fertility._vocabulary(fertility.default_vocabulary())
    calls = []

    class Counted:
        def encode(self, words):
            calls.append(len(words))
            return sp.encode(words)

    texts = pa.array([" ".join(f"word{i}é" for i in range(a, a + 5000)) for a in (0, 4000, 9000)] + [None, ""])
    args = [texts, ["en"] * len(texts), fertility.default_vocabulary(), fertility.LANGUAGE_BANDS, fertility.SCRIPT_BANDS]
    want = [sum(map(len, sp.encode((t or "").split()))) for t in texts.to_pylist()]
    monkeypatch.setattr(fertility, "_vocabulary", lambda path: (Counted(), is_byte))
    got = fertility.measure(*args)
    assert max(calls) <= 4096 and sum(calls) == 14000
    assert got.field("n_tokens").to_pylist() == want
