"""Token files: round trip, random access, padding."""

import zlib

import numpy as np

from fleetlens.llm import packing, token_files, tokens
from fleetlens.llm.common import shared_path, write_shared
from fleetlens.llm.tokens import byte_level_ids, hf_tokenizer, word_ids
from tests.llm.conftest import odd_documents

import pyarrow as pa
import pytest


def ids_of(text):
    tk = hf_tokenizer(token_files.default_tokenizer())
    return np.array([*tk.encode(text or "", add_special_tokens=False).ids, token_files.END_ID], "<u4")


def test_round_trip(sample):
    at = 0
    rows = {r["doc_id"]: r for r in token_files.encode_and_read_back(sample.repartition(3)).collect()}
    for r in sample.orderBy("doc_id").collect():
        ids, got = ids_of(r["text"]), rows[r["doc_id"]]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_odd_rows(odd, nothing):
    rows = token_files.encode_and_read_back(odd, length=64).collect()
    key = lambda d, n, crc: (d is None, d or 0, n, crc)
    want = [(r["doc_id"], ids_of(r["text"])) for r in odd.collect()]
    assert sorted(key(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(
        key(d, len(x), zlib.crc32(x.tobytes())) for d, x in want)
    by_start = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == [0, *np.cumsum([r["n_tokens"] for r in by_start])[:-1]]
    ids = [r["doc_id"] for r in by_start]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))
    assert token_files.encode_and_read_back(nothing).count() == 0


def test_sequences_are_views_of_the_file(sample):
    folder = shared_path(sample.sparkSession, "test-tokens")
    manifest = write_shared(token_files.write_token_files(sample.repartition(2), folder, length=128), "m").collect()
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    stream = np.concatenate([ids_of(texts[d]) for d in sorted(texts)])
    done = 0
    for m in sorted(manifest, key=lambda m: m["part"]):
        f = token_files.SequenceFile(m["sequences"])
        own = stream[done:done + m["n_tokens"]]
        done += m["n_tokens"]
        assert m["n_sequences"] == -(-len(own) // 128)
        for i in (0, m["n_sequences"] // 2, m["n_sequences"] - 1):
            ids, real, ends = f.sequence(i)
            part = own[i * 128:(i + 1) * 128]
            assert len(ids) == len(real) == len(ends) == 128 and not ids.flags.owndata
            assert ids[:len(part)].tolist() == part.tolist() and sum(real.to_pylist()) == len(part)
    assert done == len(stream)


@pytest.mark.parametrize("name, encode", [("byte_bpe_50k.json", byte_level_ids), ("word_bpe_49k.json", word_ids)])
def test_word_wise_ids_are_the_tokenizers(sample, name, encode):
    import public_tokenizers
    path = public_tokenizers.path(name)
    texts = [r["text"] for r in sample.collect()] + [r[1] for r in odd_documents() if r[1] is not None and len(r[1]) < 5000]
    texts += ["", " a", "a ", "a\n", "\n", "a\n\n\nb", "İstanbul ΣΑΣ ς éx ́y", "a\xa0b \xa0 c", "don't 'll 3.14", "a\t b", "A. B, c.d e. . .f, ",
              "Foo.\nBar, baz.\n\nX.", "é. É, ß. Ñ.", "<|ENDOFTEXT|> x", "\x01. a", "A.", "a.\tb, ", "...a... b..", "x\x01 y"]
    want = hf_tokenizer(path).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in encode(pa.array(texts), path)] == [e.ids for e in want]


def test_signs_and_line_breaks_are_cut_as_the_tokenizer_cuts_them():
    path = packing.default_tokenizer()
    texts = ["walked### walked&&& walked,*** (see) x's' x's'. 'tis' don't's. 12%, 4th% ok<> a<| b<|endoftext|> c",
             "é### É&&&\nÉté,\nx's'.\n's\n12\n¿qué?\nñ, ª. º, µ% ² ½, ß\"", "a—, b,— c´. d\x7f, e'll' f're, g'", "x%", "%x%", "`a` ~b~ {c} [d]\n[e]",
             "a.\nb,\nc#", "Ω, Ж. 漢# ́, é́,"]
    want = hf_tokenizer(path).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in byte_level_ids(pa.array(texts), path)] == [e.ids for e in want]


def test_words_that_come_back_are_encoded_once():
    calls = []

    def encode(words):
        calls.extend(words)
        return [np.array([ord(w[-1])], "<u4").tobytes() for w in words]

    cache = tokens.RecentWords(encode, limit=4)
    for words in ("a b c", "a b c d", "e f a", "a e b", "g h a"):  # each once in its chunk
        found = cache.ids(pa.array(words.split(), pa.large_string()).dictionary_encode())
        assert found.flat.tolist() == [ord(w) for w in words.split()]
        assert len(cache.known) <= 4 and len(cache.older) <= 4 + 3
    assert sorted(calls) == [*"abcdefgh"]


def test_a_word_and_signs_behind_it_are_encoded_apart(monkeypatch):
    calls = []
    path = packing.default_tokenizer()
    encode = tokens._hf_words(path, " ")
    cache = tokens.RecentWords(lambda words: calls.extend(words) or encode(words))
    monkeypatch.setattr(tokens, "_spaced_words_of", lambda path: cache)
    byte_level_ids(pa.array(["river### river&&& river$$$ stone### stone&&& stone$$$ river stone"]), path)
    assert {"river", "stone"} < set(calls) and len(calls) <= 7  # three runs of signs; the cut and the break in front


def test_batches_are_gathered_up_to_a_size():
    batches = [pa.record_batch([pa.array([i]), pa.array(["x" * n])], ["a", "b"]) for i, n in enumerate([100, 100, 5000, 10, 10, 2000])]
    found = [*tokens.gathered(iter(batches), 1, 1000)]
    assert [b.column(0).to_pylist() for b in found] == [[0, 1], [2], [3, 4], [5]]
    assert [*tokens.gathered(iter([]), 1)] == []


def test_long_words_fill_a_generation_sooner():
    cache = tokens.RecentWords(lambda words: [b"1234" for _ in words], limit=10)
    for i in range(20):
        cache.ids(pa.array([str(i) + "x" * 300], pa.large_string()).dictionary_encode())
        assert len(cache.known) <= 2 and len(cache.older) <= 3
    assert cache.ids(pa.array([], pa.large_string()).dictionary_encode()).flat.tolist() == []
