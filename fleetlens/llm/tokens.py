"""Encoders over public vocabularies that encode each distinct word once.

White space bounds the pieces of the vocabularies used here, so a text's ids
are the ids of its words one after another.  A batch of texts is split and
numbered in Arrow; only words that are new to the worker process go to the
tokenizer library, and the process keeps a bounded cache of their ids.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 200_000  # entries of a worker's cache
RECENT_WORDS = 150_000  # entries of each of its two generations, where all words are kept
ENTRY_BYTES = 64  # of a word and its ids, on average, in a full generation
CHUNK_BYTES = 8 << 20  # text encoded at a time


class Ids:
    """Rows of ids, one after another: row ``i`` is ``flat[at[i]:at[i + 1]]``."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat = flat
        self.at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.at[i]:self.at[i + 1]]

    def take(self, rows: np.ndarray) -> Ids:
        """The rows of these numbers, repeats included."""
        lengths = (self.at[1:] - self.at[:-1])[rows]
        out = Ids(self.flat[:0], lengths)
        shift = np.repeat(self.at[:-1][rows] - out.at[:-1], lengths)
        out.flat = self.flat[shift + np.arange(len(shift))]
        return out


class WordCache:
    """Word -> its ids as the bytes of an unsigned 32-bit array."""

    def __init__(self, encode_words, limit: int = CACHE_WORDS):
        self.encode_words, self.limit, self.dtype = encode_words, limit, np.dtype("u4")
        self.known: dict[str, bytes] = {}

    def ids(self, words: pa.DictionaryArray) -> Ids:
        """Ids of each of the dictionary's words.  Words that come twice are
        kept; most others never come back."""
        parts = self.parts(words, words.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        return Ids(np.frombuffer(b"".join(parts), self.dtype), lengths)

    def parts(self, words: pa.DictionaryArray, distinct: list[str]) -> list[bytes]:
        parts = [*map(self.known.get, distinct)]
        missing = [i for i, x in enumerate(parts) if x is None]
        new = self.encode_words([distinct[i] for i in missing])
        for i, x in zip(missing, new):
            parts[i] = x
        if missing:
            often = np.bincount(numbers(words), minlength=len(distinct))[missing] > 1
            keep = [(distinct[i], parts[i]) for i, o in zip(missing, often.tolist()) if o]
            if len(self.known) + len(keep) > self.limit:
                self.known = {}
            self.known.update(keep)
        return parts


class RecentWords(WordCache):
    """A cache of all words met lately, in two generations of ``limit``: a word
    found in the older one moves to the younger, and a full younger one takes
    the place of the older.  Words that go on coming back are never encoded
    again, and no flush loses them all.  Long words fill a generation sooner:
    it is full at ``ENTRY_BYTES * limit`` bytes, too."""

    def __init__(self, encode_words, limit: int = RECENT_WORDS):
        super().__init__(encode_words, limit)
        self.older: dict[str, bytes] = {}
        self.held = 0  # characters and bytes of ids in the younger one

    def parts(self, words: pa.DictionaryArray, distinct: list[str]) -> list[bytes]:
        parts = [*map(self.known.get, distinct)]
        absent = [i for i, x in enumerate(parts) if x is None]
        names = [distinct[i] for i in absent]
        found = [*map(self.older.get, names)]
        new = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(new, self.encode_words([names[k] for k in new])):
            found[k] = x
        for i, x in zip(absent, found):
            parts[i] = x
        self.known.update(zip(names, found))
        self.held += sum(map(len, names)) + sum(map(len, found))
        if len(self.known) > self.limit or self.held > ENTRY_BYTES * self.limit:
            self.older, self.known, self.held = self.known, {}, 0
        return parts


def text_chunks(texts: pa.Array, size: int = CHUNK_BYTES):
    """Consecutive slices ``(start, slice)`` of about ``size`` bytes of text."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def gathered(batches: Iterator[pa.RecordBatch], column: int, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive batches put together up to ``size`` bytes of ``column``: the
    more text is encoded at a time, the fewer times a word is looked up."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if held and total + batch.column(column).nbytes > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += batch.column(column).nbytes
    if held:
        yield pa.concat_batches(held)


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The ASCII-space-separated words of all texts, numbered, and the number
    of words of each text."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, np.int64)
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    before = np.concatenate([[0], np.cumsum(full, dtype=np.int64)])
    offsets = offsets - offsets[0]
    return flat.filter(pa.array(full)).dictionary_encode(), before[offsets[1:]] - before[offsets[:-1]]


def numbers(words: pa.DictionaryArray) -> np.ndarray:
    return np.asarray(words.indices, np.int64)


@lru_cache(maxsize=4)
def hf_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


# A full stop or comma behind a letter, at the end of a word: a piece of its own
# for every pre-tokenizer used here, so it is cut off and more words are equal.
_STOPS = r"(\pL)([.,])(\s|$)"
# Of byte-level ones, so is any run of ASCII signs there.
_TAILS = r"(\pL)([!-/:-@\[-`{-~]+)(\s|$)"
BARE = "\x01"  # put before a piece that has no space before it

# One run of Latin letters is one piece, so the BPE model can be asked directly.
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


@lru_cache(maxsize=1)
def _byte_chars() -> dict[int, int]:
    """The printable character that stands for each byte in byte-level BPE:
    itself if it is printable and no space, else the next one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


def _hf_words(path: str, prefix: str = "", lower: bool = False):
    """Encoder of single words.  ``lower``: the vocabulary's normalizer is NFC
    and lower case, and ASCII letters are lower case already."""
    tk = hf_tokenizer(path)
    tokenize, chars = tk.model.tokenize, _byte_chars()
    space = "".join(chr(chars[b]) for b in prefix.encode())
    table = "".join(chr(chars[b]) for b in range(256))
    line_break = tk.encode("\n", add_special_tokens=False).ids if prefix else []

    def latin(s: str, before: str = space) -> list[int]:
        s = (s.lower() if lower else s).encode()
        return [t.id for t in tokenize(before + codecs.charmap_decode(s, "strict", table)[0])]

    def odd(s: str) -> list[int]:
        if prefix and s[:1] == "\n" and _LATIN(s, 1):  # the line break is a piece of its own
            return line_break + latin(s[1:], "")
        if prefix:
            s = s[1:] if s[:1] == BARE else s if s[:1] == "\n" else prefix + s
        return tk.encode(s, add_special_tokens=False).ids

    def encode(words: list[str]) -> list[bytes]:
        return [array("I", [t.id for t in tokenize(space + s)] if s.isascii() and s.isalpha()
                      else latin(s) if _LATIN(s) else odd(s)).tobytes() for s in words]
    return encode


@lru_cache(maxsize=4)
def _words_of(path: str) -> WordCache:
    return WordCache(_hf_words(path, lower=True))


@lru_cache(maxsize=4)
def _spaced_words_of(path: str) -> WordCache:
    return RecentWords(_hf_words(path, " "))


def _whole_rows(texts: pa.Array, whole: np.ndarray, path: str) -> tuple[list, np.ndarray]:
    """Rows for the texts that are encoded as they are, and the other rows'
    numbers."""
    out: list = [None] * len(texts)
    for i in np.flatnonzero(whole):
        out[i] = np.asarray(hf_tokenizer(path).encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
    return out, np.flatnonzero(~whole)


def _word_rows(texts: pa.Array, path: str) -> list[np.ndarray]:
    out, rest = _whole_rows(texts, np.asarray(pc.match_substring(texts, "<|")), path)
    if len(rest):
        part = pc.ascii_lower(pc.replace_substring_regex(texts.take(pa.array(rest)), _STOPS, r"\1 \2\3"))
        words, counts = split_words(part)
        flat = _words_of(path).ids(words).take(numbers(words))
        ends = np.concatenate([[0], np.cumsum(counts)])
        for i, a, b in zip(rest, ends, ends[1:]):
            out[i] = flat.flat[flat.at[a]:flat.at[b]]
    return out


def word_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of whole texts under a vocabulary that drops white space, whose
    normalizer is NFC and lower case."""
    return [r for _, part in text_chunks(texts) for r in _word_rows(part, path)]


# What keeps a byte-level text from being cut before single spaces and line
# breaks: runs of white space, other white space, possible special tokens.
_UNCUTTABLE = (r"[\x01\t\v\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
               r"\x{205f}\x{3000}]|[ \n][ \n]|^[ \n]|[ \n]$|^$|<\|")


def _byte_level_rows(texts: pa.Array, path: str) -> list[np.ndarray]:
    out, rest = _whole_rows(texts, np.asarray(pc.match_substring_regex(texts, _UNCUTTABLE)), path)
    if len(rest):
        part = pc.replace_substring_regex(texts.take(pa.array(rest)), _TAILS, rf"\1 {BARE}\2\3")
        # a line break put before each text stands in for the space that its
        # first word lacks; it is one id, dropped below
        part = pc.binary_join_element_wise("\n", part, "").cast(pa.large_string())
        lists = pc.split_pattern(pc.replace_substring(part, "\n", " \n"), " ")
        words = lists.flatten().dictionary_encode()
        flat = _spaced_words_of(path).ids(words).take(numbers(words))
        ends = np.asarray(lists.offsets, np.int64)
        ends = ends - ends[0]
        for i, a, b in zip(rest, ends, ends[1:]):
            out[i] = flat.flat[flat.at[a + 1] + 1:flat.at[b]]  # behind the empty cut and the line break
    return out


def byte_level_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of whole texts under a byte-level BPE file."""
    return [r for _, part in text_chunks(texts) for r in _byte_level_rows(part, path)]
