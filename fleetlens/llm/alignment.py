"""Alignment of two tokenizers, with counts of the id pairs that they link.

Both tokenizers cut the same bytes, so the tokens of a text lie on one line:
two tokens are linked if their byte ranges overlap, and the places where both
end cut the text into groups.  How often a link's id pair is linked over the
whole corpus says how usual it is.

1. First pass: documents are encoded and aligned in chunks of bounded size.  A
   block of documents hands on its token ids, compressed, and its distinct
   pairs with their number in the block.
2. The distinct pairs of all blocks meet in shards of the second id (a tree of
   unions); each shard builds a minimal perfect hash, a number from 0 to n - 1
   for each of its n pairs, and a table of the pairs by that number.
3. Blocks' numbers become dense count vectors indexed by the hash, which a tree
   of sums adds up, ``FAN`` at a time.  A lookup compares the pair in the table
   with its own, so nothing rests on a hash that a foreign pair could share.
   All pairs of one second id lie in one shard, which marks its highest counts.
4. Blocks' pairs ask the shards for their counts and marks.
5. Second pass: each block's documents are aligned again from their ids and
   each link looks its pair up among the block's answers.

A block sends a pair once however often it holds it, so a frequent pair is no
hot key.  There are at most as many pairs as ids times ids, and ``SHARDS``
shards, so a shard's table is bounded; work on it is cut into cells of about
``CELL`` pairs asked.

Defined results: a text that is NULL, empty or not given back byte for byte by
both tokenizers has no tokens: zeros and an empty hash.  Rows are taken each
on their own, whatever their ids (repeated rows count again); strings that
look like special tokens are plain text; a very long text is one row; an empty
table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import tokens
from fleetlens.llm.common import bounded_batches, write_shared

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 20  # text aligned at a time
BLOCK_BYTES = 8 << 20  # text of a block
CACHE_WORDS = 40_000  # of each tokenizer, per worker
SHARD, SHARDS = 1 << 20, 1024  # pairs that blocks send to a shard, as a goal; most shards
CELL = 1 << 19  # pairs asked in one cell
FAN = 16  # count vectors added up at a time

_T = "block bigint, ids array<bigint>, sizes binary, body binary, keys binary, counts binary, n_keys bigint"
_OUT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string")


# ---- vocabularies -------------------------------------------------------

class Pieces:
    """The bytes of each id."""

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")

    def join(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        return self.flat[np.repeat(self.at[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Pair:
    """Two tokenizers: ``a`` byte-level BPE (tokenizers), ``b`` BPE with byte
    fallback (sentencepiece)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = {chr(c): b for b, c in tokens._byte_chars().items()}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_pieces = Pieces([bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode()
                                for s in names])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_pieces = Pieces([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(pieces)])
        # no piece of b goes on behind a space, so words can be encoded apart
        self.words_apart = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.a_words = tokens.WordCache(tokens._hf_words(a_path, " "), CACHE_WORDS)
        self.b_words = tokens.WordCache(self._b_words, CACHE_WORDS)

    def _b_words(self, words: list[str]) -> list[bytes]:
        """Ids of words behind a space; of those that start with a line break
        or :data:`tokens.BARE`, without one."""
        def of(s: str) -> str:
            return "\n" + s[1:] if s[:1] == tokens.BARE else s
        drop = [2 if s[:1] == tokens.BARE else 1 if s[:1] == "\n" else 0 for s in words]
        return [array("I", ids[d:]).tobytes()
                for ids, d in zip(self.b.encode([of(s) for s in words], num_threads=1), drop)]

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of a space and the text under ``a``, of the text under ``b``,
        which adds that space itself.  Texts in which single spaces and line
        breaks bound the pieces are encoded word by word, each once."""
        odd = np.asarray(pc.match_substring_regex(texts, tokens._UNCUTTABLE + "|▁"))
        a: list = [None] * len(texts)
        b: list = [None] * len(texts)
        whole = np.flatnonzero(odd) if self.words_apart else np.arange(len(texts))
        some = [texts[int(i)].as_py() for i in whole]
        for i, x, y in zip(whole, self.a.encode_batch([" " + s for s in some], add_special_tokens=False),
                           self.b.encode(some, num_threads=1)):
            a[i], b[i] = np.array(x.ids, np.int64), np.array(y, np.int64)
        rest = np.flatnonzero(~odd) if self.words_apart else whole[:0]
        if len(rest):
            part = pc.replace_substring_regex(texts.take(pa.array(rest)), tokens._STOPS, rf"\1 {tokens.BARE}\2\3")
            lists = pc.split_pattern(pc.replace_substring(part.cast(pa.large_string()), "\n", " \n"), " ")
            words = lists.flatten().dictionary_encode()
            ends = np.asarray(lists.offsets, np.int64)
            ends = ends - ends[0]
            for cache, out in ((self.a_words, a), (self.b_words, b)):
                flat = cache.ids(words).take(tokens.numbers(words))
                for i, s, e in zip(rest, ends, ends[1:]):
                    out[i] = flat.flat[flat.at[s]:flat.at[e]]
        return a, b


@lru_cache(maxsize=2)
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


# ---- alignment of a chunk ----------------------------------------------

@dataclass
class Chunk:
    """Documents one after another: ids of both tokenizers, numbers of tokens
    per document."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    def links(self, pair: Pair) -> None:
        """Where the tokens end, and the links in order: two tokens that
        overlap do so in one range, which ends where either of them ends."""
        end_a, end_b = np.cumsum(pair.a_pieces.length[self.a]), np.cumsum(pair.b_pieces.length[self.b])
        total = int(end_a[-1]) if len(end_a) else 0
        cut_a, cut_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        cut_a[end_a], cut_b[end_b] = True, True
        ends = np.flatnonzero(cut_a | cut_b)
        in_a, in_b = cut_a[ends], cut_b[ends]
        self.both = in_a & in_b  # a group ends with this link
        self.link_a = np.cumsum(in_a) - in_a
        self.link_b = np.cumsum(in_b) - in_b
        common = cut_a & cut_b
        before = np.cumsum(common)
        self.group_a, self.group_b = before[end_a] - common[end_a], before[end_b] - common[end_b]
        # the last link of each document is the one of its last token
        last = np.concatenate([[0], np.cumsum(self.n_a)])
        link_end = np.concatenate([[0], np.cumsum(np.bincount(self.link_a, minlength=len(self.a)))])
        self.n_links = link_end[last[1:]] - link_end[last[:-1]]
        group_end = np.concatenate([[0], np.cumsum(self.both)])
        first = np.concatenate([[0], np.cumsum(self.n_links)])
        self.n_groups = group_end[first[1:]] - group_end[first[:-1]]

    def keys(self) -> np.ndarray:
        return (self.a[self.link_a].astype(np.uint64) << np.uint64(32)) | self.b[self.link_b].astype(np.uint64)

    def group_hashes(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document."""
        n_groups = int(self.both.sum())
        a_in, b_in = (np.bincount(g, minlength=n_groups) for g in (self.group_a, self.group_b))
        a_upto, b_before = np.cumsum(a_in), np.cumsum(b_in) - b_in
        place_a = np.arange(len(self.a)) + b_before[self.group_a]
        place_b = np.arange(len(self.b)) + a_upto[self.group_b]
        number = np.empty(len(self.a) + len(self.b), np.int64)
        number[place_a], number[place_b] = self.a, self.b
        sign = np.full(len(number), ord(","), np.uint8)
        sign[a_upto + b_before - 1] = ord("|")
        sign[a_upto + b_before + b_in - 1] = ord(";")
        width = np.ones(len(number), np.int64)
        for power in range(1, len(str(int(number.max(initial=0))))):
            width += number >= 10 ** power
        stop = np.cumsum(width + 1)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
        out[stop - 1] = sign
        left, at = number, stop - 2
        for d in range(int(width.max(initial=0))):
            here = width > d
            if d:
                out[at[here] - d] = left[here] // 10 ** d % 10 + 48
            else:
                out[at] = left % 10 + 48
        last = np.cumsum(self.n_a + self.n_b)
        hashes, start = [], 0
        view = memoryview(out)
        for n, tokens_end in zip(self.n_a, last):
            if not n:
                hashes.append("")
                continue
            end = int(stop[tokens_end - 1])
            hashes.append(hashlib.sha256(view[start:end - 1]).hexdigest())
            start = end
        return hashes


def encode_chunk(texts: pa.Array, pair: Pair) -> Chunk:
    """Encoded texts; without tokens where one of the tokenizers does not give
    the text's bytes back."""
    texts = pc.fill_null(texts, "")
    a, b = pair.encode(texts)
    raw = texts.cast(pa.large_binary())
    sizes = np.asarray(pc.binary_length(raw), np.int64)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))

    def sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(values)])
        at = np.concatenate([[0], np.cumsum(n)])
        return ends[at[1:]] - ends[at[:-1]]

    flat_a, flat_b = (np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64) for ids in (a, b))
    fit = (sizes > 0) & (sums(pair.a_pieces.length[flat_a], n_a) == sizes + 1)
    fit &= sums(pair.b_pieces.length[flat_b], n_b) == sizes + 1

    def chosen(flat: np.ndarray, n: np.ndarray, good: np.ndarray) -> np.ndarray:
        return flat[np.repeat(good, n)]

    kept = raw.filter(pa.array(fit))
    want = np.frombuffer(b"".join(b" " + x for x in kept.to_pylist()), np.uint8)
    wrong = np.zeros(len(want), np.int64)
    for flat, n, pieces in ((flat_a, n_a, pair.a_pieces), (flat_b, n_b, pair.b_pieces)):
        wrong += pieces.join(chosen(flat, n, fit)) != want
    fit[fit] = sums(wrong, sizes[fit] + 1) == 0
    return Chunk(chosen(flat_a, n_a, fit), chosen(flat_b, n_b, fit), n_a * fit, n_b * fit)


# ---- packed numbers ------------------------------------------------------

def _pressed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpressed(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def _press_sorted(keys: np.ndarray) -> bytes:
    return _pressed(np.diff(keys, prepend=np.uint64(0)))


def _unpress_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpressed(data, np.uint64), dtype=np.uint64)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct keys.

    A level hashes the keys that are left into twice as many places; a key
    alone in its place has found it, the others go down a level.  A key's
    number is the rank of its place among all that are taken."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        taken = [np.cumsum(bits) for bits in levels]
        self.size = sum(int(t[-1]) for t in taken)
        base = np.cumsum([0, *[int(t[-1]) for t in taken]])
        self.rank = [t - 1 + b for t, b in zip(taken, base)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            place = (mixed(keys, len(levels)) % np.uint64(2 * len(keys) + 8)).astype(np.int64)
            n = np.bincount(place, minlength=2 * len(keys) + 8)
            levels.append(n == 1)
            keys = keys[n[place] > 1]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; any number or -1 for a key that is not one of
        the hash's."""
        out = np.full(len(keys), -1)
        left = np.arange(len(keys))
        for i, (bits, rank) in enumerate(zip(self.levels, self.rank)):
            place = (mixed(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
            found = bits[place]
            out[left[found]] = rank[place[found]]
            left = left[~found]
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes()
        return sizes + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<i8", n, 8), 8 + 8 * n, []
        for size in sizes.tolist():
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


class Table:
    """A shard's pairs by their number, with counts and marks."""

    def __init__(self, row: dict):
        self.hash = PerfectHash.from_bytes(row["hash"])
        self.keys = _unpressed(row["pairs"], np.uint64)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        found = self.hash.numbers(keys)
        if not len(self.keys) and len(keys) or (self.keys[found] != keys).any():
            raise ValueError("a pair that is not in its shard's table")
        return found


# ---- first pass ------------------------------------------------------------

def _encode(paths: tuple[str, str]):
    def run(batches):
        pair = tokenizer_pair(*paths)
        schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()),
                            ("body", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()),
                            ("n_keys", pa.int64())])
        block, held = TaskContext.get().partitionId() << 32, 0
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def row(**cols) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([cols.get(f.name)], f.type) for f in schema], schema=schema)

        def totals() -> pa.RecordBatch:
            return row(block=block, keys=_press_sorted(keys), counts=_pressed(counts), n_keys=len(keys))

        for batch in batches:
            texts = batch.column(1)
            for start, part in tokens.text_chunks(texts, CHUNK_BYTES):
                chunk = encode_chunk(part, pair)
                chunk.links(pair)
                new, n = np.unique(chunk.keys(), return_counts=True)
                keys, counts = _added(np.concatenate([keys, new]), np.concatenate([counts, n]))
                press = zstandard.ZstdCompressor(level=3).compress
                body = chunk.a.astype(pair.a_pieces.dtype).tobytes() + chunk.b.astype(pair.b_pieces.dtype).tobytes()
                yield row(block=block, ids=batch.column(0).slice(start, len(part)).to_pylist(), body=press(body),
                          sizes=_pressed(np.concatenate([chunk.n_a, chunk.n_b])))
                held += int(pc.sum(pc.binary_length(part)).as_py() or 0)
                if held >= BLOCK_BYTES:
                    yield totals()
                    block, held = block + 1, 0
                    keys, counts = keys[:0], counts[:0]
        if held or len(keys):
            yield totals()
    return run


# ---- counts ---------------------------------------------------------------

def _dealt(n_shards: int, n_groups: int):
    """A block's pairs by shard of their second id."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                keys, counts = _unpress_sorted(r["keys"]), _unpressed(r["counts"], np.int64)
                shard = mixed(keys & np.uint64(0xFFFFFFFF), 0) % np.uint64(n_shards)
                group = int(mixed(np.array([r["block"]], np.uint64), 1)[0] % np.uint64(n_groups))
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(n_shards + 1, dtype=np.uint64))
                for s in np.flatnonzero(np.diff(cuts)):
                    of = order[cuts[s]:cuts[s + 1]]
                    yield pa.RecordBatch.from_pylist([{
                        "shard": int(s), "grp": group, "block": r["block"], "keys": _press_sorted(keys[of]),
                        "counts": _pressed(counts[of])}], _PARTS)
    return run


_PARTS = pa.schema([("shard", pa.int32()), ("grp", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
                    ("counts", pa.binary())])


def _united(key: tuple, table: pa.Table) -> pa.Table:
    keys = np.zeros(0, np.uint64)
    for data in table["keys"].to_pylist():
        keys = np.union1d(keys, _unpress_sorted(data))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "grp": pa.array([key[1].as_py()], pa.int32()),
                     "keys": pa.array([_press_sorted(keys)], pa.binary())})


def _hashed(batches):
    for batch in batches:
        for r in batch.to_pylist():
            keys = _unpress_sorted(r["keys"])
            found = PerfectHash.build(keys)
            pairs = np.empty_like(keys)
            pairs[found.numbers(keys)] = keys
            yield pa.RecordBatch.from_pylist([{"shard": r["shard"], "hash": found.to_bytes(),
                                               "pairs": _pressed(pairs)}],
                                             pa.schema([("shard", pa.int32()), ("hash", pa.binary()),
                                                        ("pairs", pa.binary())]))


def _vector(parts: pa.Table, tables: pa.Table) -> pa.Table:
    """The dense count vector of a cell."""
    schema = pa.schema([("shard", pa.int32()), ("grp", pa.int32()), ("vector", pa.binary())])
    if not len(parts):
        return schema.empty_table()
    table = Table(tables.slice(0, 1).to_pylist()[0])
    vector = np.zeros(table.hash.size, np.int64)
    for data, counts in zip(parts["keys"].to_pylist(), parts["counts"].to_pylist()):
        vector[table.numbers(_unpress_sorted(data))] += _unpressed(counts, np.int64)
    return pa.Table.from_pylist([{"shard": parts["shard"][0].as_py(), "grp": parts["grp"][0].as_py(),
                                  "vector": _pressed(vector)}], schema)


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    total = np.int64(0)
    for data in table["vector"].to_pylist():
        total = total + _unpressed(data, np.int64)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "grp": pa.array([key[1].as_py()], pa.int32()),
                     "vector": pa.array([_pressed(total)], pa.binary())})


def _tree(df: DataFrame, n: int, combine, schema: str) -> DataFrame:
    """Rows of a shard combined ``FAN`` groups at a time, until one is left."""
    while n > 1:
        n = -(-n // FAN)
        df = (df.withColumn("grp", F.floor(F.col("grp") / FAN).cast("int")).groupBy("shard", "grp")
              .applyInArrow(combine, schema))
    return df


def _marked(batches):
    """The highest counts of each second id."""
    schema = pa.schema([("shard", pa.int32()), ("hash", pa.binary()), ("pairs", pa.binary()),
                        ("vector", pa.binary()), ("marks", pa.binary())])
    for batch in batches:
        for r in batch.to_pylist():
            b = _unpressed(r["pairs"], np.uint64) & np.uint64(0xFFFFFFFF)
            counts = _unpressed(r["vector"], np.int64)
            order = np.lexsort((counts, b))
            last = np.searchsorted(b[order], b, "right") - 1
            marks = counts == counts[order[last]]
            yield pa.RecordBatch.from_pylist([{**r, "marks": np.packbits(marks).tobytes()}], schema)


def _answers(parts: pa.Table, tables: pa.Table) -> pa.Table:
    schema = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
                        ("marks", pa.binary())])
    if not len(parts):
        return schema.empty_table()
    row = tables.slice(0, 1).to_pylist()[0]
    table, counts = Table(row), _unpressed(row["vector"], np.int64)
    marks = np.unpackbits(np.frombuffer(row["marks"], np.uint8), count=len(counts))
    out = []
    for block, data in zip(parts["block"].to_pylist(), parts["keys"].to_pylist()):
        at = table.numbers(_unpress_sorted(data))
        out.append({"block": block, "keys": data, "counts": _pressed(counts[at]), "marks": _pressed(marks[at])})
    return pa.Table.from_pylist(out, schema)


# ---- second pass ------------------------------------------------------------

def _finish(paths: tuple[str, str]):
    names = [c.split()[0] for c in _OUT.split(", ")]

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        pair = tokenizer_pair(*paths)
        schema = pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in names])
        rows = answers.to_pylist()
        keys = np.concatenate([np.zeros(0, np.uint64), *[_unpress_sorted(r["keys"]) for r in rows]])
        counts = np.concatenate([np.zeros(0, np.int64), *[_unpressed(r["counts"], np.int64) for r in rows]])
        marks = np.concatenate([np.zeros(0, np.uint8), *[_unpressed(r["marks"], np.uint8) for r in rows]])
        order = np.argsort(keys)
        keys, counts, marks = keys[order], counts[order], marks[order].astype(np.int64)
        parts = []
        for ids, sizes, body in zip(docs["ids"], docs["sizes"], docs["body"]):
            n_a, n_b = _unpressed(sizes.as_py(), np.int64).reshape(2, -1)
            raw = zstandard.ZstdDecompressor().decompress(body.as_py())
            a = np.frombuffer(raw, pair.a_pieces.dtype, int(n_a.sum())).astype(np.int64)
            b = np.frombuffer(raw, pair.b_pieces.dtype, int(n_b.sum()), len(a) * pair.a_pieces.dtype.itemsize)
            chunk = Chunk(a, b.astype(np.int64), n_a, n_b)
            chunk.links(pair)
            distinct, inverse = np.unique(chunk.keys(), return_inverse=True)
            at = np.searchsorted(keys, distinct)
            if len(distinct) and (at.max() >= len(keys) or (keys[at] != distinct).any()):
                raise ValueError("a block without the counts of its pairs")
            ends = np.concatenate([[0], np.cumsum(chunk.n_links)])
            sums = [(x := np.concatenate([[0], np.cumsum(values[at][inverse])]))[ends[1:]] - x[ends[:-1]]
                    for values in (marks, counts)]
            columns = [ids.as_py(), n_a, n_b, chunk.n_groups, chunk.n_links, *sums, chunk.group_hashes()]
            parts.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
        return pa.concat_tables([schema.empty_table(), *parts])
    return run


def align_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, a_path: str | None = None,
                 b_path: str | None = None) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``."""
    tables = pair_tables(docs, id_col, text_col, a_path=a_path, b_path=b_path)
    return tables.documents()


@dataclass
class PairTables:
    """The corpus-wide counts of linked id pairs, in shards."""

    paths: tuple[str, str]
    encoded: DataFrame
    parts: DataFrame | None
    shards: DataFrame | None
    n_groups: int

    def pairs(self) -> DataFrame:
        """``a, b, n, best``: every linked pair of ids and its count."""
        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    keys, counts = _unpressed(r["pairs"], np.uint64), _unpressed(r["vector"], np.int64)
                    marks = np.unpackbits(np.frombuffer(r["marks"], np.uint8), count=len(counts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((keys >> np.uint64(32)).astype(np.int64)),
                         pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts),
                         pa.array(marks.astype(bool))], ["a", "b", "n", "best"])
        schema = "a bigint, b bigint, n bigint, best boolean"
        if self.shards is None:
            return self.encoded.sparkSession.createDataFrame([], schema)
        return self.shards.mapInArrow(run, schema)

    def documents(self) -> DataFrame:
        docs = self.encoded.where("body is not null").select("block", "ids", "sizes", "body")
        schema = "block bigint, keys binary, counts binary, marks binary"
        if self.parts is None:
            answers = self.encoded.sparkSession.createDataFrame([], schema)
        else:
            answers = _cells(self.parts, self.shards, self.n_groups).applyInArrow(_answers, schema)
        return (docs.groupBy("block").cogroup(answers.groupBy("block"))
                .applyInArrow(_finish(self.paths), _OUT))


def _cells(parts: DataFrame, shards: DataFrame, n_groups: int):
    """Blocks' pairs beside the table of their shard, cell by cell."""
    tables = shards.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    return parts.groupBy("shard", "grp").cogroup(tables.groupBy("shard", "grp"))


def pair_tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, a_path: str | None = None,
                b_path: str | None = None) -> PairTables:
    paths = (a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE))
    texts = bounded_batches(docs).select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    encoded = write_shared(texts.mapInArrow(_encode(paths), _T), "align-tokens")
    blocks = encoded.where("keys is not null").select("block", "keys", "counts", "n_keys")
    sent = blocks.agg(F.sum("n_keys")).first()[0]
    if not sent:
        return PairTables(paths, encoded, None, None, 0)
    n_shards = min(SHARDS, -(-sent // SHARD))
    n_groups = -(-sent // (n_shards * CELL))
    schema = "shard int, grp int, block bigint, keys binary, counts binary"
    parts = write_shared(blocks.mapInArrow(_dealt(n_shards, n_groups), schema), "align-parts")
    united = (parts.groupBy("shard", "grp").applyInArrow(_united, "shard int, grp int, keys binary")
              .transform(lambda d: _tree(d, n_groups, _united, "shard int, grp int, keys binary")))
    hashed = write_shared(united.mapInArrow(_hashed, "shard int, hash binary, pairs binary"), "align-hashes")
    vectors = _cells(parts, hashed, n_groups).applyInArrow(_vector, "shard int, grp int, vector binary")
    summed = _tree(vectors, n_groups, _summed, "shard int, grp int, vector binary")
    shards = write_shared(hashed.join(summed.drop("grp"), "shard").mapInArrow(
        _marked, "shard int, hash binary, pairs binary, vector binary, marks binary"), "align-counts")
    return PairTables(paths, encoded, parts, shards, n_groups)
