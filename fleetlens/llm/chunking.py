"""Passages repeated across documents, by content-defined chunking.

A gear hash rolls over the bytes of each whole text, runs of white space
taken as one space: every byte shifts the hash by one bit and adds a random
number of its own, so the hash depends on the last 32 bytes alone.  A chunk
ends before a word where the hash there is below a threshold, once it has
``MIN_WORDS`` words; what is inserted earlier moves the chunks but does not
change where they end, and neither do other line breaks.

Chunks are compared by 128-bit digests.  Two neighbouring chunks that an
earlier document (smaller id) holds in a row are linked, a chunk of ``MIN_RUN``
words that an earlier one holds stands by itself.  Linked chunks form a passage,
whatever other documents hold some of its chunks, too; passages of ``MIN_RUN``
words or more are reported.  A passage's ``first_doc_id`` is the document that is
the first holder of the most words of it (equal: the smaller one).

With one cut in four words and five words at least, two texts that share 51
words have a run of ten words or more in common with probability 0.993, and 60
words with 0.999 (simulated).

Defined results: NULL and empty texts have no chunks; rows without an id take
no part; rows with one id count as one document, which never repeats itself:
rows equal in id and text are reported once, different texts of one id each on
their own (``text_hash``); repeats within one document are not reported; extra
columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded_batches, free_name, write_shared
from fleetlens.llm.tokens import text_chunks

WINDOW = 32  # bytes that a 32-bit gear hash depends on
CUT_ONE_IN = 4
MIN_WORDS = 5
MAX_WORDS = 64
MIN_RUN = 12

# One random number per byte, and 0 for the padding between texts.
GEAR = np.array([*(xxhash.xxh32_intdigest(bytes([b]), seed=WINDOW) for b in range(256)), 0], np.uint32)

CHUNKS = ("doc bigint, text_hash bigint, no int, start int, chars int, words int, h1 bigint, h2 bigint, "
          "before_start int, before_words int, g1 bigint, g2 bigint")


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash behind every byte: doubling the window five times."""
    h, width = GEAR[data], 1
    while width < WINDOW:
        older = np.zeros_like(h)
        older[width:] = h[:-width]
        h = h + (older << np.uint32(width))
        width *= 2
    return h


def cut_words(text_words: list[int], may_cut: list[bool], min_words: int, max_words: int) -> list[int]:
    """Numbers of the words that chunks begin with (the first one's is 0)."""
    cuts, last = [], 0
    for i in text_words:
        if i - last >= min_words:
            while i - last > max_words:
                last += max_words
                cuts.append(last)
            if may_cut[i] or i - last == max_words:
                cuts.append(i)
                last = i
    return cuts


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _word_starts(space: np.ndarray) -> np.ndarray:
    return np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))


def _kept(space: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The bytes of the words and one before each word but the first."""
    kept = ~space
    kept[starts[1:] - 1] = True
    return kept


def normal_bytes(data: np.ndarray) -> np.ndarray:
    """The words with one space between them."""
    space = _is_space(data)
    kept = _kept(space, _word_starts(space))
    return np.where(space, np.uint8(32), data)[kept]


def _chunk_text(data: np.ndarray, hashes: np.ndarray, raw: bytes, cut_below: int, min_words: int, max_words: int):
    """``(no, start, chars, words, h1, h2)`` of the chunks of one text;
    ``hashes`` are those of its :func:`normal_bytes`."""
    space = _is_space(data)
    starts = _word_starts(space)
    if not len(starts):
        return
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    may = np.zeros(len(starts), bool)
    place = np.cumsum(_kept(space, starts)) - 1
    may[1:] = hashes[place[starts[1:]] - 1] < cut_below
    n = len(starts)
    candidates = np.flatnonzero(may).tolist()
    cuts = [0, *cut_words(candidates, may, min_words, max_words)]
    while n - cuts[-1] > max_words:
        cuts.append(cuts[-1] + max_words)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], n])):
        x, y = int(starts[a]), int(ends[b - 1])
        digest = xxhash.xxh3_128_intdigest(b" ".join(raw[x:y].split()))
        yield (k, int(chars[x]), int(chars[y] - chars[x]), b - a, *_halves(digest))


def _halves(digest: int) -> tuple[int, int]:
    return (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair_columns(no: np.ndarray, start: np.ndarray, words: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> list[pa.Array]:
    """Of each chunk the start and words of the one before it and the digest
    of the two (NULL for a text's first chunk)."""
    first = no == 0

    def before(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x[:1], x[:-1]])
    pairs = [_mixed(_mixed(before(h).view(np.uint64) + np.uint64(seed)) + h.view(np.uint64))
             for h, seed in ((h1, 1), (h2, 2))]
    return [pa.array(x, mask=first) for x in (before(start), before(words), *(p.view(np.int64) for p in pairs))]


def chunks(docs: DataFrame, doc: Column, text: Column, *, cut_one_in: int = CUT_ONE_IN, min_words: int = MIN_WORDS,
           max_words: int = MAX_WORDS) -> DataFrame:
    """One row per chunk (:data:`CHUNKS`); ``start`` and ``chars`` count code
    points, ``g1, g2`` is the digest of the chunk and the one before."""
    cut_below = (1 << 32) // cut_one_in
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in CHUNKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.full(WINDOW, 256, np.uint16)
        for batch in batches:
            for at, part in text_chunks(pc.fill_null(batch.column(1), "")):
                raws = [t.as_py() for t in part.cast(pa.binary())]
                datas = [np.frombuffer(r, np.uint8) for r in raws]
                normal = [normal_bytes(d) for d in datas]
                hashes = gear_hashes(np.concatenate([x for d in normal for x in (d, pad)]))
                columns: list[list] = [[] for _ in range(8)]
                begin = 0
                keys = (batch.column(c).slice(at, len(part)).to_pylist() for c in (0, 2))
                for doc_id, text_hash, raw, data, own in zip(*keys, raws, datas, normal):
                    found = _chunk_text(data, hashes[begin:begin + len(own)], raw, cut_below, min_words, max_words)
                    rows = [*found]
                    columns[0] += [doc_id] * len(rows)
                    columns[1] += [text_hash] * len(rows)
                    for c, values in zip(columns[2:], zip(*rows)):
                        c += values
                    begin += len(own) + WINDOW
                arrays = [np.array(c, f.type.to_pandas_dtype()) for c, f in zip(columns, schema)]
                no, start, _, words, h1, h2 = arrays[2:]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, arrays), *_pair_columns(no, start, words, h1, h2)], schema=schema)

    text = text.cast("string")
    return (bounded_batches(docs).select(doc.cast("bigint").alias("doc"), text.alias("text"),
                                         F.xxhash64(text).alias("text_hash"))
            .where("doc is not null and text is not null").mapInArrow(run, CHUNKS))


def repeated_passages(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", *, min_run: int = MIN_RUN,
                      **options) -> DataFrame:
    """``doc_id, start, chars, words, first_doc_id, text_hash``: passages that
    earlier documents hold, too.

    Only digests move, texts never.  A passage that a third of all documents
    share is one partial row per task in the aggregate; the digests found in
    two documents are written, so the join with them has a hot one split (or
    them broadcast) by the adaptive plan.  Passages are found per document.
    """
    rows = chunks(docs, F.col(doc_col), F.col(text_col), **options)
    pair = F.struct(F.lit(True).alias("pair"), F.col("g1").alias("d1"), F.col("g2").alias("d2"))
    alone = F.struct(F.lit(False).alias("pair"), F.col("h1").alias("d1"), F.col("h2").alias("d2"))
    keys = (rows.withColumn("key", F.explode(F.filter(
        F.array(F.when(F.col("g1").isNotNull(), pair), F.when(F.col("words") >= min_run, alone)),
        lambda x: x.isNotNull()))).select("doc", "text_hash", "no", "start", "chars", "words", "before_start",
                                          "before_words", "key.*"))
    shared = (keys.groupBy("pair", "d1", "d2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
              .where("first < last").select("pair", "d1", "d2", "first"))
    shared = write_shared(shared, "chunk-digests")
    # copies of a row have equal chunks
    held = keys.join(shared, ["pair", "d1", "d2"]).where("doc <> first").drop("d1", "d2").distinct()
    text = ["doc", "text_hash"]
    order = Window.partitionBy(*text).orderBy("no", F.col("pair").desc())  # a pair reaches further back
    begins = F.when(F.col("pair"), F.col("no") - 1).otherwise(F.col("no"))
    apart = begins > F.max("no").over(order.rowsBetween(Window.unboundedPreceding, -1))
    held = held.withColumn("new", F.when(apart, 1).otherwise(0)).withColumn("run", F.sum("new").over(order))
    # a run is one chunk alone, or pairs that hold all of its chunks
    pair_words = F.sum(F.when(F.col("pair"), F.col("words")))
    by_source = held.groupBy(*text, "run", "first").agg(
        F.sum("words").alias("covers"), pair_words.alias("pair_words"),
        F.min(F.when(F.col("pair"), F.struct("no", "before_words"))).alias("front"),
        F.min(F.when(F.col("pair"), F.col("before_start")).otherwise(F.col("start"))).alias("start"),
        F.max(F.col("start") + F.col("chars")).alias("end"), F.max("words").alias("lone"))
    runs = by_source.groupBy(*text, "run").agg(
        F.max(F.struct(F.col("covers"), (-F.col("first")).alias("minus"))).alias("source"),
        F.sum("pair_words").alias("pair_words"), F.min("front").alias("front"), F.min("start").alias("start"),
        F.max("end").alias("end"), F.max("lone").alias("lone"))
    words = F.when(F.col("front").isNull(), F.col("lone")).otherwise(F.col("pair_words") + F.col("front.before_words"))
    return (runs.withColumn("words", words.cast("bigint")).where(F.col("words") >= min_run)
            .select(F.col("doc").alias("doc_id"), "start", (F.col("end") - F.col("start")).alias("chars"), "words",
                    (-F.col("source.minus")).alias("first_doc_id"), "text_hash"))


def remove_passages(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without the passages that an earlier document holds; all
    other columns are unchanged."""
    doc, found, own = free_name(docs, "_doc"), free_name(docs, "_spans"), free_name(docs, "_text_hash")
    spans = (repeated_passages(docs, doc_col, text_col, **options)
             .groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(own))
             .agg(F.array_sort(F.collect_list(F.struct("start", "chars"))).alias(found)))
    text = F.col(text_col)
    kept = F.aggregate(
        F.col(found), F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc.text, text.substr(acc["at"] + 1, F.greatest(s.start - acc["at"], F.lit(0)))).alias("text"),
            F.greatest(acc["at"], s.start + s.chars).alias("at")),
        lambda acc: F.concat(acc.text, text.substr(acc["at"] + 1, F.length(text))))
    same = (F.col(doc_col) == F.col(doc)) & (F.xxhash64(text.cast("string")) == F.col(own))
    joined = docs.join(spans, same, "left")
    return joined.select(*[F.when(F.col(found).isNull(), text).otherwise(kept).alias(c) if c == text_col
                           else F.col(f"`{c}`") for c in docs.columns])
