"""Language of each word, and of each text, by a linear-chain conditional
random field.

A text's words (runs of letters) are a chain; its labels are languages.  A
word speaks for a language through its character n-grams (1 to 3, its two
ends included), its affixes (up to four letters) and a lexicon of words that
belong to one language; learned transitions say how readily languages follow
each other.  Forward-backward gives each word's probability of each language,
so in text that switches between languages every word gets its own label.  A
text's language is the one with the largest mean probability over its words,
and that mean is the score.

Learning takes a bounded sample of labelled texts, whole ones, without exact
copies: ``SAMPLE_DOCS`` texts and about ``SAMPLE_CHARS`` characters per
language.  Texts have one label each, so code-switched chains are made from
them: spans of random length from texts of all languages, one after another.
``SHARDS`` tasks climb the likelihood of their chains; their weights are
averaged, and the next of ``ROUNDS`` rounds starts from the average.  The model is
a table of fixed size per language, which is all that is broadcast.

Prediction reads the text only.  It is one pass over all rows, in bounded
batches; a chain is worked on in segments of ``SEGMENT`` words at once (products
of transition matrices), so a very long text needs no longer loop, only memory
in proportion to its length.

Defined results: ``und`` with score 0 for a text that is NULL or has no letter,
and for every text if nothing was learned; equal probabilities go to the
language that comes first; repeated rows are predicted each on their own; a
row with a NULL label is not learned from; an empty table gives an empty table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import ROW, bounded_batches, drop_shared, with_row, write_shared

SAMPLE_DOCS, SAMPLE_CHARS = 2000, 1_500_000  # per language
MAX_LABELS = 512
BUCKETS = 1 << 17  # rows of the table of hashed features
SHARDS, ROUNDS, EPOCHS = 6, 2, 2
SPAN = (3, 40)  # words of a span in a made-up chain, shortest and longest
CHAIN, CHAINS = 128, 48  # words of a chain; chains of one step
RATE, DECAY = 0.3, 1e-5
LEXICON_DOCS, LEXICON_SHARE = 3, 0.8  # a lexicon word: in so many texts, so much of them in one language
SEGMENT = 32
BATCH_CHARS = 1_000_000
UNKNOWN = "und"

_GRAMS, _AFFIXES = 3, (4, 5)  # lengths with the word's end counted in


# ---- words and their features ----------------------------------------------

@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters or marks, and their lower case where that
    is one code point."""
    chars = [*map(chr, range(0x110000))]
    letter = np.array([c.isalpha() for c in chars])
    letter[:0x20000] |= np.array([unicodedata.category(c)[0] == "M" for c in chars[:0x20000]])
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero([c.isupper() or c.istitle() for c in chars]):
        if len(small := chars[i].lower()) == 1:
            lower[i] = ord(small)
    return letter, lower


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of texts: code points with the word's two ends put around,
    place in the text, number of the text."""

    def __init__(self, texts: list[str | None]):
        letter, lower = _letters()
        raw = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
        sizes = np.array([len(r) + 1 for r in raw], np.int64)
        points = np.zeros(int(sizes.sum()), np.uint32)
        base = np.cumsum(sizes) - sizes
        for r, b in zip(raw, base):
            points[b:b + len(r)] = r
        inside = np.concatenate([[False], letter[points]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]  # the 0 behind each text ends its last word
        self.doc = np.searchsorted(base, start, "right") - 1
        self.start, self.end = start - base[self.doc], end - base[self.doc]
        self.n_docs = len(texts)
        self._frame(lower[points], start, end)

    def __len__(self) -> int:
        return len(self.doc)

    def _frame(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        n = end - start
        self.width = n + 2
        self.at = np.cumsum(self.width) - self.width
        self.points = np.empty(int(self.width.sum()), np.uint64)
        self.points[self.at], self.points[self.at + n + 1] = 1, 2
        to = np.arange(int(n.sum())) + np.repeat(self.at + 1 - (np.cumsum(n) - n), n)
        self.points[to] = points[np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)]

    def take(self, which: np.ndarray) -> Words:
        """These words, in this order."""
        out = object.__new__(Words)
        out.doc, out.start, out.end, out.n_docs = self.doc[which], self.start[which], self.end[which], self.n_docs
        out.width = self.width[which]
        out.at = np.cumsum(out.width) - out.width
        out.points = self.points[np.arange(int(out.width.sum())) + np.repeat(self.at[which] - out.at, out.width)]
        return out

    def hashes(self) -> np.ndarray:
        """One number per word."""
        place = np.arange(len(self.points)) - np.repeat(self.at, self.width)
        return np.add.reduceat(_mix(_mix(self.points, 11) + place.astype(np.uint64), 7), self.at) if len(self) \
            else np.zeros(0, np.uint64)

    def grams(self) -> np.ndarray:
        """Feature rows ``[length - 1, place]`` of the n-grams that begin at
        each place; ``BUCKETS`` (an empty row) where the word is over."""
        total = len(self.points)
        out = np.full((_GRAMS, total), BUCKETS, np.int64)
        left = np.repeat(self.at + self.width, self.width) - np.arange(total)
        key = np.zeros(total, np.uint64)
        for k in range(_GRAMS):
            key[:total - k] = key[:total - k] * np.uint64(0x100000001B3) + self.points[k:]
            whole = left > k
            out[k, whole] = (_mix(key[whole], k + 1) >> np.uint64(40)).astype(np.int64) % BUCKETS
        return out

    def affixes(self) -> np.ndarray:
        """Feature rows ``[kind, word]`` of the long prefixes and suffixes."""
        out = np.full((2 * len(_AFFIXES), len(self)), BUCKETS, np.int64)
        for i, n in enumerate(_AFFIXES):
            fit = np.flatnonzero(self.width >= n)
            for j, first in enumerate((self.at[fit], self.at[fit] + self.width[fit] - n)):
                key = np.zeros(len(fit), np.uint64)
                for k in range(n):
                    key = key * np.uint64(0x100000001B3) + self.points[first + k]
                out[2 * i + j, fit] = (_mix(key, 20 + 2 * i + j) >> np.uint64(40)).astype(np.int64) % BUCKETS
        return out


# ---- the model -----------------------------------------------------------

@dataclass
class Model:
    """``weights``: a row per hashed feature, an empty row, a row per language of
    a lexicon word, a row for words in no lexicon; a column per language.
    ``moves``: weight of the step from one language to the next."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: np.ndarray  # sorted hashes of words
    lexicon_label: np.ndarray

    @classmethod
    def blank(cls, labels: list[str], lexicon: dict[int, int]) -> Model:
        words = np.array(sorted(lexicon), np.uint64)
        n = len(labels)
        return cls(labels, np.zeros((BUCKETS + n + 2, n), np.float32), np.zeros((n, n)), words,
                   np.array([lexicon[int(w)] for w in words], np.int64))

    def lexicon_rows(self, hashes: np.ndarray) -> np.ndarray:
        none = BUCKETS + 1 + len(self.labels)
        if not len(self.lexicon):
            return np.full(len(hashes), none)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, BUCKETS + 1 + self.lexicon_label[at], none)

    def features(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Feature rows per place and per word."""
        return words.grams(), np.vstack([words.affixes(), self.lexicon_rows(words.hashes())])

    def emissions(self, words: Words, features: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        if not len(words):
            return np.zeros((0, len(self.labels)), np.float32)
        places, own = features
        sums = self.weights[places[0]]
        for row in places[1:]:
            sums += self.weights[row]
        out = np.add.reduceat(sums, words.at, axis=0)
        for row in own:
            out += self.weights[row]
        return out


# ---- forward and backward ----------------------------------------------------

def forward_backward(emission: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For chains one after another: what comes into each word from before
    (``before``, sums to 1) and what it and all after it say (``after``, up to a
    factor).  ``(before @ exp(moves)) * after`` is the word's distribution, up
    to a factor.  The step into a chain's first word comes from all labels
    alike."""
    n_labels = len(moves)
    step = np.exp(moves - moves.max())
    say = np.exp((emission - emission.max(axis=1, keepdims=True)).astype(np.float64))
    segments = -(-lengths // SEGMENT)
    chain = np.repeat(np.arange(len(lengths)), segments)
    first = np.cumsum(segments) - segments  # first segment of each chain
    number = np.arange(len(chain)) - first[chain]
    start = (np.cumsum(lengths) - lengths)[chain] + number * SEGMENT
    size = np.minimum(SEGMENT, lengths[chain] - number * SEGMENT)
    at = start[:, None] + np.minimum(np.arange(SEGMENT), size[:, None] - 1)  # a pad repeats the last word
    real = np.arange(SEGMENT) < size[:, None]
    # one matrix per segment
    through = np.broadcast_to(np.eye(n_labels), (len(chain), n_labels, n_labels)).copy()
    for k in range(SEGMENT):
        some = real[:, k]
        if not some.any():
            break
        through[some] = (through[some] @ step) * say[at[some, k]][:, None, :]
    through /= np.maximum(through.max(axis=(1, 2), keepdims=True), 1e-300)
    # what enters and leaves each segment, chain by chain
    enter = np.full((len(chain), n_labels), 1.0 / n_labels)
    leave = np.ones((len(chain), n_labels))
    longest = int(segments.max(initial=0))
    for k in range(longest - 1):
        here = (first + k)[segments > k + 1]
        out = np.einsum("si,sij->sj", enter[here], through[here])
        enter[here + 1] = out / out.sum(axis=1, keepdims=True)
    for k in range(longest - 1, 0, -1):
        here = (first + k)[segments > k]
        out = np.einsum("sij,sj->si", through[here], leave[here])
        leave[here - 1] = out / out.sum(axis=1, keepdims=True)
    # inside the segments
    before, after = np.empty_like(say), np.empty_like(say)
    now = enter
    for k in range(SEGMENT):
        some = real[:, k]
        if not some.any():
            break
        before[at[some, k]] = now[some]
        out = (now[some] @ step) * say[at[some, k]]
        now[some] = out / out.sum(axis=1, keepdims=True)
    now = leave
    for k in range(SEGMENT - 1, -1, -1):
        some = real[:, k]
        if some.any():
            out = say[at[some, k]] * now[some]
            after[at[some, k]] = out
            out = out @ step.T
            now[some] = out / out.sum(axis=1, keepdims=True)
    return before, after


def posteriors(before: np.ndarray, after: np.ndarray, moves: np.ndarray) -> np.ndarray:
    p = (before @ np.exp(moves - moves.max())) * after
    return p / p.sum(axis=1, keepdims=True)


# ---- learning --------------------------------------------------------------

def made_up_chains(words: Words, rng: np.random.Generator) -> np.ndarray:
    """Numbers of the words in spans of random length, the spans of all texts
    shuffled, so that a chain switches language as it goes."""
    order = np.arange(len(words))
    ends, at = [], 0
    lengths = rng.integers(SPAN[0], SPAN[1] + 1, len(words) // SPAN[0] + 1)
    text_end = np.flatnonzero(np.append(words.doc[1:] != words.doc[:-1], True)) + 1
    cuts = np.union1d(np.cumsum(lengths)[np.cumsum(lengths) < len(words)], text_end)
    spans = np.split(order, cuts[:-1])
    for i in rng.permutation(len(spans)):
        ends.append(spans[i])
        at += len(spans[i])
    return np.concatenate(ends) if ends else order


def climb(model: Model, words: Words, label: np.ndarray, seed: int) -> None:
    """``EPOCHS`` passes of adaptive gradient steps over made-up chains."""
    rng = np.random.default_rng(seed)
    n_labels = len(model.labels)
    square_w, square_m = np.full_like(model.weights, 1e-2), np.full_like(model.moves, 1e-2)
    for _ in range(EPOCHS):
        order = made_up_chains(words, rng)
        for at in range(0, len(order), CHAIN * CHAINS):
            which = order[at:at + CHAIN * CHAINS]
            part, truth = words.take(which), label[which]
            features = model.features(part)
            lengths = np.full(-(-len(which) // CHAIN), CHAIN)
            lengths[-1] = len(which) - CHAIN * (len(lengths) - 1)
            before, after = forward_backward(model.emissions(part, features), lengths, model.moves)
            error = -posteriors(before, after, model.moves)
            error[np.arange(len(which)), truth] += 1
            # steps: seen less expected
            step = np.exp(model.moves - model.moves.max())
            mass = ((before @ step) * after).sum(axis=1, keepdims=True)
            inner = np.ones(len(which), bool)
            inner[np.cumsum(lengths) - lengths] = False
            expected = step * ((before / mass)[inner].T @ after[inner])
            seen = np.zeros_like(expected)
            np.add.at(seen, (truth[:-1][inner[1:]], truth[1:][inner[1:]]), 1)
            gradient_m = seen - expected
            gradient = np.zeros(model.weights.shape, np.float64)
            rows = np.concatenate([features[0].ravel(), features[1].ravel()])
            for k in range(n_labels):
                spread = np.repeat(error[:, k], part.width)
                value = np.concatenate([np.tile(spread, _GRAMS), np.tile(error[:, k], len(features[1]))])
                gradient[:, k] = np.bincount(rows, value, minlength=len(gradient))
            gradient[BUCKETS] = 0
            for value, square, g in ((model.weights, square_w, gradient), (model.moves, square_m, gradient_m)):
                g = g / CHAINS - DECAY * value
                square += g * g
                value += RATE * g / np.sqrt(square)


def _train(model: Model, round_: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        rows = sorted(zip(table["key"].to_pylist(), table["label"].to_pylist(), table["text"].to_pylist()))
        own = Model(model.labels, model.weights.copy(), model.moves.copy(), model.lexicon, model.lexicon_label)
        words = Words([r[2] for r in rows])
        label = np.array([r[1] for r in rows], np.int64)[words.doc]
        if len(words):
            climb(own, words, label, 1000 * round_ + shard)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(words)], pa.int64()),
                         "weights": pa.array([own.weights.tobytes()], pa.binary()),
                         "moves": pa.array([own.moves.tobytes()], pa.binary())})
    return run


def _sample(docs: DataFrame, text: Column, label: Column, learn: Column) -> tuple[list[str], DataFrame]:
    """The languages, and the sample: ``key, label, text``.  Each language's
    share of the rows is known from a count, so a hash of the text picks about
    twice the sample in one pass; exact copies go, and the first ones by hash
    stay."""
    rows = docs.where(learn & label.isNotNull() & text.isNotNull()).select(
        label.cast("string").alias("lang"), text.alias("text"), F.xxhash64(text).alias("key"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_LABELS + 1).collect()}
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} languages")
    labels = sorted(counts)
    if not labels:
        return labels, docs.sparkSession.createDataFrame([], "key bigint, label int, text string")
    number = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i)]), F.col("lang"))
    share = F.element_at(F.create_map(*[F.lit(x) for name in labels
                                        for x in (name, min(1.0, 2 * SAMPLE_DOCS / counts[name]))]), F.col("lang"))
    picked = (rows.where(F.pmod(F.col("key"), F.lit(1 << 30)) < share * (1 << 30))
              .groupBy("lang", "key").agg(F.first("text").alias("text")))
    order = Window.partitionBy("lang").orderBy("key")
    size = F.sum(F.length("text").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    kept = (picked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_DOCS)
            .withColumn("chars", F.coalesce(size, F.lit(0))).where(F.col("chars") < SAMPLE_CHARS))
    return labels, kept.select("key", number.cast("int").alias("label"), "text")


def _word_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct words."""
    for b in batches:
        words = Words(b.column(1).to_pylist())
        label = np.array(b.column(0).to_pylist(), np.int64)
        pairs = np.unique(np.stack([words.doc.astype(np.uint64), words.hashes()], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].view(np.int64)),
                                          pa.array(label[pairs[:, 0].astype(np.int64)].astype(np.int32))],
                                         ["word", "label"])


def fit(docs: DataFrame, text_col: str, label: Column, learn: Column) -> Model:
    """The model learned from the rows where ``learn`` holds and the label is
    known."""
    labels, sample = _sample(bounded_batches(docs), F.col(text_col).cast("string"), label, learn)
    if not labels:
        return Model.blank([], {})
    sample = write_shared(sample, "language-sample")
    words = sample.select("label", "text").mapInArrow(_word_documents, "word bigint, label int")
    per = words.groupBy("word", "label").agg(F.count(F.lit(1)).alias("n"))
    own = (per.groupBy("word").agg(F.sum("n").alias("docs"), F.max(F.struct("n", F.col("label"))).alias("top"))
           .where((F.col("docs") >= LEXICON_DOCS) & (F.col("top.n") >= LEXICON_SHARE * F.col("docs"))))
    # at most as many words as the sample holds
    lexicon = {r["word"] & 0xFFFFFFFFFFFFFFFF: r["label"] for r in own.select("word", "top.label").collect()}
    model = Model.blank(labels, lexicon)
    shards = sample.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(SHARDS)).cast("int"))
    schema = "shard int, n bigint, weights binary, moves binary"
    for round_ in range(ROUNDS):
        # SHARDS tables of the model's size
        rows = sorted(shards.groupBy("shard").applyInArrow(_train(model, round_), schema).collect())
        total = max(1, sum(r["n"] for r in rows))
        weights, moves = np.zeros(model.weights.shape), np.zeros(model.moves.shape)
        for r in rows:
            weights += r["n"] / total * np.frombuffer(r["weights"], np.float32).reshape(weights.shape)
            moves += r["n"] / total * np.frombuffer(r["moves"], np.float64).reshape(moves.shape)
        model.weights, model.moves = weights.astype(np.float32), moves
    drop_shared(sample)
    return model


# ---- prediction --------------------------------------------------------------

_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                      T.StructField("lang", T.StringType()), T.StructField("probability", T.DoubleType())])
_FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN))])


def label_texts(model: Model, texts: list[str | None]) -> pa.StructArray:
    """Language, score, number of words and spans of words of one language
    (places in code points; mean probability) of each text."""
    words = Words(texts)
    n = len(texts)
    lengths = np.bincount(words.doc, minlength=n)
    pred, score = np.full(n, -1), np.zeros(n)
    span_at = np.zeros(n + 1, np.int64)
    start = end = lang = sure = np.zeros(0, np.int64)
    if len(words) and model.labels:
        chains = np.flatnonzero(lengths)
        before, after = forward_backward(model.emissions(words, model.features(words)), lengths[chains], model.moves)
        p = posteriors(before, after, model.moves)
        mean = np.add.reduceat(p, (np.cumsum(lengths) - lengths)[chains], axis=0) / lengths[chains][:, None]
        pred[chains], score[chains] = mean.argmax(axis=1), np.minimum(mean.max(axis=1), 1.0)
        best = p.argmax(axis=1)
        new = np.append(True, (best[1:] != best[:-1]) | (words.doc[1:] != words.doc[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(best)) - 1
        start, end, lang = words.start[first], words.end[last], best[first]
        sure = np.add.reduceat(p[np.arange(len(best)), best], first) / (last - first + 1)
        span_at[1:] = np.cumsum(np.bincount(words.doc[first], minlength=n))
    names = np.array([*model.labels, UNKNOWN], object)
    spans = pa.StructArray.from_arrays(
        [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(names[lang.astype(np.int64)], pa.string()),
         pa.array(sure, pa.float64())], _SPAN.names)
    return pa.StructArray.from_arrays(
        [pa.array(names[pred], pa.string()), pa.array(score), pa.array(lengths.astype(np.int64)),
         pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans)], _FOUND.names)


def predict(docs: DataFrame, model: Model, text_col: str = "text", *, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``_row`` (its columns, or those in ``keep``) and
    the struct ``language``: ``lang_pred, score, n_words, spans``.  One pass,
    no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = bounded_batches(docs).select(with_row(docs, keep), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([carried.schema[ROW], T.StructField("language", _FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, start, held = b.column(1).to_pylist(), 0, 0
            for i, text in enumerate(texts):
                held += len(text or "")
                if held >= BATCH_CHARS or i == len(texts) - 1:
                    found = label_texts(shared.value, texts[start:i + 1])
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start, i + 1 - start), found], schema.names)
                    start, held = i + 1, 0
    return carried.mapInArrow(run, schema)
