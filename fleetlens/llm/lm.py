"""Language-model scores from a weighted backoff automaton.

The model is an n-gram model over words and one end per text.  Unigrams are
smoothed by one count, ``(c + 1) / (N + V + 1)``; a longer n-gram ``hw`` by
``MASS`` counts spread as the shorter one says: ``(c(hw) + MASS p(w|h')) /
(c(h) + MASS)``.  As an automaton, every context ``h`` seen in training is a
state, every n-gram seen is an arc with its log-probability, and a state's
failure arc leads to the shorter context ``h'`` with weight ``MASS / (c(h) +
MASS)``.  A text is scored in one pass from left to right that carries the
state.

No task and no driver holds the model.  Texts are dealt into blocks; a block
sends the hashes of its distinct n-grams, with its training counts, to the
buckets of their hash range; a bucket adds the counts of all blocks up and
answers each block in the order it asked; a block builds the part of the
automaton that its texts can reach and runs it.  An n-gram moves once per
block that holds it, so a frequent one is no hot key.

Defined results: a NULL or empty text is its end alone; a document without an
id is trained on; rows are scored each on their own, whatever their ids; extra
columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import blocks_for
from fleetlens.llm.tokens import numbers, split_words

ORDER = 2
MASS = 500.0
BLOCK_MB = 8
FOLDS, HELD_OUT = 7, 2

END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds white space
BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b" "))

_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double")


def extend(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of an n-gram from its context's key and its last word's."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokens:
    """Token keys of a block's texts, one after another, and the keys of the
    n-grams that end at each token (``present`` where the text is long
    enough for one)."""

    def __init__(self, texts: pa.Array, order: int):
        words, counts = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
        keys = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.cast(pa.large_binary()).to_pylist()],
                        np.uint64)
        self.lengths = counts + 1
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        total = int(self.lengths.sum())
        self.word = np.full(total, END)
        inside = np.ones(total, bool)
        inside[self.starts + counts] = False
        self.word[inside] = keys[numbers(words)] if len(keys) else 0
        self.place = np.arange(total) - np.repeat(self.starts, self.lengths)
        self.grams = [self.word]
        for _ in range(order - 1):
            before = np.empty_like(self.word)
            before[1:] = self.grams[-1][:-1]
            if len(self.grams) == 1:
                before[self.starts] = BEGIN
            self.grams.append(extend(before, self.word))
        # an n-gram may begin with the text's beginning, not before it
        self.present = [self.place >= max(0, k - 1) for k in range(order)]
        self.found: dict[int, tuple] = {}

    def distinct(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of the n-grams of length ``k + 1`` in order, a place
        where each ends, and for each place its key's number (-1: none)."""
        if k not in self.found:
            at = np.flatnonzero(self.present[k])
            keys, first, inverse = np.unique(self.grams[k][at], return_index=True, return_inverse=True)
            number = np.full(len(self.word), -1)
            number[at] = inverse
            self.found[k] = keys, at[first], number
        return self.found[k]


def pack(values: np.ndarray) -> bytes:
    """Numbers byte by byte: all first bytes, all second bytes and so on, so
    that the equal high bytes of sorted or small numbers lie together and the
    shuffle's compression takes them away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def unpack(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


class BackoffAutomaton:
    """The part of the model's automaton that a block's texts can reach."""

    def __init__(self, tokens: Tokens, counts: list[np.ndarray], n_train: int, n_types: int, n_texts: int,
                 mass: float):
        order = len(tokens.grams)
        found = [tokens.distinct(k) for k in range(order)]
        self.unknown = -np.log10(n_train + n_types + 1)
        # states: 0 is the root, 1 the beginning, then the contexts by length
        key, fail, seen = [np.zeros(1, np.uint64), np.array([BEGIN])], [np.zeros(2, np.int64)], [np.array([0, n_texts])]
        state = []  # per length, the state of each distinct n-gram (0: none)
        n_states = 2
        for k in range(order - 1):
            keys, at, _ = found[k]
            is_state = (counts[k] > 0) & (tokens.word[at] != END)
            own = np.zeros(len(keys), np.int64)
            own[is_state] = n_states + np.arange(is_state.sum())
            n_states += int(is_state.sum())
            state.append(own)
            key.append(keys[is_state])
            seen.append(counts[k][is_state])
            shorter = at[is_state]
            fail.append(state[k - 1][found[k - 1][2][shorter]] if k else np.zeros(len(shorter), np.int64))
        self.key, self.fail = np.concatenate(key), np.concatenate(fail)
        self.backoff = np.log10(mass / (np.concatenate(seen) + mass))
        # arcs, by the key of the n-gram they read
        arc_key, arc_weight, arc_to, chance = [], [], [], []
        for k in range(order):
            keys, at, _ = found[k]
            if k == 0:
                p = (counts[0] + 1) / (n_train + n_types + 1)
            else:
                context = np.where(tokens.place[at] == k - 1, n_texts if k == 1 else 0, 0).astype(np.float64)
                inner = np.flatnonzero(tokens.place[at] >= k)
                context[inner] = counts[k - 1][found[k - 1][2][at[inner] - 1]]
                if k > 1:  # the context begins with the text's beginning
                    edge = np.flatnonzero(tokens.place[at] == k - 1)
                    context[edge] = counts[k - 1][found[k - 1][2][at[edge] - 1]]
                shorter = chance[k - 1][found[k - 1][2][at]]
                p = (counts[k] + mass * shorter) / (context + mass)
            chance.append(p)
            real = counts[k] > 0
            arc_key.append(keys[real])
            arc_weight.append(np.log10(p[real]))
            longest = min(k, order - 2)
            arc_to.append(state[longest][found[longest][2][at[real]]] if order > 1 else np.zeros(real.sum(), np.int64))
        # the root's arcs, and all others in the order of their keys
        self.arcs = [(arc_key[0], arc_weight[0], arc_to[0])]
        longer = [np.concatenate(c[1:]) if order > 1 else c[0][:0] for c in (arc_key, arc_weight, arc_to)]
        by = np.argsort(longer[0], kind="stable") if order > 2 else slice(None)
        self.arcs.append(tuple(c[by] for c in longer))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word from each state: log-probabilities and next states."""
        score, state = np.zeros(len(state)), state.copy()
        open_ = np.flatnonzero(state)
        while len(open_):  # fail from context to shorter context until there is an arc
            s = state[open_]
            hit, at = self._find(1, extend(self.key[s], word[open_]))
            done, missed = open_[hit], open_[~hit]
            score[done] += self.arcs[1][1][at[hit]]
            state[done] = -1 - self.arcs[1][2][at[hit]]
            score[missed] += self.backoff[state[missed]]
            state[missed] = self.fail[state[missed]]
            open_ = missed[state[missed] != 0]
        root = np.flatnonzero(state == 0)
        hit, at = self._find(0, word[root])
        score[root] += np.where(hit, self.arcs[0][1][at], self.unknown) if len(self.arcs[0][0]) else self.unknown
        state[root[hit]] = self.arcs[0][2][at[hit]]
        arrived = state < 0
        state[arrived] = -1 - state[arrived]
        return score, state

    def _find(self, kind: int, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these arcs there are, and their numbers."""
        keys = self.arcs[kind][0]
        if not len(keys):
            return np.zeros(len(want), bool), np.zeros(len(want), np.int64)
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return keys[at] == want, at

    def traverse(self, tokens: Tokens) -> np.ndarray:
        """Score of each text: all texts advance by one word at a time, the
        long ones longest, each with its own state."""
        by = np.argsort(-tokens.lengths, kind="stable")
        starts, lengths = tokens.starts[by], tokens.lengths[by]
        score, state = np.zeros(len(by)), np.ones(len(by), np.int64)
        if len(self.key) == 2 and len(tokens.grams) == 1:
            state[:] = 0
        active = len(by)
        for t in range(int(lengths[0]) if len(by) else 0):
            while lengths[active - 1] <= t:
                active -= 1
            gained, state[:active] = self.step(state[:active], tokens.word[starts[:active] + t])
            score[:active] += gained
        out = np.empty(len(by))
        out[by] = score
        return out


def _requests(order: int, buckets: int):
    edges = (np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets))

    def run(table: pa.Table) -> pa.Table:
        tokens = Tokens(table["text"].combine_chunks(), order)
        train = np.repeat(~table["held_out"].to_numpy(zero_copy_only=False), tokens.lengths)
        rows: dict[str, list] = {c: [] for c in ("n", "bucket", "keys", "counts")}
        for k in range(order):
            keys, _, number = tokens.distinct(k)
            real = (number >= 0) & train
            counts = np.bincount(number[real], minlength=len(keys)).astype("<u4")
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
                for c, v in zip(rows, (k, b, pack(keys[x:y]), pack(counts[x:y]))):
                    rows[c].append(v)
        block = pa.array([table["block"][0].as_py()] * len(rows["n"]), pa.int32())
        return pa.table({"block": block, "n": pa.array(rows["n"], pa.int32()),
                         "bucket": pa.array(rows["bucket"], pa.int32()), "keys": pa.array(rows["keys"], pa.binary()),
                         "counts": pa.array(rows["counts"], pa.binary())})
    return run


def _answers(table: pa.Table) -> pa.Table:
    """Counts over all blocks, for each block in the order of its keys; with
    them the bucket's numbers of tokens and types."""
    asked = [unpack(k, "<u8") for k in table["keys"].to_pylist()]
    counts = np.concatenate([unpack(c, "<u4") for c in table["counts"].to_pylist()]).astype(np.int64)
    keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(inverse, weights=counts, minlength=len(keys)).astype("<u8")
    ends = np.cumsum([len(a) for a in asked])
    parts = [pack(totals[x]) for x in np.split(inverse, ends[:-1])]
    n = len(asked)
    return pa.table({"block": table["block"], "n": table["n"], "bucket": table["bucket"],
                     "totals": pa.array(parts, pa.binary()),
                     "n_tokens": pa.array([int(totals.sum())] * n, pa.int64()),
                     "n_types": pa.array([int((totals > 0).sum())] * n, pa.int64())})


def _scores(order: int, mass: float):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(docs["text"].combine_chunks(), order)
        by_bucket = answers.sort_by([("n", "ascending"), ("bucket", "ascending")])
        which, totals = by_bucket["n"].to_numpy(), by_bucket["totals"].to_pylist()
        counts = [np.concatenate([unpack(t, "<u8") for n, t in zip(which, totals) if n == k]).astype(np.int64)
                  for k in range(order)]
        unigrams = which == 0
        n_train = int(by_bucket["n_tokens"].to_numpy()[unigrams].sum())
        n_types = int(by_bucket["n_types"].to_numpy()[unigrams].sum())
        keys, _, number = tokens.distinct(0)
        known = counts[0][number]
        n_texts = int(counts[0][np.searchsorted(keys, END)])
        base = np.log10(known + 1.0) - np.log10(float(n_train + n_types + 1))
        automaton = BackoffAutomaton(tokens, counts, n_train, n_types, n_texts, mass)
        return pa.table({
            "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(tokens.lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat((known > 0).astype(np.int64), tokens.starts), pa.int64()),
            "train_tokens": pa.array(np.full(len(docs), n_train), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, tokens.starts)),
            "score": pa.array(automaton.traverse(tokens))})
    return run


def held_out_fold(doc: Column) -> Column:
    """True for the documents that nothing is learnt from."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def score_texts(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", *, held_out: Column | None = None,
                order: int = ORDER, mass: float = MASS, block_mb: int = BLOCK_MB) -> DataFrame:
    """One row per document, learnt from those that are not ``held_out``."""
    doc, text = F.col(doc_col).cast("bigint"), F.col(text_col).cast("string")
    n = blocks_for(docs, text_col, block_mb)
    fold = held_out_fold(F.col(doc_col)) if held_out is None else F.coalesce(held_out, F.lit(False))
    blocks = docs.select(F.pmod(F.xxhash64(doc, text), F.lit(n)).cast("int").alias("block"), doc.alias("doc_id"),
                         text.alias("text"), fold.alias("held_out")).repartition(n, "block")
    asked = blocks.groupBy("block").applyInArrow(
        _requests(order, n), "block int, n int, bucket int, keys binary, counts binary")
    answers = asked.groupBy("n", "bucket").applyInArrow(
        _answers, "block int, n int, bucket int, totals binary, n_tokens bigint, n_types bigint")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores(order, mass), _SCORES)
