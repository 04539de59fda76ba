"""Packing documents into sequences of a fixed length, by hierarchical
best fit.

A document's ids end with an end id.  Documents longer than a sequence are cut
from the back into full pieces; what is left in front is the first, shorter
piece.  Every partition packs its pieces best fit, longest first: a piece goes
to the sequence it leaves the least room in.  Sequences with no more than
``SLACK`` places left are done.  Underfull ones become items as a whole: they
are dealt to groups of at most ``GROUP`` items, packed best fit again, and the
sequences that are still underfull meet in fewer groups, until one group has
been packed or a round joins hardly any.

Defined results: a NULL or empty text is the end id alone; rows are packed
each on their own, whatever their ids; extra columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded_batches, drop_shared, write_shared
from fleetlens.llm.tokens import CHUNK_BYTES, byte_level_ids, gathered, text_chunks

LENGTH = 1024
END_ID = 2
SLACK = 8
GROUP = 50_000  # items that one task packs in a round
FEWER = 0.01  # a round that joins less than this share of its items is the last


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: ``(bin, offset)`` of each item and the fill of
    each bin.  Bins of one residual form a stack; the non-empty residuals are
    the bits of a number, so the best one is its lowest bit from the length
    on."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, fill = 0, []
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = free >> n
        if fits:
            room = n + ((fits & -fits).bit_length() - 1)
            b = stacks[room].pop()
            if not stacks[room]:
                free &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, capacity - room
        fill[b] += n
        if room > n:
            stacks[room - n].append(b)
            free |= 1 << (room - n)
    return bins, offsets, np.array(fill, np.int64)


_PIECES = ("doc_id bigint, row_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, "
           "place bigint, fill bigint")
HELD_PIECES, HELD_IDS = 100_000, 8 << 20  # what a task packs at a time, without and with ids
# A task that hands on ids holds them beside the texts: it encodes less text at
# a time, and hands on as many pieces (of up to LENGTH ids each) at a time.
CHUNK_WITH_IDS, ROWS_WITH_IDS = 1 << 20, 512


def pack_partitions(docs: DataFrame, doc_col: str, text_col: str, tokenizer: str, *, length: int = LENGTH,
                    end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, each partition packed on its own, in parts of
    bounded size.  ``row_id`` tells rows apart, also copies of one document."""
    def packed(rows: list[tuple], flat: list[np.ndarray], first_bin: int) -> tuple[pa.Table, int]:
        doc, row_id, piece, start, size, crc = zip(*rows)
        sizes = np.array(size, np.int64)
        bins, place, fill = best_fit(sizes, length)
        table = pa.table({"doc_id": pa.array(doc, pa.int64()), "row_id": pa.array(row_id, pa.int64()),
                          "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                          "length": sizes, "ids_crc32": pa.array(crc, pa.int64()), "bin": first_bin + bins,
                          "place": place, "fill": fill[bins]})
        if with_ids:  # the lists are views of the ids that are held
            ends, lists, a = np.concatenate([[0], np.cumsum(sizes)]), [], 0
            for ids in flat:
                b = int(np.searchsorted(ends, ends[a] + len(ids)))
                lists.append(pa.ListArray.from_arrays(pa.array((ends[a:b + 1] - ends[a]).astype(np.int32)),
                                                      pa.array(ids)))
                a = b
            table = table.append_column("ids", pa.chunked_array(lists))
        return table, first_bin + len(fill)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = next_bin = TaskContext.get().partitionId() << 40
        most = ROWS_WITH_IDS if with_ids else 4096
        rows: list[tuple] = []
        flat: list[np.ndarray] = []  # ids of whole runs of rows, one after another
        held = 0
        for batch in batches if with_ids else gathered(batches, 1):
            texts = pc.fill_null(batch.column(1), "")
            names = batch.column(0).to_pylist()
            for at, part in text_chunks(texts, CHUNK_WITH_IDS if with_ids else CHUNK_BYTES):
                ids: list[np.ndarray] = []
                for d, row in zip(names[at:at + len(part)], byte_level_ids(part, tokenizer)):
                    row = np.append(row, np.uint32(end_id)).astype("<u4", copy=False)
                    cuts = [0, *range(len(row) % length or length, len(row) + 1, length)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((d, row_id, k, a, b - a, zlib.crc32(row[a:b])))
                    row_id += 1
                    if with_ids:
                        ids.append(row)
                        held += len(row)
                    if len(rows) >= HELD_PIECES or held >= HELD_IDS:
                        flat += [np.concatenate(ids).view(np.int32)] if ids else []
                        table, next_bin = packed(rows, flat, next_bin)
                        rows, flat, ids, held = [], [], [], 0
                        yield from table.to_batches(max_chunksize=most)
                        del table
                flat += [np.concatenate(ids).view(np.int32)] if ids else []
            pa.default_memory_pool().release_unused()  # the worker lives on, beside its executor's heap
        if rows:
            yield from packed(rows, flat, next_bin)[0].to_batches(max_chunksize=most)
            rows, flat = [], []
            pa.default_memory_pool().release_unused()

    return (bounded_batches(docs).select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, _PIECES + ", ids array<int>" * with_ids))


def merge_round(items: DataFrame, groups: int, length: int, salt: int) -> DataFrame:
    """One best-fit round over underfull sequences ``bin, fill``: the sequence
    ``into`` that each goes to, its ``place`` there and that one's fill."""
    def run(table: pa.Table) -> pa.Table:
        name, size = table["bin"].to_numpy(), table["fill"].to_numpy()
        order = np.argsort(name)
        name, size = name[order], size[order]
        bins, place, fill = best_fit(size, length)
        # a sequence keeps the name of its first item
        first = np.zeros(len(fill), np.int64)
        first[bins[place == 0]] = name[place == 0]
        return pa.table({"bin": name, "into": first[bins], "place": place, "fill": fill[bins]})

    group = F.pmod(F.xxhash64(F.lit(salt), "bin"), F.lit(groups))
    return (items.select("bin", "fill", group.alias("group")).groupBy("group")
            .applyInArrow(run, "bin bigint, into bigint, place bigint, fill bigint"))


def pack(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None,
         length: int = LENGTH, end_id: int = END_ID, slack: int = SLACK, group: int = GROUP,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, row_id, piece, start, length, ids_crc32,
    sequence_id, offset`` and, if asked for, the piece's ``ids``.  Copies of a
    document differ in ``row_id``, so ``row_id, piece`` is a key."""
    pieces = write_shared(pack_partitions(docs, doc_col, text_col, tokenizer or default_tokenizer(), length=length,
                                          end_id=end_id, with_ids=with_ids), "pieces")
    # where each underfull sequence of the partitions ended up so far
    moved = (pieces.where((F.col("fill") < length - slack) & (F.col("place") == 0))
             .select("bin", F.col("bin").alias("into"), F.lit(0).cast("bigint").alias("shift"), "fill"))
    moved = write_shared(moved, "bins")
    salt = 0
    while True:
        items = moved.where((F.col("into") == F.col("bin")) & (F.col("fill") < length - slack)).select("bin", "fill")
        n = items.count()
        groups = -(-n // group)
        if n < 2:
            break
        result = write_shared(merge_round(items, groups, length, salt), "bins")
        joined = result.where("bin <> into").count()
        step = result.select(F.col("bin").alias("old"), F.col("into").alias("new"), F.col("place").alias("at"),
                             F.col("fill").alias("sum"))
        new = write_shared(moved.join(step, moved["into"] == step["old"], "left").select(
            "bin", F.coalesce("new", "into").alias("into"),
            (F.col("shift") + F.coalesce("at", F.lit(0))).alias("shift"),
            F.coalesce("sum", "fill").alias("fill")), "bins")
        drop_shared(moved)
        drop_shared(result)
        moved, salt = new, salt + 1
        if groups == 1 or joined < FEWER * n:
            break
    # nearly full sequences stay where they are: only the pieces of others move
    ids = ["ids"] if with_ids else []
    columns = ["doc_id", "row_id", "piece", "start", "length", "ids_crc32"]
    stay = pieces.where(F.col("fill") >= length - slack).select(
        *columns, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"), *ids)
    rest = pieces.where(F.col("fill") < length - slack).join(
        moved.select(F.col("bin").alias("from"), "into", "shift"), F.col("bin") == F.col("from"))
    return stay.unionByName(rest.select(*columns, F.col("into").alias("sequence_id"),
                                        (F.col("place") + F.col("shift")).alias("offset"), *ids))
