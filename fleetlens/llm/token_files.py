"""Token ids in Arrow files of fixed-size lists.

All documents, in ascending order of their id, make one stream of ids; each
partition of that order writes its part of the stream as one file in Arrow's
file format (the stream format with a footer of batch positions).  A row of a
file is a sequence of exactly ``length`` ids with two masks of that length:
``real`` (false on the padding at the end of a file) and ``document_end``.  All
batches but a file's last hold ``ROWS`` rows, so sequence ``i`` is row
``i % ROWS`` of batch ``i // ROWS``; a memory map gives it without a copy.  A
second file lists the documents: id, place in the file's stream, ids.

A task writes under a name of its own attempt and renames the files when they
are complete, so a task that is run again leaves one pair of files.  The folder
must be one that ``pyarrow.fs`` can open, as all executors can.

Defined results: a NULL or empty text is the end id alone; documents of one
id, or without one (they come last), follow each other in the order of a hash
of their text; extra columns are not read; an empty table writes no file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded_batches, shared_path, write_shared
from fleetlens.llm.tokens import word_ids

LENGTH = 2048
ROWS = 64  # sequences of a batch
END_ID = 1

MANIFEST = "part int, sequences string, documents string, n_documents bigint, n_tokens bigint, n_sequences bigint"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Collects ids and writes full batches of sequences."""

    def __init__(self, sink, length: int, dtype: np.dtype):
        self.length, self.dtype = length, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("real", pa.list_(pa.bool_(), length)),
                                 ("document_end", pa.list_(pa.bool_(), length))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.ends: list[int] = []  # places of document ends among the waiting ids
        self.waiting = self.n_tokens = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        """One document, its end id included."""
        self.parts.append(ids)
        self.waiting += len(ids)
        self.n_tokens += len(ids)
        self.ends.append(self.waiting - 1)
        if self.waiting >= ROWS * self.length:
            self._write(self.waiting // (ROWS * self.length) * ROWS * self.length)

    def _write(self, n: int) -> None:
        flat = np.concatenate([*self.parts, np.empty(0, self.dtype)]).astype(self.dtype)
        marks = np.zeros(max(n, len(flat)), bool)
        marks[self.ends] = True
        ids = np.zeros(n, self.dtype)
        real = np.arange(n) < len(flat)
        ids[:min(n, len(flat))] = flat[:n]
        for a in range(0, n, ROWS * self.length):
            b = min(n, a + ROWS * self.length)
            self.out.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(x[a:b]), self.length)
                for x in (ids, real, marks)], schema=self.schema))
        self.n_sequences += n // self.length
        self.parts, self.waiting = [flat[n:]], max(0, len(flat) - n)
        self.ends = [e - n for e in self.ends if e >= n]

    def close(self) -> None:
        if self.waiting:
            self._write(-(-self.waiting // self.length) * self.length)
        self.out.close()


class SequenceFile:
    """Random access to the sequences of one file; ids and masks are views of
    the mapped file."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        self.source = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size

    def batch_ids(self, i: int) -> np.ndarray:
        return self.file.get_batch(i).column("ids").flatten().to_numpy()

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Ids, ``real`` and ``document_end`` of sequence ``i``."""
        batch = self.file.get_batch(i // ROWS)
        ids, real, ends = (batch.column(c)[i % ROWS].values for c in ("ids", "real", "document_end"))
        return ids.to_numpy(), real, ends

    def slices(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from place ``start`` of the file's stream on, by batches."""
        size = ROWS * self.length
        while n > 0:
            ids = self.batch_ids(start // size)[start % size:start % size + n]
            yield ids
            start, n = start + len(ids), n - len(ids)


def write_token_files(docs: DataFrame, folder: str, doc_col: str = "doc_id", text_col: str = "text", *,
                      tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
                      dtype: str = "uint16") -> DataFrame:
    """Write all documents below ``folder``; one manifest row per file pair.
    ``dtype`` must hold the vocabulary's largest id."""
    tokenizer, kind = tokenizer or default_tokenizer(), np.dtype(dtype)
    text = F.col(text_col).cast("string")
    ordered = (bounded_batches(docs).select(F.col(doc_col).cast("bigint").alias("doc_id"), text.alias("text"))
               .orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = _open(folder)
        names = [f"part-{task.partitionId():06d}.{x}.arrow" for x in ("sequences", "documents")]
        mine = [f"{root}/_attempt-{task.taskAttemptId()}-{n}" for n in names]
        writer = index = None
        n_documents = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(root, recursive=True)
                sinks = [system.open_output_stream(x) for x in mine]
                writer, index = SequenceWriter(sinks[0], length, kind), pa.ipc.new_file(sinks[1], _INDEX)
            texts = pc.fill_null(batch.column(1), "")
            starts, counts = [], []
            for ids in word_ids(texts, tokenizer):
                starts.append(writer.n_tokens)
                counts.append(len(ids) + 1)
                writer.add(np.append(ids, np.uint32(end_id)).astype(kind))
            index.write_batch(pa.record_batch([batch.column(0), pa.array(starts, pa.int64()),
                                               pa.array(counts, pa.int64())], schema=_INDEX))
            n_documents += len(starts)
        if writer is None:
            return
        writer.close()
        index.close()
        for sink, name, own in zip(sinks, names, mine):
            sink.close()
            system.move(own, f"{root}/{name}")
        base = folder.rstrip("/")
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([task.partitionId()], pa.int32()), "sequences": [f"{base}/{names[0]}"],
            "documents": [f"{base}/{names[1]}"], "n_documents": [n_documents], "n_tokens": [writer.n_tokens],
            "n_sequences": [writer.n_sequences]})

    return ordered.mapInArrow(run, MANIFEST)


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from the files
    alone; ``start`` counts the ids of all files before."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequences = SequenceFile(row["sequences"])
                system, path = _open(row["documents"])
                index = pa.ipc.open_file(system.open_input_file(path))
                for k in range(index.num_record_batches):
                    part = index.get_batch(k)
                    crcs = []
                    for start, count in zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist()):
                        crc = 0
                        for ids in sequences.slices(start, count):
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pc.add(part.column("start"), row["base"]), part.column("n_tokens"),
                         pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (placed.select("sequences", "documents", "base").repartition(n)
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def encode_and_read_back(docs: DataFrame, **options) -> DataFrame:
    """Write all documents to a new shared folder and read them back."""
    folder = shared_path(docs.sparkSession, "tokens")
    return read_documents(write_shared(write_token_files(docs, folder, **options), "tokens-manifest"))
