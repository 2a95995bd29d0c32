"""Token ids as Arrow files of equal-length sequences and masks.

A file holds one run of documents in order: record batches of ``ids
fixed_size_list<uint16 or uint32>[length]`` and ``mask fixed_size_list<bool>[length]``,
the last sequence padded under a false mask. Beside it lies the index of its
documents (id, first token, tokens). Sequences and documents are slices of the
mapped file, so random access copies nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encoders import id_type, load
from .rows import column_of, saved, slices, text_bytes, texts_of

SEQUENCES_PER_BATCH = 512
INDEX_ROWS = 4096
BYTES_PER_FILE = 32 << 20
#: More text than this many files hold makes larger files: a task streams its share, whatever its size.
MOST_FILES = 20_000


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or file, as executors open it."""
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class _Writer:
    """One sequence file and its index, written as a stream; holds one batch at a time."""

    def __init__(self, folder: str, name: str, length: int, kind: type) -> None:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        self.length, self.kind, self.start = length, kind, 0
        self.schema = pa.schema({"ids": pa.list_(pa.from_numpy_dtype(kind), length), "mask": pa.list_(pa.bool_(), length)})
        index = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})
        self.streams = [fs.open_output_stream(f"{root}/{name}{end}") for end in (".arrow", ".docs.arrow")]
        self.data, self.index = (
            pa.ipc.new_file(stream, s) for stream, s in zip(self.streams, (self.schema, index), strict=True)
        )
        self.room = length * SEQUENCES_PER_BATCH
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.start, len(ids)))
        self.start += len(ids)
        if len(self.docs) >= INDEX_ROWS:
            self._write_index()
        while len(ids):
            part = ids[: self.room - self.n_held].astype(self.kind)
            self.held.append(part)
            self.n_held += len(part)
            ids = ids[len(part) :]
            if self.n_held == self.room:
                self._write_batch()

    def _write_batch(self) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        padding = -len(ids) % self.length
        mask = np.concatenate([np.ones(len(ids), bool), np.zeros(padding, bool)])
        ids = np.concatenate([ids, np.zeros(padding, self.kind)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (ids, mask)]
        self.data.write_batch(pa.record_batch(columns, schema=self.schema))
        self.held, self.n_held = [], 0

    def _write_index(self) -> None:
        columns = [pa.array(values, pa.int64()) for values in zip(*self.docs, strict=True)]
        self.index.write_batch(pa.record_batch(columns, names=["doc_id", "start", "n_tokens"]))
        self.docs = []

    def close(self) -> None:
        if self.n_held:
            self._write_batch()
        if self.docs:
            self._write_index()
        for part in (self.data, self.index, *self.streams):
            part.close()


class SequenceFile:
    """Reader of one file: sequences, masks and documents as views of the mapped file."""

    def __init__(self, uri: str) -> None:
        fs, path = file_system(uri)

        def opened(name: str) -> pa.NativeFile:
            return pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name)

        self.data = pa.ipc.open_file(opened(path))
        self.index = pa.ipc.open_file(opened(path.removesuffix(".arrow") + ".docs.arrow"))
        self.length = self.data.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def _ids(self, k: int) -> np.ndarray:
        if self._at != k:
            self._at, self._batch = k, self.data.get_batch(k)
        return self._batch.column(0).flatten().to_numpy()

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of one sequence."""
        ids = self._ids(k // SEQUENCES_PER_BATCH)
        at = k % SEQUENCES_PER_BATCH * self.length
        mask = self._batch.column(1).flatten().slice(at, self.length)
        return ids[at : at + self.length], mask

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Ids from ``start`` on, one view per record batch they lie in."""
        size = self.length * SEQUENCES_PER_BATCH
        while count:
            k, at = divmod(start, size)
            view = self._ids(k)[at : at + count]
            yield view
            start, count = start + len(view), count - len(view)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """Id, first token and tokens of each document, in order."""
        for k in range(self.index.num_record_batches):
            yield from zip(*(column.to_pylist() for column in self.index.get_batch(k).columns), strict=True)


def write_sequences(
    documents: DataFrame, tokenizer: str, end_id: int, folder: str, length: int = 2048, bytes_per_file: int = BYTES_PER_FILE
) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the ids in ascending ``doc_id`` order.

    Returns one row per file: ``part, file, n_docs, n_tokens``, saved in the shared
    folder; a failed task's file is in no row. Documents are range-partitioned by id
    (a null id first, equal ids by text), so files in ``part`` order are the whole
    order and no task holds more than a share. A null text is the empty one and has
    the end id only; rows that repeat are written as often. No documents: no files.
    """
    total = documents.agg(F.sum(text_bytes(F.col("text"))).alias("bytes")).first()
    parts = min(MOST_FILES, max(1, -(-(total["bytes"] or 0) // bytes_per_file)))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ranged = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order, "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, n_docs = load(tokenizer), None, 0
        part = TaskContext.get().partitionId()
        name = f"sequences-{part:06d}-{uuid4().hex}"
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for rows in slices(batch):
                writer = writer or _Writer(folder, name, length, id_type(coder.size))
                for doc_id, text in zip(column_of(rows, "doc_id").to_pylist(), texts_of(rows), strict=True):
                    writer.add(doc_id, np.concatenate([coder.encode(text), end]))
                    n_docs += 1
        if writer:
            writer.close()
            row = {"part": [part], "file": [f"{folder}/{name}.arrow"], "n_docs": [n_docs], "n_tokens": [writer.start]}
            yield pa.RecordBatch.from_pydict(row)

    return saved(ranged.mapInArrow(write, "part long, file string, n_docs long, n_tokens long"), "sequence-files")


def read_documents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the tokens of all files before (a running sum over one row per
    file) and of the documents before in its file. The checksum is over the ids as
    little-endian unsigned 32-bit integers. The sequences are read as views.
    """
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.select("file", F.coalesce(before, F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                opened, rows = SequenceFile(file), []
                for doc_id, start, n_tokens in opened.documents():
                    crc = 0
                    for view in opened.tokens(start, n_tokens):
                        crc = zlib.crc32(view.astype("<u4"), crc)
                    rows.append((doc_id, base + start, n_tokens, crc))
                    if len(rows) >= INDEX_ROWS:
                        yield _doc_rows(rows)
                        rows = []
                if rows:
                    yield _doc_rows(rows)

    spread = placed.repartition(max(1, spark.sparkContext.defaultParallelism) * 4)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _doc_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, pa.int64()) for values in zip(*rows, strict=True)]
    return pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
