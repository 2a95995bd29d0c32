"""Packing by concatenating and cutting.

All documents' ids are one long run, cut every ``length`` ids. The first pass
encodes and stores each document with its place in its partition; a running sum
over the partitions' totals, one row each, then gives every document its place in
the run. The second pass cuts at the fixed edges. No document is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import new_path
from .encoders import id_type, load
from .rows import column_of, slices, texts_of

LENGTH = 2048
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Pass one: ``part, place, doc_id, n_tokens, ids`` of every document, saved in the shared folder.

    ``place`` counts the ids before it in its partition; ``ids`` are 2 or 4 bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, place = load(tokenizer), TaskContext.get().partitionId(), 0
        end, kind = np.array([end_id], np.uint32), id_type(coder.size)
        for batch in batches:
            for rows in slices(batch):
                ids = [np.concatenate([coder.encode(text), end]).astype(kind) for text in texts_of(rows)]
                sizes = np.array([len(i) for i in ids], np.int64)
                places = place + np.cumsum(sizes) - sizes
                place += int(sizes.sum())
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * len(ids), pa.int64()),
                        "place": pa.array(places),
                        "doc_id": column_of(rows, "doc_id"),
                        "n_tokens": pa.array(sizes),
                        "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
                    }
                )

    schema = "part long, place long, doc_id long, n_tokens long, ids binary"
    path = new_path(documents.sparkSession, "packed-ids")
    documents.select("doc_id", "text").mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(schema).parquet(path)


def placed(ids: DataFrame) -> DataFrame:
    """Encoded documents with ``first``, their place in the whole run.

    The totals are one row per partition of pass one, so their running sum and
    their broadcast are bounded by the number of input splits.
    """
    totals = ids.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return ids.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("first"), "n_tokens", "ids"
    )


def _ids_in(value: bytes, n_tokens: int) -> np.ndarray:
    return np.frombuffer(value, np.uint16 if len(value) == 2 * n_tokens else np.uint32).astype("<u4")


def pieces(documents: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, keep_ids: bool = True) -> DataFrame:
    """One row per document and window it lies in, with its ids (``ids`` as 4-byte integers).

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``. A
    document is its ids and ``end_id``; a null text is the empty one, with the end
    id only. Rows that repeat are packed as often. No documents give no pieces. All
    windows are full but the last, which a reader pads.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "ids"):
                out: list[tuple] = []
                for doc_id, first, n_tokens, value in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    ids = _ids_in(value, n_tokens)
                    start = 0
                    while start < n_tokens:
                        sequence, offset = divmod(first + start, length)
                        part = ids[start : start + length - offset]
                        row = (doc_id, start, len(part), zlib.crc32(part), n_tokens, sequence, offset)
                        out.append((*row, part.tobytes()) if keep_ids else row)
                        start += len(part)
                names = [field.split()[0] for field in PIECE.split(", ")]
                columns = [pa.array(values, pa.int64()) for values in list(zip(*out, strict=True))[:7]]
                if keep_ids:
                    columns.append(pa.array([row[7] for row in out], pa.binary()))
                yield pa.record_batch(columns, names=names + ["ids"] * keep_ids)

    return placed(encoded(documents, tokenizer, end_id)).mapInArrow(cut, PIECE + ", ids binary" * keep_ids)


#: A piece as it stands in its window.
_INSIDE = pa.struct([(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "offset")])
_INSIDE_SQL = "array<struct<doc_id: long, start: long, length: long, doc_tokens: long, offset: long>>"


def windows(documents: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids, pieces``: the windows, the last one padded (``ids`` as 4-byte integers).

    ``pieces`` are the runs of documents in a window, in order. A window that lies
    within one split is put together and written there, in the shared folder. Only
    the fragments at the edges of splits, two each, are shuffled, as boundary records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, inside, began = None, [], [], 0  # next place in the run, ids and pieces of the open window, its offset here

        def closed() -> tuple[int, int, bytes, list[tuple]]:
            data = np.concatenate(held)
            return ((at - 1) // length, began, data.tobytes(), inside)

        for batch in batches:
            for rows in slices(batch, "ids"):
                out = []
                for doc_id, first, n_tokens, value in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    ids, start = _ids_in(value, n_tokens), 0
                    if first != at and held:
                        out.append(closed())
                        held, inside = [], []
                    at = first
                    while start < n_tokens:
                        if not held:
                            began = at % length
                        part = ids[start : start + length - at % length]
                        held.append(part)
                        inside.append((doc_id, start, len(part), n_tokens, at % length))
                        at, start = at + len(part), start + len(part)
                        if at % length == 0:
                            out.append(closed())
                            held, inside = [], []
                yield _fragments(out)
        if held:
            yield _fragments([closed()])

    schema = f"sequence_id long, offset long, n_tokens long, ids binary, pieces {_INSIDE_SQL}"
    path = new_path(documents.sparkSession, "windows")
    found = placed(encoded(documents, tokenizer, end_id)).mapInArrow(run, schema)
    found.write.option("compression", "zstd").parquet(path)
    found = documents.sparkSession.read.schema(schema).parquet(path)
    merged = (
        found.filter(F.col("n_tokens") < length)
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "n_tokens", "ids", "pieces"))).alias("parts"))
        .select(
            "sequence_id",
            F.expr("aggregate(parts, 0L, (a, p) -> a + p.n_tokens)").alias("n_tokens"),
            F.expr("aggregate(parts, X'', (a, p) -> a || p.ids)").alias("ids"),
            F.flatten("parts.pieces").alias("pieces"),
        )
        .withColumn("ids", F.rpad("ids", 4 * length, F.lit(np.array(pad_id, "<i4").tobytes())))
    )
    whole = found.filter(F.col("n_tokens") == length)
    return whole.select("sequence_id", "n_tokens", "ids", "pieces").unionByName(merged)


def sequences(documents: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids array<int>, pieces``: ``windows`` with their ids as arrays."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "ids"):
                ids = [np.frombuffer(value, "<i4") for value in column_of(rows, "ids").to_pylist()]
                yield rows.set_column(rows.schema.get_field_index("ids"), "ids", pa.array(ids, pa.list_(pa.int32())))

    rows = windows(documents, tokenizer, end_id, length, pad_id)
    return rows.mapInArrow(listed, f"sequence_id long, n_tokens long, ids array<int>, pieces {_INSIDE_SQL}")


def pieces_in(found: DataFrame) -> DataFrame:
    """The rows of ``pieces``, with their ids, as they stand in ``windows``.

    Windows are taken apart one at a time: one of empty texts holds as many pieces
    as ids, so a batch of windows has no useful bound.
    """
    own = F.substring("ids", (4 * F.col("p.offset") + 1).cast("int"), (4 * F.col("p.length")).cast("int"))
    return found.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset", own.alias("ids")
    )


def _fragments(rows: list[tuple]) -> pa.RecordBatch:
    inside = [piece for row in rows for piece in row[3]]
    ends = np.cumsum([0, *(len(row[3]) for row in rows)])
    fields = [pa.array([piece[k] for piece in inside], pa.int64()) for k in range(_INSIDE.num_fields)]
    return pa.RecordBatch.from_pydict(
        {
            "sequence_id": pa.array([r[0] for r in rows], pa.int64()),
            "offset": pa.array([r[1] for r in rows], pa.int64()),
            "n_tokens": pa.array([len(r[2]) // 4 for r in rows], pa.int64()),
            "ids": pa.array([r[2] for r in rows], pa.binary()),
            "pieces": pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_INSIDE))
            ),
        }
    )
