"""Best-fit packing by length patterns and non-negative least squares.

The first pass encodes every document, cuts those over ``length`` into pieces and
stores each with its number among the pieces of its length in its partition. The
histogram of lengths, a bounded array, decides the packing: patterns of up to three
lengths that fill a sequence exactly get repeat counts by non-negative least squares
against the histogram; the counts are rounded without using a length more often than
it occurs, and what is left goes by best fit, longest first, on counts as well. Running
sums per length over the partitions then number all pieces of a length, and a piece's
number alone says which sequence it lies in and where. Only pieces shorter than a
sequence are shuffled, to be put together; full ones are sequences as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import new_path
from .encoders import id_type, load
from .rows import column_of, saved, slices, texts_of

LENGTH = 1024
#: Bound of the patterns of three lengths that are fitted; sequences above about 1,500 ids use an even share of them.
MOST_PATTERNS = 200_000
FIT_STEPS = 400

_ENCODED = "part int, doc_id long, piece int, start long, length int, nth long, ids binary"
_INSIDE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("offset", pa.int64())])
_SEQUENCE = "sequence_id long, n_tokens long, ids binary, pieces array<struct<doc_id: long, piece: int, start: long, length: long, offset: long>>"


def encoded(documents: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """Pass one: the pieces of every document, saved in the shared folder.

    ``part, doc_id, piece, start, length, nth, ids``: a document of more than
    ``length`` ids is cut so that all its pieces but the first are full. ``nth``
    counts the pieces of the same length before it in its partition; ``ids`` are 2 or
    4 bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = load(tokenizer), TaskContext.get().partitionId()
        end, kind = np.array([end_id], np.uint32), id_type(max(coder.size, end_id + 1))
        seen = np.zeros(length + 1, np.int64)
        for batch in batches:
            for rows in slices(batch):
                out: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "nth", "ids")}
                for doc_id, text in zip(column_of(rows, "doc_id").to_pylist(), texts_of(rows), strict=True):
                    ids = np.concatenate([coder.encode(text), end]).astype(kind)
                    first = len(ids) % length or length
                    for piece, stop in enumerate(range(first, len(ids) + 1, length)):
                        start = max(0, stop - length) if piece else 0
                        size = stop - start
                        for name, value in zip(out, (doc_id, piece, start, size, seen[size], ids[start:stop].tobytes()), strict=True):
                            out[name].append(value)
                        seen[size] += 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * len(out["ids"]), pa.int32()),
                        "doc_id": pa.array(out["doc_id"], pa.int64()),
                        "piece": pa.array(out["piece"], pa.int32()),
                        "start": pa.array(out["start"], pa.int64()),
                        "length": pa.array(out["length"], pa.int32()),
                        "nth": pa.array(out["nth"], pa.int64()),
                        "ids": pa.array(out["ids"], pa.binary()),
                    }
                )

    path = new_path(documents.sparkSession, "pieces")
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ENCODED)
    found.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(_ENCODED).parquet(path)


def patterns(present: np.ndarray) -> np.ndarray:
    """Rows of three falling lengths (the last may be 0) that fill a sequence exactly and of which each occurs."""
    length = len(present) - 1
    a, b = np.meshgrid(np.arange(1, length), np.arange(1, length), indexing="ij")
    c = length - a - b
    stride = -(-(length * length) // (12 * MOST_PATTERNS))
    fits = (a >= b) & (b >= c) & (c >= 0) & present[a] & present[b] & ((c == 0) | present[c] & (b % stride == 0))
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def fitted(histogram: np.ndarray, rows: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeats of each pattern by non-negative least squares, with accelerated projected gradients.

    A pattern has three entries, so a step costs one look-up and one count per entry.
    """
    if not len(rows):
        return np.zeros(0)
    target = histogram.astype(np.float64)
    target[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(rows[:, i], x, len(target)) for i in range(3))
        out[0] = 0
        return out

    probe, step = np.ones(len(rows)), 1.0
    for _ in range(30):  # power iteration: the largest curvature bounds the step
        probe = used(probe)[rows].sum(1)
        step = np.linalg.norm(probe)
        probe /= step
    step *= 1.05
    x = ahead = np.zeros(len(rows))
    pace = 1.0
    for _ in range(steps):
        gradient = (used(ahead) - target)[rows].sum(1)
        new = np.maximum(0, ahead - gradient / step)
        if gradient @ (new - x) > 0:
            pace, ahead = 1.0, new
        else:
            after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            ahead, pace = new + (pace - 1) / after * (new - x), after
        x = new
    return x


@dataclass(frozen=True)
class Plan:
    """Which sequence and offset the r-th piece of a length goes to.

    One entry per pattern and length in it, sorted by length and by ``before``: the
    pieces of that length in earlier entries. A pattern holds ``copies`` pieces of the
    length, the first at ``offset``, and its sequences are numbered from ``base``.
    """

    length: np.ndarray
    before: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    base: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank."""
        at = np.searchsorted((self.length << 44) + self.before, (length.astype(np.int64) << 44) + rank, side="right") - 1
        within, copies = rank - self.before[at], self.copies[at]
        return self.base[at] + within // copies, self.offset[at] + within % copies * length


def _best_fit(left: np.ndarray) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Bins for counts of lengths, longest first into the fullest bin that has room.

    Bins of the same content are one entry ``(repeats, ((length, copies), ...))``, so
    the work depends on the lengths and not on how many pieces there are. A bin stays
    the fullest while it has room, so it takes as many copies as fit.
    """
    length = len(left) - 1
    open_bins: dict[int, list[tuple[int, tuple]]] = {}
    done: list[tuple[int, tuple]] = []

    def put(space: int, count: int, content: tuple) -> None:
        (open_bins.setdefault(space, []) if space else done).append((count, content))

    for size in range(length - 1, 0, -1):
        todo = int(left[size])
        for space in sorted(s for s in open_bins if s >= size):
            fit = space // size
            while todo and open_bins[space]:
                count, content = open_bins[space].pop()
                whole = min(count, todo // fit)
                if whole:
                    put(space - fit * size, whole, (*content, (size, fit)))
                    todo -= whole * fit
                count -= whole
                if count and 0 < todo < fit:
                    put(space - todo * size, 1, (*content, (size, todo)))
                    todo, count = 0, count - 1
                if count:
                    open_bins[space].append((count, content))
            if not todo:
                break
        fit = length // size
        if todo // fit:
            put(length - fit * size, todo // fit, ((size, fit),))
        if todo % fit:
            put(length - todo % fit * size, 1, ((size, todo % fit),))
    return done + [entry for entries in open_bins.values() for entry in entries]


def plan(histogram: np.ndarray) -> Plan:
    """The packing of ``histogram[l]`` pieces of each length below the last index, the sequence length."""
    left = histogram.astype(np.int64).copy()
    left[0] = left[-1] = 0
    rows = patterns(left > 0)
    # Neighbouring patterns share what rounding leaves, so totals stay and small repeats do not vanish.
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))[::-1]]
    repeats = np.diff(np.floor(np.cumsum(np.concatenate([[0.5], fitted(left, rows)]))).astype(np.int64))
    bins: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    for row, count in zip(rows[repeats > 0].tolist(), repeats[repeats > 0].tolist(), strict=True):
        content = tuple((size, row.count(size)) for size in sorted({*row} - {0}, reverse=True))
        count = min(count, *(int(left[size]) // copies for size, copies in content))
        if count:
            bins.append((count, content))
            for size, copies in content:
                left[size] -= count * copies
    bins += _best_fit(left)
    entries, base = [], 0
    before = np.zeros(len(left), np.int64)
    for count, content in bins:
        offset = 0
        for size, copies in content:
            entries.append((size, int(before[size]), copies, offset, base))
            before[size] += count * copies
            offset += size * copies
        base += count
    columns = np.array(sorted(entries), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=base)


def _numbered(pieces: DataFrame, length: int) -> tuple[DataFrame, np.ndarray]:
    """The pieces below ``length`` with ``rank``, their number among all of their length, and their histogram.

    One row per partition and length is summed up per length; Spark joins these rows
    back by what they measure, in the pieces' tasks where they are few.
    """
    short = pieces.filter(F.col("length") < length)
    counted = short.groupBy("part", "length").agg(F.count("*").alias("pieces"))
    files = max(1, pieces.sparkSession.sparkContext.defaultParallelism)  # few rows: a file per core, not per shuffle partition
    counts = saved(counted.coalesce(files), "piece-counts")
    histogram = np.zeros(length + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect():  # fewer rows than a sequence has ids
        histogram[row.length] = row.pieces
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("pieces").over(earlier), F.lit(0))
    bases = counts.select("part", "length", before.alias("before"))
    ranked = short.join(bases, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    return ranked.select("doc_id", "piece", "start", "length", "rank", "ids"), histogram


def _wide(value: bytes, size: int) -> bytes:
    return value if len(value) == 4 * size else np.frombuffer(value, "<u2").astype("<u4").tobytes()


def _sequence_rows(found: list[tuple[int, list[tuple]]]) -> pa.RecordBatch:
    """Sequences from ``(sequence_id, [(doc_id, piece, start, length, offset, ids), ...])``."""
    inside = [row[:5] for _, rows in found for row in rows]
    ends = np.cumsum([0, *(len(rows) for _, rows in found)])
    fields = [pa.array([row[i] for row in inside], field.type) for i, field in enumerate(_INSIDE)]
    return pa.RecordBatch.from_pydict(
        {
            "sequence_id": pa.array([at for at, _ in found], pa.int64()),
            "n_tokens": pa.array([sum(row[3] for row in rows) for _, rows in found], pa.int64()),
            "ids": pa.array([b"".join(_wide(row[5], row[3]) for row in rows) for _, rows in found], pa.binary()),
            "pieces": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_INSIDE))),
        }
    )


def sequences(documents: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """``sequence_id, n_tokens, ids, pieces``: all documents in few sequences of at most ``length`` ids.

    A document is its ids and ``end_id``; a null text is the empty one, the end id
    alone. Rows that repeat are packed as often, null ids are carried through, no
    documents give no sequences, other columns are not read. ``ids`` are 4-byte
    integers without padding; ``pieces`` are in order of their offset. Sequences of one
    full piece have negative numbers, the others count from 0.
    """
    pieces = encoded(documents, tokenizer, end_id, length)
    ranked, histogram = _numbered(pieces, length)
    packing = plan(histogram)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = column_of(batch, "length").to_numpy().astype(np.int64)
            sequence, offset = packing.place(sizes, column_of(batch, "rank").to_numpy())
            kept = {name: column_of(batch, name) for name in ("doc_id", "piece", "start", "length", "ids")}
            yield pa.RecordBatch.from_pydict({"sequence_id": pa.array(sequence), "offset": pa.array(offset), **kept})

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, rows = None, []
        for batch in batches:
            for part in slices(batch, "ids"):
                done = []
                columns = (column_of(part, name).to_pylist() for name in ("sequence_id", "doc_id", "piece", "start", "length", "offset", "ids"))
                for at, *row in zip(*columns, strict=True):
                    if at != open_id and rows:
                        done.append((open_id, rows))
                        rows = []
                    open_id = at
                    rows.append(row)
                if done:
                    yield _sequence_rows(done)
        if rows:
            yield _sequence_rows([(open_id, rows)])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                columns = (column_of(part, name).to_pylist() for name in ("part", "nth", "doc_id", "piece", "start", "length", "ids"))
                rows = zip(*columns, strict=True)
                yield _sequence_rows([(-1 - (split << 32 | nth), [(*row, 0, ids)]) for split, nth, *row, ids in rows])

    by_sequence = ranked.mapInArrow(
        placed, "sequence_id long, offset long, doc_id long, piece int, start long, length int, ids binary"
    ).repartition("sequence_id")
    packed = by_sequence.sortWithinPartitions("sequence_id", "offset").mapInArrow(together, _SEQUENCE)
    return packed.unionByName(pieces.filter(F.col("length") == length).mapInArrow(alone, _SEQUENCE))


def pieces_in(found: DataFrame) -> DataFrame:
    """One row per piece as it stands in ``sequences``, with its ids and their checksum.

    Sequences are taken apart one at a time: one of empty texts holds as many pieces
    as ids, so a batch of sequences has no useful bound.
    """
    own = F.substring("ids", (4 * F.col("p.offset") + 1).cast("int"), (4 * F.col("p.length")).cast("int"))
    return found.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.piece", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "sequence_id", "p.offset", own.alias("ids")
    )
