"""Document fingerprints from closed syncmers.

A k-mer of a text is an anchor if the smallest of its inner s-mers is its first or
its last. That depends on the k-mer alone, so texts that share a passage share its
anchors wherever it stands, and at least one of every ``k - s + 1`` neighbouring
k-mers is one. A fingerprint keeps the smallest anchor hash of each of a fixed
number of bins; the share of bins that agree estimates the share of anchors in
common. Anchors that two texts share at one distance give the passages they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import column_of, saved, slices, text_bytes

K, S, BINS = 24, 9, 128
#: Code points hashed at a time; a longer text is taken in overlapping stretches.
STRETCH = 1 << 17
#: Bytes of text in a bucket, or what makes ``EDGES`` buckets if that is more: their edges (24 bytes each) are held by
#: the driver and each task, 10 MB at most. At 100 TB a bucket has some 250 MB, which a task sorts and walks as a stream.
BUCKET_BYTES, EDGES = 8 << 20, 400_000
#: What a row counts besides its text.
ROW_BYTES = 64
#: Where documents without an id stand.
LAST = -(2**63)

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number (splitmix64)."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _windows(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` symbols, by joining runs of powers of two."""
    out, done, power, run = None, 0, _A, symbols
    width = 1
    while True:
        if size & width:
            if out is None:
                out = run
            else:
                n = len(symbols) - done - width + 1
                out = out[:n] * power + run[done : done + n]
            done += width
        width *= 2
        if width > size:
            return mixed(out)
        half = width // 2
        run = run[:-half] * power + run[half:]
        power = power * power if width > 2 else power * _B


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers of a text, in order.

    A text without any, as one shorter than ``k`` is and one shorter than ``2k - s``
    may be, is its own single anchor; the empty text has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    with np.errstate(over="ignore"):
        for start in range(0, len(points) - k + 1, STRETCH):
            symbols = points[start : start + STRETCH + k - 1].astype(np.uint64)
            inner = _windows(symbols, s)
            least = _least(inner, k - s + 1)
            chosen = np.flatnonzero((inner[: len(least)] == least) | (inner[k - s :] == least))
            # Any hash of the whole k-mer will do; that of its symbols in turn is one.
            value = np.zeros(len(chosen), np.uint64)
            for step in range(0, k - s + 1, s):
                value = mixed(value ^ inner[chosen + step])
            if (k - s) % s:
                value = mixed(value ^ inner[chosen + k - s])
            places.append(chosen + start)
            hashes.append(value)
    if len(points) and not any(map(len, places)):
        digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        return np.zeros(1, np.int64), np.frombuffer(digest, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def fingerprint(text: str, bins: int = BINS) -> np.ndarray:
    """The sketch of a text's anchors."""
    return sketch(anchors(text)[1], bins)


def sketch(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """For each bin 16 bits that stand for its smallest anchor hash; 0 for a bin without anchors."""
    none = np.uint64(2**64 - 1)
    least = np.full(bins, none)
    np.minimum.at(least, (hashes % np.uint64(bins)).astype(np.intp), hashes)
    return np.where(least == none, 0, mixed(least) >> np.uint64(48) | np.uint64(1)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins with anchors in which two fingerprints agree; 1 for two without any."""
    used = (a != 0) | (b != 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def passage(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int = K) -> tuple[int, int, int]:
    """Start in each text and length of the longest passage that their anchors show in common; length 0 for none.

    Anchors of one hash are paired in turn, the first with the first, so the work is
    linear also where a text repeats itself. Pairs at one distance whose k-mers touch
    are one passage; of equally long ones the first in ``a`` counts.
    """
    by_a, by_b = (np.argsort(hashes, kind="stable") for _, hashes in (a, b))
    of_a, of_b = a[1][by_a], b[1][by_b]
    turn = np.arange(len(of_a)) - np.searchsorted(of_a, of_a)
    at = np.searchsorted(of_b, of_a) + turn
    found = at < np.searchsorted(of_b, of_a, "right")
    if not found.any():
        return 0, 0, 0
    in_a, in_b = a[0][by_a[found]], b[0][by_b[at[found]]]
    order = np.lexsort((in_a, in_b - in_a))
    in_a, in_b = in_a[order], in_b[order]
    firsts = np.flatnonzero(np.r_[True, (np.diff(in_b - in_a) != 0) | (np.diff(in_a) > k)])
    lasts = np.r_[firsts[1:], len(in_a)] - 1
    lengths = in_a[lasts] - in_a[firsts] + k
    best = firsts[np.lexsort((in_a[firsts], -lengths))[0]]
    return int(in_a[best]), int(in_b[best]), int(lengths.max())


def written(values: np.ndarray) -> str:
    """A fingerprint as text, 4 hex digits a bin."""
    return values.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _order(keys: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """Places in the order of documents, as byte strings: descending id, then ascending digest."""
    raw = np.empty((len(keys), 24), np.uint8)
    raw[:, :8] = ((~keys).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    raw[:, 8:] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 16)
    return raw.view("S24").ravel()


def _edges(items: DataFrame, bucket_bytes: int) -> np.ndarray:
    """The first item of each bucket, in order: a new one begins where the next item would overfill it.

    ``items`` are ``key, digest, bytes``, one row for all rows of one id and text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            begins = []
            for size in column_of(batch, "bytes").to_pylist():
                begins.append(held is None or held + size > bucket_bytes)
                held = size if begins[-1] else held + size
            yield batch.select(["key", "digest"]).filter(pa.array(begins, pa.bool_()))

    by = (F.col("key").desc(), F.col("digest"))
    rows = items.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(cut, "key long, digest binary").collect()
    return np.sort(_order(np.array([row["key"] for row in rows], np.int64), [bytes(row["digest"]) for row in rows]))


def _placed(edges: np.ndarray) -> Column:
    """The place of each row ``key, digest``: its bucket times 4, plus 1 for the first row of a
    bucket's first item in a task and 2 for the item's further rows there.

    Those further rows are followed by an equal row, so they need no neighbours: they
    are dealt over all buckets. So an item with any number of rows sends one row of
    each task to its bucket. Which row of a task is first does not matter, as they are equal.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        seen: dict[int, int] = {}
        task = TaskContext.get().partitionId()
        for keys, digests in batches:
            items = _order(keys.to_numpy(np.int64), digests.tolist())
            buckets = np.searchsorted(edges, items, "right") - 1
            places = buckets * 4
            for row in np.flatnonzero(edges[buckets] == items).tolist():
                bucket = int(buckets[row])
                before = seen.get(bucket, 0)
                seen[bucket] = before + 1
                if before:
                    dealt = hashlib.blake2b(f"{bucket} {task} {before}".encode(), digest_size=8).digest()
                    places[row] = int.from_bytes(dealt, "big") % len(edges) * 4 + 2
                else:
                    places[row] += 1
            yield pd.Series(places)

    return F.pandas_udf(run, "long").asNondeterministic()("key", "digest")


def _with_next(documents: DataFrame) -> DataFrame:
    """``bucket, alone, carried, key, digest, doc_id, text``: stretches of documents in descending id.

    Each bucket holds about as many bytes, whatever the ids: equal and null ids are cut
    by the digest of the text. The first item of a bucket also stands (``carried``) at the
    end of the bucket before it, that of the first at the end of the last, so each bucket
    can be walked by itself. Rows that are ``alone`` are followed by an equal row.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("key")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest")
    sizes = documents.select(key, digest, (text_bytes(F.col("text")) + ROW_BYTES).alias("bytes"))
    items = saved(sizes.groupBy("key", "digest").agg(F.sum("bytes").alias("bytes")), "items")
    total = items.agg(F.sum("bytes")).first()[0] or 0
    edges = _edges(items, max(BUCKET_BYTES, -(-total // EDGES)))
    rows = documents.select(key, digest, "doc_id", "text").withColumn("place", _placed(edges))
    bucket, kind = F.shiftright("place", 2), F.col("place").bitwiseAND(3)
    before = F.pmod(bucket - 1, F.lit(max(1, len(edges))))
    no = F.lit(False).alias("carried")
    own = F.struct(bucket.alias("bucket"), (kind == 2).alias("alone"), no)
    also = F.struct(before.alias("bucket"), F.lit(False).alias("alone"), F.lit(True).alias("carried"))
    places = F.when(kind == 1, F.array(own, also)).otherwise(F.array(own))
    return rows.select(F.inline(places), "key", "digest", "doc_id", "text")


def fingerprints(documents: DataFrame, bins: int = BINS) -> DataFrame:
    """Fingerprints of every text and of its edited text, how alike they are, and what the next text shares.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, passage_start, next_start, passage_length``; the last three are the longest
    passage that the anchors of the text and of the next one show in common (null, null, 0
    for none). The next document is the one after in descending id (null ids come
    last; equal ids go by the MD5 of the text), and the first after the last; a single
    document is its own next. A null text is the empty one, with a fingerprint of empty
    bins. Rows that repeat are documents of their own, each followed by the other.
    """
    by = ("bucket", F.col("alone").desc(), "carried", F.col("key").desc(), "digest")
    ordered = _with_next(documents).repartition("bucket").sortWithinPartitions(*by)
    names = ("bucket", "alone", "carried", "doc_id", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, True, None, None)  # of the row before: bucket, carried, id and text with its sketch
        lone, result = None, {}  # the text before that was alone, and its result
        for batch in batches:
            for rows in slices(batch):
                out = []
                columns = (column_of(rows, c).to_pylist() for c in names)
                for bucket, alone, carried, doc_id, text in zip(*columns, strict=True):
                    text = text or ""
                    if alone:
                        if text != lone:
                            one = _Sketched(text, bins)
                            lone, result = text, _compared(None, one, one, bins)
                        out.append(result | {"doc_id": doc_id})
                        continue
                    own = last[3] if last[3] is not None and last[3].text == text else _Sketched(text, bins)
                    if last[0] == bucket and not last[1]:
                        out.append(_compared(last[2], last[3], own, bins))
                    last = (bucket, carried, doc_id, own)
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, passage_start long, next_start long, passage_length long"
    )
    return ordered.select(*names).mapInArrow(walk, schema)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("passage_start", pa.int64()),
        ("next_start", pa.int64()),
        ("passage_length", pa.int64()),
    ]
)


class _Sketched:
    """A text with its anchors and fingerprint."""

    def __init__(self, text: str, bins: int) -> None:
        self.text = text
        self.anchors = anchors(text)
        self.print = sketch(self.anchors[1], bins)


def _compared(doc_id: int | None, own: _Sketched, following: _Sketched, bins: int) -> dict:
    changed = edited(own.text, following.text)
    other = fingerprint(changed, bins)
    start, next_start, length = passage(own.anchors, following.anchors)
    return {
        "doc_id": doc_id,
        "n_chars": len(own.text),
        "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
        "fingerprint": written(own.print),
        "edited_fingerprint": written(other),
        "near_edited": likeness(own.print, other),
        "near_next": likeness(own.print, following.print),
        "passage_start": start if length else None,
        "next_start": next_start if length else None,
        # The anchor of a text without k-mers is the text.
        "passage_length": min(length, len(own.text)),
    }


def anchor_table(documents: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``doc_id, position, anchor``: every anchor of every text, for positional matching."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                for doc_id, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    places, hashes = anchors(text or "", k, s)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([doc_id] * len(places), pa.int64()),
                            "position": pa.array(places.astype(np.int64)),
                            "anchor": pa.array(hashes.view(np.int64)),
                        }
                    )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, position long, anchor long")
