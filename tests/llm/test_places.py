"""Hilbert shards and syncmer fingerprints."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import SMALL
from llm_edges import EDGES, LONG, edge_docs, edges, no_docs  # noqa: F401
from tollbook.llm import hilbert, syncmers
from tollbook.workspace import new_path


@pytest.mark.parametrize("n, bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbouring_cells(spark, n, bits):
    names = [f"x{k}" for k in range(n)]
    cells = spark.range(2 ** (n * bits)).select(
        *[F.shiftright("id", k * bits).bitwiseAND(F.lit(2**bits - 1)).cast("int").alias(name) for k, name in enumerate(names)]
    )
    cells = cells.select("*", *[F.col(name).alias(f"at_{name}") for name in names])
    rows = hilbert.with_curve_index(cells, names, bits).orderBy("curve").collect()
    assert [r.curve for r in rows] == list(range(2 ** (n * bits)))
    places = np.array([[r[f"at_{name}"] for name in names] for r in rows])
    assert (np.abs(np.diff(places, axis=0)).sum(1) == 1).all()


def curve_by_hand(axes, bits):
    """Index of one cell with plain integers, a cell at a time: undo excess turns, Gray code, interleave."""
    x, n = list(axes), len(axes)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            flip ^= q - 1
        q >>= 1
    x = [value ^ flip for value in x]
    return int("".join(str(value >> bit & 1) for bit in range(bits - 1, -1, -1) for value in x), 2)


def test_every_document_is_at_its_place_on_the_curve(spark):
    """The rows of the operator against steps and index worked out in plain Python."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in driver.queries()["op6_hilbert_shards"](spark, SMALL).collect():
        doc, cells = docs[r.doc_id], 1 << hilbert.BITS
        size = min(int(np.floor(np.log2(len(doc.text.encode()) + 2) * (cells / 32))), cells - 1)
        names = [zlib.crc32(name.encode()) % cells for name in (doc.source, doc.lang)]
        assert r.curve == curve_by_hand([size, *names], hilbert.BITS)


def check_shards(rows, docs, shards=8):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    assert max(counts.values()) - min(counts[k] for k in range(shards)) <= 1
    for k in counts:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(counts[k]))
    ordered = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)


def test_op6_shards(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = driver.queries()["op6_hilbert_shards"](spark, SMALL).collect()
    check_shards(rows, docs)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_op6_uses_built_in_functions_only(spark):
    plan = driver.queries()["op6_hilbert_shards"](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExternalRDD"))


def test_op6_edges(edges, no_docs):
    check_shards(hilbert.hilbert_shards(edges).collect(), [(row[0], row[1]) for row in EDGES])
    assert hilbert.hilbert_shards(no_docs).collect() == []


def test_files_of_shards_prune_on_several_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path = new_path(spark, "shards")
    hilbert.write_shards(docs, hilbert.hilbert_shards(docs, 4), path)
    back = spark.read.parquet(path)
    assert sorted(r.doc_id for r in back.select("doc_id").collect()) == list(range(docs.count()))
    steps = docs.select(hilbert.size_step(F.octet_length("text")).alias("z"), "doc_id").collect()
    spread = {r.doc_id: r.z for r in steps}
    width = [len({spread[r.doc_id] for r in back.filter(back.shard == k).select("doc_id").collect()}) for k in range(4)]
    assert sum(width) / 4 < len(set(spread.values()))


def test_shards_are_not_written_where_the_id_is_no_key(spark):
    rows = [(1, "a"), (2, "b"), (3, "c")]
    for more, message in (((None, "d"), "document None"), ((2, "d"), "document 2 has 2 rows")):
        docs = spark.createDataFrame([(i, t, "en", "s") for i, t in [*rows, more]], "doc_id long, text string, lang string, source string")
        path = new_path(spark, "refused")
        with pytest.raises(ValueError, match=message):
            hilbert.write_shards(docs, hilbert.hilbert_shards(docs, 2), path)
    docs = docs.dropDuplicates(["doc_id"])
    placed = hilbert.hilbert_shards(docs, 2)
    with pytest.raises(ValueError, match="1 rows and 0 places"):
        hilbert.write_shards(docs, placed.filter("doc_id <> 3"), path)
    hilbert.write_shards(docs, placed, path)
    assert sorted(r.doc_id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def fingerprint_by_definition(text, bins=syncmers.BINS):
    """Anchors found one k-mer at a time, the smallest kept of each bin."""
    places, hashes = syncmers.anchors(text)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        inner = syncmers._windows(points, syncmers.S).tolist() if len(points) >= syncmers.S else []
    width = syncmers.K - syncmers.S + 1
    closed = [i for i in range(len(text) - syncmers.K + 1) if min(inner[i : i + width]) in (inner[i], inner[i + width - 1])]
    assert places.tolist() == (closed or [0] * bool(text))
    least = {}
    for value in hashes.tolist():
        least[value % bins] = min(value, least.get(value % bins, value))
    mask = 2**64 - 1

    def splitmix(x):
        x = (x + 0x9E3779B97F4A7C15) & mask
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    return "".join(f"{splitmix(least[b]) >> 48 | 1 if b in least else 0:04x}" for b in range(bins))


def test_fingerprints_by_definition(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    for text in [*texts, "", "short", LONG[:3000], "日本語の文章です。" * 9]:
        assert syncmers.written(syncmers.fingerprint(text)) == fingerprint_by_definition(text)


def test_closed_syncmers_by_definition():
    text, k, s = "the quick brown fox jumps over the lazy dog, and the quick brown fox rests" * 3, 12, 5
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        inner = syncmers._windows(points, s)
    assert len({text[i : i + s]: inner[i] for i in range(len(inner))}) == len(set(inner.tolist()))
    want = []
    for i in range(len(text) - k + 1):
        window = inner[i : i + k - s + 1]
        if window.min() in (window[0], window[-1]):
            want.append(i)
    places, hashes = syncmers.anchors(text, k, s)
    assert places.tolist() == want
    by_kmer = {}
    for place, value in zip(places.tolist(), hashes.tolist(), strict=True):
        assert by_kmer.setdefault(text[place : place + k], value) == value


def test_anchors_do_not_depend_on_context_or_stretches(monkeypatch):
    passage = "a passage of some length that several documents share, word for word, " * 4
    at = [dict(zip(*(a.tolist() for a in syncmers.anchors(before + passage)), strict=True)) for before in ("", "xyz " * 50)]
    assert {p + 200: h for p, h in at[0].items()}.items() <= at[1].items()
    whole = syncmers.anchors(LONG[:5000])
    monkeypatch.setattr(syncmers, "STRETCH", 700)
    assert all((a == b).all() for a, b in zip(syncmers.anchors(LONG[:5000]), whole, strict=True))
    assert np.diff(syncmers.anchors(LONG[:5000])[0]).max() <= syncmers.K - syncmers.S + 1


def test_short_texts_have_an_anchor_and_fingerprints_of_their_own(spark):
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("abcdefgh "), n)) for n in range(1, 48) for _ in range(20)]
    texts = sorted({t for t in texts if len(t) > 4})
    assert all(len(syncmers.anchors(t)[0]) for t in texts)
    prints = {syncmers.written(syncmers.fingerprint(t)) for t in [*texts, ""]}
    assert len(prints) == len(texts) + 1
    rows = syncmers.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts) and max(r.near_edited for r in rows) < 1 and max(r.near_next for r in rows) < 1


def check_fingerprints(rows, docs):
    following = {docs[i][0]: docs[(i + 1) % len(docs)][1] or "" for i in range(len(docs))}
    texts = {i: t or "" for i, t in docs}
    prints = {i: syncmers.fingerprint(t) for i, t in texts.items()}
    assert len(rows) == len(docs)
    for r in rows:
        text = texts[r.doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[r.doc_id][:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == syncmers.written(prints[r.doc_id])
        other = syncmers.fingerprint(edited)
        assert r.edited_fingerprint == syncmers.written(other)
        assert r.near_edited == syncmers.likeness(prints[r.doc_id], other)
        assert r.near_next == syncmers.likeness(prints[r.doc_id], syncmers.fingerprint(following[r.doc_id]))


def test_op9_fingerprints(spark, monkeypatch):
    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()), reverse=True)
    rows = driver.queries()["op9_syncmers"](spark, SMALL).collect()
    check_fingerprints(rows, docs)
    assert np.mean([r.near_edited for r in rows]) > 0.25 and np.mean([r.near_next for r in rows]) < 0.05
    monkeypatch.setattr(syncmers, "BUCKET_BYTES", 20_000)  # many buckets
    check_fingerprints(syncmers.fingerprints(spark.read.parquet(f"{SMALL}/documents.parquet")).collect(), docs)


def test_op9_edges(edge_docs, no_docs, monkeypatch):
    once = edge_docs.dropDuplicates(["doc_id", "text"])
    docs = sorted({(row[0], row[1]) for row in EDGES}, key=lambda row: -1 if row[0] is None else row[0], reverse=True)
    for size in (8 << 20, 200):
        monkeypatch.setattr(syncmers, "BUCKET_BYTES", size)
        check_fingerprints(syncmers.fingerprints(once).collect(), docs)
        assert syncmers.fingerprints(edge_docs).count() == len(EDGES)
        assert syncmers.fingerprints(edge_docs.filter("doc_id = 2")).first().near_next == 1.0
    assert syncmers.fingerprints(no_docs).collect() == []
    table = syncmers.anchor_table(edge_docs).filter("doc_id = 1").collect()
    assert len(table) == 2 * len(syncmers.anchors(EDGES[0][1])[0])


def test_hot_ids_and_repeated_rows_spread_over_buckets(spark, monkeypatch):
    """A third without an id, a third of one id, a sixth of one row: results by brute force, buckets of like size."""
    monkeypatch.setattr(syncmers, "BUCKET_BYTES", 4_000)
    rows = [(None, f"text {k} without an id") for k in range(800)] + [(7, f"text {k} of one id") for k in range(800)]
    rows += [(9, "one row many times")] * 400 + [(k, f"text {k} " * (k % 5)) for k in range(10, 410)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = [r["count"] for r in syncmers._with_next(docs).groupBy("bucket").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 3 * np.median(sizes)

    digest = {text: hashlib.md5(text.encode()).hexdigest() for _, text in rows}
    rows.sort(key=lambda row: (-(syncmers.LAST if row[0] is None else row[0]), digest[row[1]]))
    want = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        near = syncmers.likeness(syncmers.fingerprint(text), syncmers.fingerprint(following))
        want.append((doc_id or -1, hashlib.sha256(changed.encode()).hexdigest(), near))
    got = [(r.doc_id or -1, r.edited_sha256, r.near_next) for r in syncmers.fingerprints(docs).collect()]
    assert sorted(got) == sorted(want)


def test_longest_passage_by_brute_force():
    rng = np.random.default_rng(8)

    def noise(n):
        return "".join(rng.choice(list("abcdefghijklmnop "), n))

    for _ in range(40):
        shared, shorter = noise(int(rng.integers(60, 300))), noise(45)
        a = noise(int(rng.integers(0, 200))) + shared + noise(50) + shorter
        b = shorter + noise(int(rng.integers(0, 200))) + shared + noise(30)
        start, next_start, length = syncmers.passage(syncmers.anchors(a), syncmers.anchors(b))
        assert a[start : start + length] == b[next_start : next_start + length]
        # At either end less than the widest gap between anchors is not seen.
        assert a.index(shared) <= start and len(shared) - 2 * (syncmers.K - syncmers.S + 1) <= length <= len(shared) + 2
    assert syncmers.passage(syncmers.anchors(noise(300)), syncmers.anchors(noise(300))) == (0, 0, 0)
    assert syncmers.passage(syncmers.anchors("a" * 500), syncmers.anchors("a" * 300))[2] == 300
    assert syncmers.passage(syncmers.anchors(""), syncmers.anchors("short"))[2] == 0
    start, next_start, length = syncmers.passage(syncmers.anchors(LONG), syncmers.anchors(LONG))
    assert start == next_start and length > len(LONG) - 2 * syncmers.K


def test_op9_gives_the_passage_of_the_next_document(spark):
    passage = "a passage that two documents share, long enough to hold a good many anchors, " * 2
    docs = [(3, "first of them: " + passage + "ends"), (2, passage + "and more"), (1, "short"), (0, "other")]
    rows = {r.doc_id: r for r in syncmers.fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[3].passage_start - rows[3].next_start == 15 and rows[3].passage_length > 100
    assert (rows[1].passage_start, rows[1].next_start, rows[1].passage_length) == (None, None, 0)
