"""Token counts, encoders, sequence files, packing: against the libraries."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
from conftest import SMALL
from llm_edges import EDGES, edge_docs, edges, no_docs, strange_texts  # noqa: F401
from tollbook.llm import byte_bpe, encoders, packing, sequence_files, token_counts
from tollbook.workspace import new_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def by_ranks() -> tiktoken.Encoding:
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces() -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_byte_bpe_equals_the_library_and_decodes_back(by_ranks):
    coder = byte_bpe.load(RANKS, public_tokenizers.PATTERN)
    for text in strange_texts():
        ids = coder.encode(text).tolist()
        assert ids == by_ranks.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


def test_pair_test_agrees_with_merging():
    table = byte_bpe.load(RANKS, public_tokenizers.PATTERN).table
    tokens = [t for t in ["t", "th", "the", " the", "in", "ing", "er", "re", "ere", "he", "ther", " a", "an", "nd", "and"]]
    for a in tokens:
        for b in tokens:
            whole = table.merge(a) == [a] and table.merge(b) == [b]
            assert not whole or table.compatible(a, b) == (table.merge(a + b) == [a, b])


def test_every_prefix_has_its_exact_count(pieces):
    counter = token_counts.load(PIECES)
    for text in strange_texts(400):
        want = [len(pieces.encode(text[:i])) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want, text


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_json_encoder_equals_the_library(path):
    library, coder = Tokenizer.from_file(path), encoders.load(path)
    assert coder.whole or coder.by_word
    texts = strange_texts()
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, encoded in zip(texts, want, strict=True):
        assert coder.encode(text).tolist() == encoded.ids, text


def test_op2_counts_and_stored_tables(spark, pieces):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = driver.queries()["op2_token_counts"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        n = len(pieces.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
    stored = token_counts.prefix_tables(documents(spark).limit(30), PIECES, 4096)
    for r in token_counts.truncated(stored, 50).collect():
        text = texts[r.doc_id]
        fits = [i for i in range(max(0, r.kept_chars - 5), min(len(text), r.kept_chars + 40) + 1) if len(pieces.encode(text[:i])) <= 50]
        assert max(fits) == r.kept_chars


def test_op2_stores_its_tables(spark):
    rows = driver.queries()["op2_token_counts"](spark, SMALL)
    kept = {r.doc_id: r.kept_chars for r in token_counts.truncated(rows, 4096).collect()}
    for r in rows.collect():
        assert token_counts.counts_of(r.steps)[-1] == r.n_tokens and kept[r.doc_id] == r.kept_chars


def test_op2_edges(spark, edges, no_docs, pieces):
    rows = token_counts.prefix_tables(edges, PIECES, 4096).collect()
    want = sorted((str(i), len((t or "").encode()), len(pieces.encode(t or ""))) for i, t, *_ in EDGES)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts.prefix_tables(no_docs, PIECES, 4096).collect() == []


def test_op7_digests(spark, by_ranks):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    for r in driver.queries()["op7_byte_bpe"](spark, SMALL).collect():
        ids = by_ranks.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op7_edges_encode_and_decode(edge_docs, no_docs):
    encoded = byte_bpe.encode_documents(edge_docs, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in decoded) == sorted((t or "").encode() for _, t, *_ in EDGES)
    assert byte_bpe.round_trip(edge_docs, RANKS, public_tokenizers.PATTERN).count() == len(EDGES)
    assert byte_bpe.round_trip(no_docs, RANKS, public_tokenizers.PATTERN).collect() == []


def read_back(spark, docs, **options):
    folder = new_path(spark, "test-sequences")
    files = sequence_files.write_sequences(docs, WORDS, 2, folder, **options)
    return files, sequence_files.read_documents(spark, files).collect()


def check_sequence_rows(rows, docs):
    """Rows equal the library's ids of documents in ascending id order."""
    library, start = Tokenizer.from_file(WORDS), 0
    for r, (doc_id, text) in zip(rows, docs, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_op3_rows_come_back_from_the_files(spark):
    rows = driver.queries()["op3_sequence_files"](spark, SMALL).orderBy("doc_id").collect()
    check_sequence_rows(rows, [(r.doc_id, r.text) for r in documents(spark).orderBy("doc_id").collect()])


def test_op3_edges_and_random_access(spark, edge_docs, no_docs):
    files, rows = read_back(spark, edge_docs, length=64, bytes_per_file=40)
    order = sorted(EDGES, key=lambda row: (-1 if row[0] is None else row[0]))
    rows = sorted(rows, key=lambda r: r.start)
    assert len(files.collect()) > 1
    check_sequence_rows(rows, [(row[0], row[1]) for row in order])
    by_file = {row.part: sequence_files.SequenceFile(row.file) for row in files.collect()}
    total = 0
    for opened in by_file.values():
        n = sum(opened.data.get_batch(k).num_rows for k in range(opened.data.num_record_batches))
        for k in range(n):
            ids, mask = opened.sequence(k)
            assert len(ids) == len(mask) == 64
            assert not ids.flags.owndata
            total += sum(mask.to_pylist())
    assert total == sum(r.n_tokens for r in rows)
    assert read_back(spark, no_docs)[1] == []


def check_pieces(rows, docs, length=2048):
    library, by_doc, by_sequence = Tokenizer.from_file(BYTES), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in docs:
        ids, at = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for sequence, parts in by_sequence.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == length or sequence == max(by_sequence)


def test_op5_pieces_and_sequences(spark):
    docs = documents(spark)
    rows = driver.queries()["op5_packing"](spark, SMALL).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()])
    whole = packing.sequences(docs.repartition(5), BYTES, 1, length=300).collect()
    assert sorted(r.sequence_id for r in whole) == list(range(len(whole)))
    assert {len(r.ids) for r in whole} == {300}
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in rows)


def test_op5_carries_the_ids_of_its_sequences(spark, edge_docs):
    for r in driver.queries()["op5_packing"](spark, SMALL).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
    # Splits' edges fall within windows; what is read from the windows is what is cut from the documents.
    for docs in (documents(spark).repartition(5).cache(), edge_docs.repartition(3, "doc_id").cache()):
        windows = packing.windows(docs, BYTES, 1, length=300)
        assert sorted(packing.pieces_in(windows).collect(), key=str) == sorted(packing.pieces(docs, BYTES, 1, 300).collect(), key=str)
        for r in packing.sequences(docs, BYTES, 1, length=300).collect():
            assert sum(p.length for p in r.pieces) == r.n_tokens and not any(r.ids[r.n_tokens :])


def test_op5_edges(edge_docs, no_docs):
    once = edge_docs.dropDuplicates(["doc_id", "text"])
    rows = packing.pieces(once, BYTES, 1, length=128).collect()
    check_pieces(rows, [(row[0], row[1]) for row in set(EDGES)], 128)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    twice = packing.pieces(edge_docs, BYTES, 1, keep_ids=False).agg(F.sum("length").alias("n")).first()
    assert twice.n > sum(r.length for r in rows)
    assert packing.pieces(no_docs, BYTES, 1).collect() == [] == packing.sequences(no_docs, BYTES, 1).collect()


def test_windows_of_empty_texts_are_taken_apart_without_a_python_batch(spark):
    """Two thousand empty texts are one window, so a batch of windows would hold millions of pieces."""
    docs = spark.range(0, 5000, 1, 3).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").alias("text"))
    rows = packing.pieces_in(packing.windows(docs, BYTES, 1))
    assert "MapInArrow" not in rows._jdf.queryExecution().executedPlan().toString()
    check_pieces(rows.collect(), [(i, "") for i in range(5000)])
