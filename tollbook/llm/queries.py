"""The registered queries of this subpackage; each derives its digest columns from its operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_path
from . import (
    byte_bpe,
    divergence,
    hilbert,
    hnsw,
    near_duplicates,
    packing,
    pattern_packing,
    pca_clusters,
    quality,
    sequence_files,
    syncmers,
    token_counts,
    toxicity,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest other vectors of every fiftieth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    graphs = hnsw.index(vectors, k=5)
    return hnsw.search(graphs, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, with its prefix table."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.prefix_tables(_documents(spark, sf_dir), model, budget=4096)


def op3_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it comes back from the sequence files."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = new_path(spark, "sequences")
    files = sequence_files.write_sequences(_documents(spark, sf_dir), tokenizer, end_id=2, folder=folder)
    return sequence_files.read_documents(spark, files)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates."""
    return near_duplicates.near_duplicate_classes(_documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, as they stand in the written sequences of 2048."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pieces_in(packing.windows(_documents(spark, sf_dir), tokenizer, end_id=1))


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight."""
    shards = hilbert.hilbert_shards(_documents(spark, sf_dir), shards=8)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shards.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "curve")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity and offending spans under a field fitted to the labels."""
    documents = _documents(spark, sf_dir)
    return toxicity.score_documents(documents, toxicity.train(documents, _labels(spark, sf_dir)), spans=True)


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and the next document."""
    return syncmers.fingerprints(_documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality under trees fitted to the labels."""
    documents = _documents(spark, sf_dir)
    return quality.score_documents(documents, quality.train(documents, _labels(spark, sf_dir)))


def op11_pca_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster of sixteen after three rounds."""
    return pca_clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, as they stand in as few sequences of 1024 as patterns give."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pattern_packing.pieces_in(pattern_packing.sequences(_documents(spark, sf_dir), tokenizer, end_id=2))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and by which terms."""
    return divergence.audit(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query of this subpackage, by name."""
    return {
        "op1_hnsw": op1_hnsw,
        "op2_token_counts": op2_token_counts,
        "op3_sequence_files": op3_sequence_files,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_packing": op5_packing,
        "op6_hilbert_shards": op6_hilbert_shards,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_toxicity": op8_toxicity,
        "op9_syncmers": op9_syncmers,
        "op10_quality": op10_quality,
        "op11_pca_clusters": op11_pca_clusters,
        "op12_pattern_packing": op12_pattern_packing,
        "op13_source_divergence": op13_source_divergence,
    }


def _clusters_sql(rounds: int = 3, clusters: int = 16) -> str:
    """One pair of steps per round: every vector's nearest centroid, then the floors of the means.

    A vector's nearest centroid is the least ``distance * clusters + number``.
    """
    distance = "list_sum(list_transform(list_zip(p.v, c.v), lambda e: (e[1] - e[2]) * (e[1] - e[2])))"
    steps = [
        f"""points AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM points
  ORDER BY sha256('1:' || vec_id), v LIMIT {clusters})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""nearest{i} AS MATERIALIZED (
  SELECT vec_id, v, best % {clusters} AS c, best // {clusters} AS distance
  FROM (SELECT p.vec_id, any_value(p.v) AS v, min(CAST({distance} AS BIGINT) * {clusters} + c.c) AS best
        FROM (SELECT row_number() OVER () AS at, * FROM points) p CROSS JOIN centroids{i} c GROUP BY p.at, p.vec_id))"""
        )
        if i < rounds:
            steps.append(
                f"""sums{i} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM nearest{i}) GROUP BY c, i),
centroids{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM centroids{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums{i} GROUP BY c) m USING (c))"""
            )
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM nearest{rounds} JOIN centroids{rounds} k USING (c)"""


_DIVERGENCE_SQL = r"""WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs
  FROM (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
  GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY ALL HAVING sum(docs) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT counts.* FROM counts SEMI JOIN kept USING (lang, term)) c USING (lang, source)
  GROUP BY g.lang, g.source),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.total + 5 * l.v) AS p,
         1 + 1000000000::HUGEINT * (k.lang_n + 5) // (l.lang_total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50"""


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of the queries that SQL can express."""
    return {"op11_pca_clusters": _clusters_sql(), "op13_source_divergence": _DIVERGENCE_SQL}
