"""Bounded labelled samples, and the split that holds rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels may not be learned from; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``text, label`` of at most ``most`` labelled documents outside the held-out fold.

    The sample is the first by a hash of the id. Labels that are null, or whose
    document is missing, are left out; a document with two labels counts as 1 if any is.
    Of rows that repeat an id, the text with the smallest digest is taken.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    drawn = (
        known.groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # The drawn rows are at most `most` pairs of numbers, so they can be broadcast.
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    least = F.min_by("text", F.md5("text")).alias("text")
    return rows.groupBy("doc_id").agg(least, F.first("label").alias("label")).select("text", "label")
