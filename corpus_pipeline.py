"""Corpus pipeline: toxicity, quality, near-duplicates, packing.

Every stage takes the documents that the one before has kept, and all but the last
return them with the columns of ``documents``. Models are fitted to the labels of
``sf_dir`` outside the held-out fold. Null, empty, very long and repeated texts are
treated as the operators say; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tollbook.llm import near_duplicates, packing, quality, rows, toxicity


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not scored toxic."""
    return toxicity.keep_clean(docs, toxicity.train(*_labelled(spark, sf_dir)))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not scored poor."""
    return quality.keep_good(docs, quality.train(*_labelled(spark, sf_dir)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, as they stand in the written sequences of 2048 ids."""
    return packing.pieces_in(packing.windows(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Models and signatures are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is saved in the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = rows.saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
