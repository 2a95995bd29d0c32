"""Rows and texts that operators must not stumble over, and fixtures of them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame

LONG = "word and more text, " * 9_000

# A null and a repeated id, null, empty and very long texts, equal texts and rows, other columns with clashing names.
EDGES = [
    (1, "the same text stands here twice", "en", "a", 9, "x"),
    (1, "the same text stands here twice", "en", "a", 9, "x"),
    (2, "the same text stands here twice", None, None, None, None),
    (None, "a text without an id", "en", "a", 1, "y"),
    (3, None, "de", "b", None, "z"),
    (4, "", "de", "b", 0, "z"),
    (6, LONG, "en", "b", len(LONG), "z"),
    (5, " \n\t  日本語 é <|endoftext|> <s> ▁ \x01 \x1c", "ja", "c", 3, ""),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, {extra} string"


@pytest.fixture(params=["n_tokens", "node", "score", "part"])
def edges(request, spark) -> DataFrame:
    return spark.createDataFrame(EDGES, COLUMNS.format(extra=request.param))


@pytest.fixture
def edge_docs(spark) -> DataFrame:
    return spark.createDataFrame(EDGES, COLUMNS.format(extra="shard"))


@pytest.fixture
def no_docs(edge_docs) -> DataFrame:
    return edge_docs.limit(0)


def strange_texts(n: int = 1500) -> list[str]:
    """Texts of few symbols, so that merges, spaces and odd characters meet often."""
    random.seed(5)
    fixed = [text or "" for _, text, *_ in EDGES if text != LONG]
    fixed += [" " * i + "x" + " " * j for i in range(20) for j in (0, 1, 5, 17)]
    fixed += ["", "\n\n  x", "a" * 300, "don't I'll we'VE ''S", "ÀÉß ſ ẞ ΣΑΣ İI", "　x  y\x85z᠎a", "é è"]
    kinds = ["abAB ▁\n\t'sтé日😀  .,!1230 \xa0\x01", "thein oASÉs'r.12"]
    return fixed + ["".join(random.choice(kinds[k % 2]) for _ in range(random.randint(1, 60))) for k in range(n)]
