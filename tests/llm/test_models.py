"""Toxicity and quality: exact inference, held-out accuracy, edges."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import SMALL
from llm_edges import EDGES, LONG, edge_docs, no_docs  # noqa: F401
from tollbook.llm import labelled, quality, toxicity

LARGE = "/root/testdata/sf0.1"


def by_hand(emission, first, transition, start):
    n, total = len(emission), 0.0
    p, expected = np.zeros(n), np.zeros((2, 2))
    for states in itertools.product((0, 1), repeat=n):
        score = 0.0
        for k, y in enumerate(states):
            score += emission[k] * y + (start[y] if first[k] else transition[states[k - 1], y])
        weight = np.exp(score)
        total += weight
        for k, y in enumerate(states):
            p[k] += weight * y
            if not first[k]:
                expected[states[k - 1], y] += weight
    return p / total, expected / total, np.log(total)


@pytest.mark.parametrize("n", [1, 5, 7, 8, 11])
def test_forward_backward_equals_all_paths(monkeypatch, n):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    rng = np.random.default_rng(n)
    emission, first = rng.normal(size=n) * 3, np.zeros(n, bool)
    first[[0, *([3, 4] if n > 4 else [])]] = True
    transition, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    got = toxicity.marginals(emission, first, transition, start)
    for a, b in zip(got, by_hand(emission, first, transition, start), strict=True):
        assert np.allclose(a, b)


def test_copies_do_not_make_words_telling():
    one = "some words that stand only here and next an idiot".split()
    words = [one] * 50 + [f"{a} idiot {b}".split() for a, b in zip("abcdefgh", "hgfedcba", strict=True)] + [["fine"]] * 50
    toxic = np.array([1.0] * 58 + [0.0] * 50)
    index: dict[str, int] = {}
    documents = [np.array([index.setdefault(word, len(index)) for word in tokens]) for tokens in words]
    assert toxicity.telling_features(documents, list(index), toxic) == {"idiot", "idio-", "idiot-"}


def held_out_truth(spark, sf_dir, label):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    return {r.doc_id: r[label] for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}


def test_op8_contract(spark):
    rows = driver.queries()["op8_toxicity"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_op8_finds_held_out_toxic_documents(spark):
    truth = held_out_truth(spark, LARGE, "toxic")
    scored = {r.doc_id: r.predicted for r in driver.queries()["op8_toxicity"](spark, LARGE).collect()}
    hits = sum(scored[i] for i, t in truth.items() if t)
    wrong = sum(scored[i] for i, t in truth.items() if not t)
    assert hits >= 0.85 * sum(truth.values()) and wrong <= 0.02 * (len(truth) - sum(truth.values()))


def test_spans_and_edges(spark, edge_docs, no_docs):
    texts = [f"{a} you utter idiot {b} {a}" for a, b in itertools.product("abcdefgh", repeat=2)] + ["a good day", "fine words"] * 40
    labels = np.array([1.0] * 64 + [0.0] * 80)
    model = toxicity.fit(texts, labels)
    found = model.spans("Well, IDIOT: that is it")
    assert found == [(6, 11)]
    assert model.spans("") == []
    docs = spark.createDataFrame([(1, "what an idiot", 7), (2, "a good day", 8), (3, None, 9), (4, "", 9)], "doc_id long, text string, score int")
    rows = {r.doc_id: r for r in toxicity.score_documents(docs, model, spans=True).collect()}
    assert rows[1].predicted == 1 and [tuple(s) for s in rows[1].spans] == [(8, 13)]
    assert rows[2].predicted == rows[3].predicted == rows[4].predicted == 0 and rows[3].score == rows[4].score
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert toxicity.score_documents(edge_docs, model).count() == len(EDGES)
    assert toxicity.keep_clean(edge_docs, model).count() == len(EDGES)
    assert toxicity.score_documents(no_docs, model).collect() == []
    assert len(model.scores([LONG, "", "idiot"])) == 3


def test_op8_gives_the_spans_of_toxic_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = driver.queries()["op8_toxicity"](spark, SMALL).collect()
    assert any(r.spans for r in rows)
    for r in rows:
        assert [tuple(s) for s in r.spans] == model.spans(texts[r.doc_id])


def test_spans_are_offsets_of_the_text_itself():
    model = toxicity.Field({"idiot": 40.0}, -20.0, np.zeros((2, 2)), np.zeros(2), 1.0, 0.0)
    text = "\u0130\u0130 you IDIOT, fine"
    assert [text[a:b] for a, b in model.spans(text)] == ["IDIOT"]


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, None)], [(1, 0), (2, 0), (1, 0), (None, 1), (99, 1)]])
def test_labels_of_one_class_or_none_give_a_constant(spark, edge_docs, rows):
    labels = spark.createDataFrame([(i, x, x) for i, x in rows], "doc_id long, toxic int, quality int")
    for module in (toxicity, quality):
        scores = {r.score for r in module.score_documents(edge_docs, module.train(edge_docs, labels)).collect()}
        assert len({round(s, 9) for s in scores}) == 1 and 0 <= scores.pop() <= 1


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    named = docs.withColumn("label", F.lit("clash"))
    assert labelled.training_rows(named, labels, "toxic", 10).count() == 10
    known = {r.doc_id for r in labels.filter(~labelled.held_out(F.col("doc_id"))).collect()}
    assert labelled.training_rows(named, labels, "toxic", 10_000).count() == len(known)


def test_sample_has_one_row_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(2, "b"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0)], "doc_id long, toxic int")
    known = {r.doc_id for r in labels.filter(~labelled.held_out(F.col("doc_id"))).collect()}
    assert 1 in known
    for parts in (1, 7):
        rows = labelled.training_rows(docs.repartition(parts), labels, "toxic", 10).collect()
        assert len(rows) == len(known)
        least = min((f"text {k}" for k in range(50)), key=lambda t: hashlib.md5(t.encode()).hexdigest())
        assert [r.text for r in rows if r.label] == [least]


def test_trees_find_a_rule_and_walk_as_arrays():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    forest = quality.fit(x, y, trees=40, depth=3)
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.97
    row = x[7]
    total = forest.base
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
        node = 0
        for _ in range(3):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        total += leaf[node - 7]
    assert np.isclose(forest.scores(x[7:8])[0], 1 / (1 + np.exp(-total)))


def test_op10_contract_and_held_out_accuracy(spark):
    truth = held_out_truth(spark, LARGE, "quality")
    rows = {r.doc_id: r for r in driver.queries()["op10_quality"](spark, LARGE).collect()}
    assert sorted(rows) == list(range(10_000))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert np.mean([rows[i].predicted == t for i, t in truth.items()]) > 0.97
    assert np.mean([rows[i].predicted for i, t in truth.items() if t]) > 0.99


def test_op10_edges(spark, edge_docs, no_docs):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    forest = quality.train(docs, labels)
    rows = quality.score_documents(edge_docs, forest).collect()
    assert len(rows) == len(EDGES) and len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    kept = quality.keep_good(edge_docs, forest)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r.predicted for r in rows)
    assert quality.score_documents(no_docs, forest).collect() == []
