"""Nearest neighbours and near duplicates against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as driver
from conftest import SMALL
from llm_edges import EDGES, edge_docs, edges, no_docs  # noqa: F401
from tollbook.llm import bag_minhash, hnsw, near_duplicates


def nearest_by_hand(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    norms = np.linalg.norm(vectors, axis=1)
    out = {}
    for at in np.flatnonzero([i in asked for i in ids]):
        cosine = vectors @ vectors[at] / (norms * norms[at])
        order = [j for j in np.lexsort((ids, -cosine)) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), float(cosine[j])) for j in order]
    return out


def test_op1_recall_and_scores(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    want = nearest_by_hand([(r.vec_id, r.embedding) for r in vectors], {r.vec_id for r in vectors if r.vec_id % 50 == 0}, 5)
    got = {}
    for r in driver.queries()["op1_hnsw"](spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.95
    exact = {q: dict(nearest_by_hand([(r.vec_id, r.embedding) for r in vectors], {q}, 10**6)[q]) for q in list(want)[:3]}
    for q, found in exact.items():
        assert all(abs(found[i] - score) < 1e-12 for i, score in got[q])


def test_op1_over_many_shards_keeps_its_recall(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(900, 16)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    graphs = hnsw.index(table, 5, shard_rows=100)
    assert graphs.count() == 9
    asked = {i for i in range(900) if i % 20 == 0}
    found = {}
    for r in hnsw.search(graphs, table.filter("vec_id % 20 = 0"), 5).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = nearest_by_hand(rows, asked, 5)
    assert np.mean([len(found[q] & {i for i, _ in want[q]}) / 5 for q in asked]) >= 0.95


FULL = 8192


def hot_table(kind):
    """A full shard of which a third are near copies or multiples of one vector."""
    rng = np.random.default_rng(11)
    vectors, base = rng.normal(size=(FULL, 64)), rng.normal(size=64)
    hot = FULL // 3
    if kind == "multiples":
        vectors[:hot] = base * rng.integers(1, 1000, size=(hot, 1))
    elif kind != "random":
        vectors[:hot] = base + float(kind) * np.linalg.norm(base) / 8 * rng.normal(size=(hot, 64))
    asked = np.concatenate([rng.choice(hot, 100, replace=False), hot + rng.choice(FULL - hot, 100, replace=False)])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = {}
    for at in asked:
        cosine = np.round(unit @ unit[at], 13 if kind == "multiples" else 16)
        cosine[at] = -2
        want[int(at)] = np.lexsort((np.arange(FULL), -cosine))[:5].tolist()
    return vectors, hot, want


def check_recall(found, want, hot):
    for copies in (True, False):
        hits = [len(set(found[at]) & set(ids)) / 5 for at, ids in want.items() if (at < hot) == copies]
        assert np.mean(hits) >= 0.95


@pytest.mark.parametrize("kind", ["random", "1e-3", "1e-4"])
def test_recall_of_a_full_shard(kind):
    vectors, hot, want = hot_table(kind)
    graph, order = hnsw.build(hnsw._unit(vectors))
    assert hnsw._reached(graph.layers[0]).all()
    asked = np.array(list(want))
    query, ids, _ = hnsw.Shard(graph, vectors[order], np.arange(FULL + 1), order).nearest(asked, vectors[asked], 5, hnsw.SEARCH_WIDTH)
    check_recall({at: ids[query == at].tolist() for at in want}, want, hot)


def test_recall_among_multiples_of_one_vector(spark):
    """One direction is one point; its ids come back in order."""
    vectors, hot, want = hot_table("multiples")
    table = spark.createDataFrame([(i, row) for i, row in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    graphs = hnsw.index(table, 5)
    assert graphs.count() == 1
    queries = table.filter(table.vec_id.isin(list(want)))
    found = {}
    for r in hnsw.search(graphs, queries, 5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    check_recall(found, want, hot)
    assert np.mean([found[at] == want[at] for at in want if at < hot]) >= 0.95


def test_graphs_are_moved_once_whatever_the_queries(spark):
    """The rows shuffled to the search are the graphs and, for each shard, the queries."""
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(6).normal(size=(600, 8)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    graphs = hnsw.index(table, 5, shard_rows=200)
    plan = hnsw.search(graphs, table, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(shard") == 1 and "FlatMapCoGroups" not in plan and "Join" not in plan


def test_points_out_of_reach_are_linked():
    """Two far groups without a link between them, one without a free slot."""
    vectors = np.concatenate([np.random.default_rng(k).normal(size=(60, 4)) * 0.01 + centre for k, centre in enumerate(np.eye(4))])
    graph, _ = hnsw.build(hnsw._unit(vectors))
    cut = graph.layers[0].copy()
    cut[cut % 7 == 3] = -1
    cut[:60] = np.where(cut[:60] < 0, 1, cut[:60])
    broken = hnsw.Graph(graph.vectors, [cut])
    assert not hnsw._reached(cut).all()
    hnsw._reach(broken)
    assert hnsw._reached(broken.layers[0]).all()


def test_graph_is_the_same_each_time_and_lists_are_bounded():
    vectors = np.random.default_rng(2).normal(size=(700, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    (first, order), (second, again) = hnsw.build(vectors), hnsw.build(vectors)
    assert (order == again).all() and all((a == b).all() for a, b in zip(first.layers, second.layers, strict=True))
    assert first.layers[0].shape == (700, 2 * hnsw.LINKS)
    for row in first.layers[0]:
        kept = row[row >= 0]
        assert len(set(kept.tolist())) == len(kept)


def test_op1_edges(spark):
    """Copies, unusable vectors, repeated rows, another length, an empty table."""
    hot = [(100 + i, [1.0, 0.5]) for i in range(40)]
    odd = [(3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [1.0, 1.0, 1.0]), *odd, *hot]
    table = spark.createDataFrame([(*row, 1) for row in rows], "vec_id long, embedding array<float>, score int")
    found = {}
    for r in hnsw.search(hnsw.index(table, 5), table, 5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found[1] == [2, 100, 101, 102, 103]
    assert found[103] == [100, 101, 102, 104, 105]
    assert found[7] == [100, 101, 102, 103, 104]
    assert set(found) == {1, 2, 7, *(i for i, _ in hot)}
    none = table.limit(0)
    assert hnsw.search(hnsw.index(none, 5), table, 5).collect() == []
    assert hnsw.search(hnsw.index(table, 5), none, 5).collect() == []


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**63, 300).astype(np.uint64)
    for _ in range(3):
        a = rng.choice([1, 1, 2, 3, 7, 50], 300)
        b = np.where(rng.random(300) < 0.3, rng.choice([0, 1, 4, 90], 300), a)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        left, right = bag_minhash.signatures([(hashes, a), (hashes[b > 0], b[b > 0])], 4096)
        assert abs((left == right).mean() - want) < 4 * np.sqrt(want * (1 - want) / 4096)
        assert np.isclose(bag_minhash.overlap((np.sort(hashes), a[np.argsort(hashes)]), (np.sort(hashes), b[np.argsort(hashes)])), want)


def test_signature_of_a_bag_does_not_depend_on_its_company():
    bags = [bag_minhash.bag(text) for text in ("a b c d e f g", "one", "x y " * 400, "a b c d e f g h i j k l")]
    together = bag_minhash.signatures(bags)
    for k, bag in enumerate(bags):
        assert (bag_minhash.signatures([bag])[0] == together[k]).all()
    assert bag_minhash.signatures([]).shape == (0, bag_minhash.COMPONENTS)


def classes_by_hand(docs):
    bags = {k: bag_minhash.bag(text or "") for k, (_, text) in enumerate(docs)}
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(docs)), 2):
        same = (docs[a][1] or "") == (docs[b][1] or "")
        if same or (len(bags[a][0]) and len(bags[b][0]) and bag_minhash.overlap(bags[a], bags[b]) >= 0.8):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return Counter((doc_id, least.get(find(k))) for k, (doc_id, _) in enumerate(docs))


def as_counter(rows):
    return Counter((r.doc_id, r.class_id) for r in rows)


def test_op4_classes(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert as_counter(driver.queries()["op4_near_duplicates"](spark, SMALL).collect()) == classes_by_hand(docs)


def test_op4_edges(edges, no_docs):
    docs = [(row[0], row[1]) for row in EDGES]
    assert as_counter(near_duplicates.near_duplicate_classes(edges).collect()) == classes_by_hand(docs)
    kept = near_duplicates.keep_one(edges)
    assert kept.columns == edges.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, None, 3, 5, 6])
    assert near_duplicates.near_duplicate_classes(no_docs).collect() == []
    assert near_duplicates.keep_one(no_docs).collect() == []


def test_one_document_of_a_class_without_ids_or_with_one_id_stays(spark):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(None, text), (None, f"{text} x"), (None, f"{text} y")]
    rows += [(7, text.replace("w", "v")), (7, text.replace("w", "v") + " x"), (8, text.replace("w", "v") + " y")]
    kept = near_duplicates.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in kept) == Counter([None, 7])


@pytest.mark.parametrize("block", [1024, 9])
def test_large_group_of_near_copies_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    monkeypatch.setattr(near_duplicates, "PAIRS", block)
    random.seed(3)
    base = [f"w{random.randrange(5000)}" for _ in range(120)]

    def edited(share):
        return " ".join(f"e{random.randrange(10**6)}" if random.random() < share else word for word in base)

    texts = [edited(random.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(110)] + ["x y z"] * 4
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_duplicates.near_duplicate_classes(table).collect()
    want = classes_by_hand(list(enumerate(texts)))
    assert as_counter(rows) == want and 1 < len({c for _, c in want}) < 110


def test_pairs_of_a_hot_pivot_are_dealt_to_copies_of_its_text(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "PAIRS", 10)
    pairs = spark.createDataFrame([(k, 0) for k in range(1, 301)] + [(400, 399)], "a long, b long")
    dealt, copies = near_duplicates._with_copies(pairs)
    sizes = {(r.b, r.copy): r["count"] for r in dealt.groupBy("b", "copy").count().collect()}
    assert sum(sizes.values()) == 301 and max(sizes.values()) < 30 and sizes[(399, 0)] == 1
    assert {(r.b, r.copy) for r in copies.collect()} == {(0, k) for k in range(30)} | {(399, 0)}


def test_rows_that_repeat_go_before_the_texts_are_shuffled(spark, edge_docs):
    """One shuffle of the texts, with map-side combine, that the join shares; no broadcast at any size."""
    plan = near_duplicates.keep_one(edge_docs)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "ShuffledHashJoin" not in plan
    plan = near_duplicates.keep_one(edge_docs)._jdf.queryExecution().executedPlan().toString()
    texts = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(texts) == 2, plan  # the texts, and the keys of those that stay
