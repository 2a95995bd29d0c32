"""The pipeline, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

import zlib

import corpus_pipeline
import __spark_entry__ as driver
from conftest import SMALL
from llm_edges import EDGES, edge_docs, no_docs  # noqa: F401
from test_neighbours import classes_by_hand
from test_tokens import check_pieces
from tollbook.llm import quality, toxicity


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]
    assert driver.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def test_stages_and_run(spark, tmp_path):
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r.doc_id: r.text for r in source.collect()}
    models = {"toxicity": toxicity.train(source, labels), "quality": quality.train(source, labels)}
    docs, kept = source, list(texts)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "toxicity":
            scores = models[name].scores([texts[i] for i in kept])
            kept = [i for i, score in zip(kept, scores, strict=True) if score < 0.5]
        elif name == "quality":
            scores = models[name].scores(quality._matrix([texts[i] for i in kept]))
            kept = [i for i, score in zip(kept, scores, strict=True) if score >= 0.3]
        elif name == "near_duplicates":
            kept = sorted({c for _, c in classes_by_hand([(i, texts[i]) for i in kept])})
        else:
            break
        assert docs.schema == source.schema
        assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
    check_pieces(docs.collect(), [(i, texts[i]) for i in kept])
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id, r.start, r.length, r.ids_crc32) for r in docs.collect()
    )


def test_stages_take_edges_and_no_rows(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, edge_docs, SMALL)
        if name != "packing":
            assert rows.columns == edge_docs.columns
        assert 0 < rows.count() <= 100 * len(EDGES)
        assert stage(spark, no_docs, SMALL).collect() == []


def test_packing_stage_carries_the_ids_of_its_sequences(spark, edge_docs):
    rows = corpus_pipeline.pack(spark, edge_docs, SMALL).collect()
    assert sum(r.length for r in rows) > 2048
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
