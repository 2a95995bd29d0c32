"""The divergence audit against plain Python and against SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from compare import canonical, duck
from conftest import SMALL
from llm_edges import EDGES, edges, edge_docs, no_docs, strange_texts  # noqa: F401
from tollbook.llm import divergence
from tollbook.llm.divergence import audit, terms_of

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL_LETTERS = {b: b + 32 for b in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, rank string"


def terms_by_hand(text):
    return TERM.findall((text or "").translate(SMALL_LETTERS))


def by_hand(docs, least=30, ranks=50):
    """Rows of the audit from (text, lang, source), with Python's integers."""
    counts, frequency, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = terms_by_hand(text)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        frequency[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in frequency[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // total for t in kept}

        of = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(of[s][t] - whole[t], t) for t in kept if counts[lang, s][t] > 0 and of[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", over, ranks)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)}
    return out


def rows_of(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def many(seed=4, langs=("en", "de"), sources=9, docs=700):
    """Documents whose sources prefer words of their own; one source holds a third of all."""
    source = random.Random(seed)
    words = [f"w{''.join(chr(97 + int(d)) for d in str(i))}" for i in range(120)] + ["ÄÖ", "äö", "ß日本", "Mixed", "mixed"]
    rows = []
    for i in range(docs):
        at = 0 if i % 3 == 0 else source.randrange(sources)
        text = " ".join(source.choice(words[at :: 3] if source.random() < 0.5 else words) for _ in range(source.randrange(40)))
        rows.append((i, text, langs[i % len(langs)], f"s{at}", "x"))
    return rows


def test_terms_equal_the_pattern():
    for text in [*strange_texts(), "Éa-Bc_d[e]f`g{h}\x7fi@j", "a\u0085b c", "𝔘x"]:
        assert [t.decode() for t in terms_of(text)] == terms_by_hand(text), text


def test_op13_equals_brute_force_and_its_statement(spark):
    docs = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = driver.queries()["op13_source_divergence"](spark, SMALL)
    assert rows_of(frame) == by_hand(docs)
    want = duck(SMALL).execute(driver.oracle_sql()["op13_source_divergence"]).df()
    assert len(want) and canonical(frame.toPandas()) == canonical(want)


@pytest.mark.parametrize("blocks", [(32, 2048), (2, 7), (1, 1)])
def test_cells_of_any_size_add_up_to_the_same(spark, blocks):
    rows = many()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = audit(frame, 30, 50, *blocks)
    assert rows_of(found) == by_hand([row[1:4] for row in rows])


def test_edges(spark, edges):
    rows = [tuple(r) for r in edges.select("text", "lang", "source").collect()]
    assert rows_of(audit(edges, least_documents=1)) == by_hand(rows, least=1)
    assert rows_of(audit(edges)) == by_hand(rows)


def test_groups_without_terms_and_languages_without_kept_terms(spark):
    rows = [(i, "only words", "en", "a", "x") for i in range(40)] + [(50, None, "en", "b", "x"), (51, "", "en", None, "x")]
    rows += [(60, "rare", "de", "a", "x"), (61, "seldom", "de", "b", "x"), (62, "!", None, None, "x"), (63, "x", "fr", "a", "x")]
    found = rows_of(audit(spark.createDataFrame(rows, SCHEMA)))
    assert found == by_hand([row[1:4] for row in rows])
    assert ("de", "a", "pair", "b", 0, 1) in found and not any(row[0] in ("fr", "") for row in found)


def test_ties_are_ranked_by_bytes(spark):
    """Equal values: the item decides, by its bytes and not by a locale."""
    names = ["b", "B", "é", "z", "a", "𝔘", ""]
    rows = [(i, "same same text", "en", name, "x") for i in range(40) for name in names]
    found = rows_of(audit(spark.createDataFrame(rows, SCHEMA)))
    assert found == by_hand([row[1:4] for row in rows])
    mine = sorted((rank, item) for _, source, part, item, _, rank in found if source == "a" and part == "pair")
    assert [item for _, item in mine] == sorted(set(names) - {"a"}, key=str.encode)


def test_terms_are_cut_at_the_rank(spark):
    rows = [(i, " ".join(f"{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60)), "en", "a", "x") for i in range(30)]
    rows += [(100 + i, "other", "en", "b", "x") for i in range(30)]
    found = rows_of(audit(spark.createDataFrame(rows, SCHEMA)))
    assert found == by_hand([row[1:4] for row in rows])
    assert sum(part == "term" and s == "a" for _, s, part, *_ in found) == 50


def test_no_documents(spark, no_docs):
    assert audit(no_docs).collect() == []


def test_counts_are_given_before_too_many_are_held(spark, monkeypatch):
    rows = many(docs=200)
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    want = rows_of(divergence.term_counts(frame))
    monkeypatch.setattr(divergence, "MOST_HELD", 10)
    assert rows_of(divergence.term_counts(frame)) == want


def test_shares_are_exact_for_large_counts(spark):
    cases = [(10**17 + 3, 10**18 - 7, 10**6), (0, 10**18, 1), (0, 0, 0), (5, 0, 7), (999_999_999_937, 10**13, 12_345_678)]
    frame = spark.createDataFrame(cases, "n long, total long, terms long")
    got = [r[0] for r in frame.select(divergence._share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 1_000_000_000 * (n + 5) // (total + 5 * terms) if terms else 0 for n, total, terms in cases]
