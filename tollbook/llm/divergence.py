"""Source divergence audit by three-dimensional cube partitioning.

Sources of a language differ by how often they use the language's terms. Comparing
all pairs of sources over all terms is a cube: source by source by term. It is cut
along all three axes: a task owns one cell, a block of sources against a block of
sources over a block of terms, and gets just the two slices it needs, a copy for each
cell of a slice. Cells give partial divergences; these are summed along the term axis.
A slice has at most some ``GROUP_BLOCK`` sources and ``TERM_BLOCK`` terms, whatever
the number of rows behind them.

Counts come first: a task counts the terms of its documents by language and source
and gives one row per term it has seen, so a hot source or word is one row per task.
All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import column_of, saved, slices, texts_of

LEAST_DOCUMENTS = 30
GROUP_BLOCK = 32
TERM_BLOCK = 2048
RANKS = 50

# The scale of a share and what is added to each count.
SHARE_SCALE = 1_000_000_000
ADDED = 5

#: Different terms a task holds before it gives their counts.
MOST_HELD = 200_000

#: Bytes of terms as they are, capital letters small, everything else a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RESULT = "lang string, source string, part string, item string, value long, rank int"


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII; only A to Z are made small."""
    return text.encode().translate(_LETTERS).split()


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term, saved in the shared folder.

    Null text, lang and source are ''. Every group has a row without a term, so it
    is known without one too.
    """
    named = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def given() -> pa.RecordBatch:
            out: dict[str, list] = {name: [] for name in ("lang", "source", "term", "n", "docs")}
            for (lang, source), (seen, docs) in held.items():
                terms = [None, *seen]
                out["lang"] += [lang] * len(terms)
                out["source"] += [source] * len(terms)
                out["term"] += [term and term.decode() for term in terms]
                out["n"] += [0, *seen.values()]
                out["docs"] += [0, *map(docs.__getitem__, seen)]
            held.clear()
            kinds = {"n": pa.int64(), "docs": pa.int64()}
            return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})

        for batch in batches:
            for rows in slices(batch):
                groups = zip(column_of(rows, "lang").to_pylist(), column_of(rows, "source").to_pylist(), strict=True)
                for group, text in zip(groups, texts_of(rows), strict=True):
                    terms = terms_of(text)
                    seen, docs = held.setdefault(group, (Counter(), Counter()))
                    seen.update(terms)
                    docs.update(set(terms))
                if sum(len(seen) for seen, _ in held.values()) > MOST_HELD:
                    yield given()
        if held:
            yield given()

    partial = documents.select(*named).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    summed = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return saved(summed, "term-counts")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SHARE_SCALE * (count + ADDED) / (total + ADDED * terms))``, exactly; 0 without terms."""
    scaled = F.lit(SHARE_SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    below = F.greatest(total + ADDED * terms, F.lit(1)).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", scaled, below)).otherwise(F.lit(0).cast("long"))


def _blocks(count: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / size)).cast("int")


def _block(value: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(value), blocks).cast("int")


def kept_counts(counts: DataFrame, least_documents: int, group_block: int, term_block: int) -> tuple[DataFrame, DataFrame]:
    """Groups, and their counts of kept terms, both saved in the shared folder.

    - groups: ``lang, source, total, terms, lang_total, term_cells, group_cell, group_cells``
    - counts: ``lang, source, term, n, lang_n, term_cell, slot``: the term's place is ``slot`` of block ``term_cell``

    What is joined by language has one row for each: Spark broadcasts it while it is small.
    """
    seen = counts.filter(F.col("term").isNotNull())
    terms = seen.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    terms = saved(terms.filter(F.col("docs") >= least_documents).drop("docs"), "kept-terms")
    langs = saved(terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")), "langs")
    placed = terms.join(langs, "lang").withColumn("term_cell", _block(F.col("term"), _blocks(F.col("terms"), term_block)))
    slot = (F.row_number().over(Window.partitionBy("lang", "term_cell").orderBy("term")) - 1).alias("slot")
    placed = placed.select("lang", "term", "lang_n", "term_cell", slot)
    kept = saved(seen.drop("docs").join(placed, ["lang", "term"]), "kept-counts")
    total = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = saved(counts.filter(F.col("term").isNull()).select("lang", "source").join(total, ["lang", "source"], "left"), "totals")
    sizes = saved(named.groupBy("lang").agg(F.count("*").alias("sources")).join(langs, "lang", "left"), "lang-sizes")
    group_cells = _blocks(F.col("sources"), group_block)
    groups = named.join(sizes, "lang").select(
        "lang",
        "source",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("total", "terms", "lang_total")],
        _blocks(F.coalesce("terms", F.lit(0)), term_block).alias("term_cells"),
        _block(F.col("source"), group_cells).alias("group_cell"),
        group_cells.alias("group_cells"),
    )
    return saved(groups, "groups"), kept


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of one cell: the pairs of its two blocks over those of its terms that any of them uses.

    ``used`` counts these terms; for all others both sources stand at their share of
    nothing, which is ``gap`` apart.
    """
    cell, sources = (table.column(name).to_pylist() for name in ("group_cell", "source"))
    order = sorted(range(table.num_rows), key=lambda i: (cell[i], sources[i]))
    table, cell, sources = table.take(order), [cell[i] for i in order], [sources[i] for i in order]
    base = table.column("base").to_numpy()
    slots, shares = (table.column(name).combine_chunks() for name in ("slots", "shares"))
    sizes = pc.fill_null(pc.list_value_length(slots), 0).to_numpy()
    columns, at = np.unique(pc.list_flatten(slots).to_numpy(), return_inverse=True)
    matrix = np.repeat(base[:, None], len(columns), axis=1)
    matrix[np.repeat(np.arange(len(sizes)), sizes), at] = pc.list_flatten(shares).to_numpy()
    first, second = (table.column(name)[0].as_py() for name in ("first", "second"))
    left = np.flatnonzero(np.array(cell) == first)
    right = np.flatnonzero(np.array(cell) == second)
    out: dict[str, list] = {name: [] for name in ("source", "other", "value", "gap")}
    for i in left:
        mates = right[right > i] if first == second else right
        out["source"] += [sources[i]] * len(mates)
        out["other"] += [sources[j] for j in mates]
        out["value"] += np.abs(matrix[mates] - matrix[i]).sum(1).tolist()
        out["gap"] += np.abs(base[mates] - base[i]).tolist()
    n = len(out["value"])
    return pa.table(
        {
            "lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
            "source": pa.array(out["source"], pa.string()),
            "other": pa.array(out["other"], pa.string()),
            "value": pa.array(out["value"], pa.int64()),
            "gap": pa.array(out["gap"], pa.int64()),
            "used": pa.array([len(columns)] * n, pa.int64()),
            "terms": pa.array([table.column("terms")[0].as_py()] * n, pa.int64()),
        }
    )


def pair_divergences(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, both ways."""
    header = ["lang", "source"]
    share = _share(F.col("n"), F.col("total"), F.col("terms"))
    contents = (
        kept.join(groups.select(*header, "total", "terms"), header)
        .select(*header, "term_cell", F.struct("slot", share.alias("share")).alias("entry"))
        .groupBy(*header, "term_cell")
        .agg(F.collect_list("entry").alias("entries"))
    )
    # A source meets every block of terms, also one of which it uses none.
    cells = groups.withColumn("term_cell", F.explode(F.sequence(F.lit(0), F.col("term_cells") - 1)))
    whole = cells.join(contents, [*header, "term_cell"], "left")
    mate = F.explode(F.sequence(F.lit(0), F.col("group_cells") - 1)).alias("mate")
    copies = whole.select("*", mate).select(
        "lang",
        F.least("group_cell", "mate").alias("first"),
        F.greatest("group_cell", "mate").alias("second"),
        "term_cell",
        "group_cell",
        "source",
        "terms",
        _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")).alias("base"),
        F.col("entries.slot").alias("slots"),
        F.col("entries.share").alias("shares"),
    )
    partial = copies.groupBy("lang", "first", "second", "term_cell").applyInArrow(
        _cell, "lang string, source string, other string, value long, gap long, used long, terms long"
    )
    summed = partial.groupBy("lang", "source", "other").agg(
        (F.sum("value") + (F.max("terms") - F.sum("used")) * F.max("gap")).alias("value")
    )
    ways = F.array(
        F.struct("source", F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("source").alias("item")),
    )
    return summed.select("lang", "value", F.explode(ways).alias("pair")).select("lang", "pair.source", "pair.item", "value")


def term_divergences(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of the terms that a group uses more than its language does."""
    own = _share(F.col("n"), F.col("total"), F.col("terms"))
    whole = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    joined = kept.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    found = joined.select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value"))
    return found.filter(F.col("value") > 0)


def audit(
    documents: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    ranks: int = RANKS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """How far sources differ from one another (part ``pair``) and by which terms from their language (part ``term``).

    ``lang, source, part, item, value, rank``. A language keeps the terms of at least
    ``least_documents`` of its documents. Ranks fall by value, ties rise by the bytes
    of the item; pairs have all ranks, terms those up to ``ranks``. A null text, lang
    or source is ''. A group without terms still has its pairs, a language without kept
    terms has pairs of value 0, a language of one source has none. Repeated rows count
    as often, no documents give no rows, other columns and ids are not read. Totals
    up to 10^18 occurrences are exact.
    """
    groups, kept = kept_counts(term_counts(documents), least_documents, group_block, term_block)
    pairs = pair_divergences(groups, kept).withColumn("part", F.lit("pair"))
    terms = term_divergences(groups, kept).withColumn("part", F.lit("term"))
    nth = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    # Ranked apart, so that the bound on terms holds before they are shuffled.
    return (
        pairs.withColumn("rank", nth)
        .select(columns)
        .unionByName(terms.withColumn("rank", nth).filter(F.col("rank") <= ranks).select(columns))
    )
