"""Near-duplicate classes: BagMinHash signatures, bands, and verified multiset overlap.

Equal texts are one node. Nodes that share a band are candidates; a link needs a
weighted Jaccard similarity of ``threshold`` or more between their bags of word
shingles, and classes are what links connect. Every node is first compared with one
pivot, which joins most of a large group. What then lies in different classes of a
bucket is compared in pairs of bounded blocks, each candidate pair in the first band
that it shares; nodes of one class need no comparison. So no link between candidates
is lost, no group is collected, and only links leave a block. Texts meet keys by
sorting and merging at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bag_minhash
from .components import merged
from .rows import column_of, map_slices, saved, texts_of, unused

THRESHOLD = 0.8
#: Nodes of a block, about; a task holds two blocks.
BLOCK = 1024
NO_ID = -(2**63)
#: Pairs of one pivot that are joined with one copy of its text.
PAIRS = 1024


def _node() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def signed(documents: DataFrame) -> DataFrame:
    """``doc_id, node, bands``: the digest of every text and the keys of its bands (none without words)."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        nodes, texts = column_of(batch, "node").to_pylist(), texts_of(batch)
        first = {node: k for k, node in reversed(list(enumerate(nodes)))}
        bags = {node: bag_minhash.bag(texts[k]) for node, k in first.items()}
        filled = [node for node, (hashes, _) in bags.items() if len(hashes)]
        keys = bag_minhash.bands(bag_minhash.signatures([bags[node] for node in filled])).view(np.int64)
        of = dict(zip(filled, keys, strict=True))
        return {
            "doc_id": column_of(batch, "doc_id"),
            "node": column_of(batch, "node"),
            "bands": pa.array([of.get(node) for node in nodes], pa.list_(pa.int64())),
        }

    rows = documents.select("doc_id", "text", _node().alias("node"))
    return map_slices(rows, "doc_id long, node binary, bands array<long>", work, most=1 << 20)


def _with_copies(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs ``a, b`` each with the ``copy`` of ``b`` that it meets, and all ``b, copy``.

    A ``b`` has a copy for some ``PAIRS`` of its pairs, so that a large group is no hot key.
    """
    copies = saved(pairs.groupBy("b").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("copies")), "copies")
    copy = F.pmod(F.xxhash64("a"), F.col("copies")).cast("int").alias("copy")
    each = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    return pairs.join(copies, "b").select("a", "b", copy), copies.select("b", each)


def verified(texts: DataFrame, copies: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` of texts ``id, text, b, copy`` whose bags overlap by ``threshold`` or more; ``b`` null is none."""
    left = texts.filter("b is not null").select(F.col("id").alias("a"), "b", "copy", F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).join(copies.hint("merge"), "b")
    both = left.join(right.hint("merge"), ["b", "copy"]).select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag_b = None, None
        for batch in batches:
            keep = []
            for b, text_a, text_b in zip(*(column_of(batch, c).to_pylist() for c in ("b", "text_a", "text_b")), strict=True):
                if b != last:
                    last, bag_b = b, bag_minhash.bag(text_b)
                keep.append(bag_minhash.overlap(bag_minhash.bag(text_a), bag_b) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.sortWithinPartitions("b").mapInArrow(run, "a long, b long")


def _block_keys(members: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """``bucket, s, t, block, id, comp``: the nodes of buckets with several classes, in pairs of blocks.

    A bucket's largest class (``top``) and its other nodes are cut in blocks of about
    ``size`` by hash. Each block of others meets itself, every other one and every
    block of the largest class, which never meets itself: its nodes are one class.
    """
    rows = members.select("bucket", "id").join(labels, "id")
    classes = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    sizes = classes.groupBy("bucket").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("k")
    )
    several = sizes.filter("k > 1").select(
        "bucket",
        F.col("top.comp").alias("top"),
        F.ceil((F.col("n") - F.col("top.n")) / size).cast("int").alias("others"),
        F.when(F.col("n") <= size, 0).otherwise(F.ceil(F.col("top.n") / size)).cast("int").alias("tops"),
    )
    rows = rows.join(saved(several, "several"), "bucket")
    is_top = (F.col("comp") == F.col("top")) & (F.col("tops") > 0)
    # A bucket within one block is one group, its largest class included.
    others = F.when(F.col("tops") == 0, 1).otherwise(F.col("others"))
    block = F.when(is_top, others + F.pmod(F.xxhash64("id"), F.col("tops"))).when(
        F.col("tops") == 0, 0
    ).otherwise(F.pmod(F.xxhash64("id"), others))
    rows = rows.withColumn("block", block.cast("int"))
    last = F.when(is_top, others - 1).otherwise(others + F.col("tops") - 1)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select(
        "bucket", F.least("block", "other").alias("s"), F.greatest("block", "other").alias("t"), "block", "id", "comp"
    )


def _links_in_blocks(table: pa.Table, threshold: float) -> pa.Table:
    """Links between the classes of one pair of blocks of a bucket.

    Each node is compared with the nodes before it that are of another class, of the
    other block if there are two, and do not share an earlier band (there they are
    compared already). Overlaps with all of them come from one list of the blocks'
    shingles. Classes that a link joins are one from then on.
    """
    block = table.column("block").to_numpy()
    order = np.lexsort((table.column("id").to_numpy(), block))
    ids, comps, block = (table.column(c).to_numpy()[order] for c in ("id", "comp", "block"))
    texts = [table.column("text")[int(k)].as_py() for k in order]
    keys = np.array([table.column("bands")[int(k)].as_py() for k in order])
    band = int(np.flatnonzero(keys[0] == table.column("bucket")[0].as_py())[0])
    bags = [bag_minhash.bag(text) for text in texts]
    sizes = np.array([int(counts.sum()) for _, counts in bags])
    lengths = np.array([len(hashes) for hashes, _ in bags])
    shingles, inverse = np.unique(np.concatenate([hashes for hashes, _ in bags]), return_inverse=True)
    holder = np.repeat(np.arange(len(bags)), lengths)
    by = np.argsort(inverse, kind="stable")
    held_by, held = holder[by], np.concatenate([counts for _, counts in bags])[by]
    starts = np.searchsorted(inverse[by], np.arange(len(shingles) + 1))
    ends = np.cumsum(lengths)
    comps = np.unique(comps, return_inverse=True)[1]
    two_blocks = block[0] != block[-1]
    a, b = [], []
    for k in range(1, len(ids)):
        ask = comps[:k] != comps[k]
        if two_blocks:
            ask &= block[:k] != block[k]
        if band:
            ask &= ~(keys[:k, :band] == keys[k, :band]).any(1)
        # The smaller bag must hold enough for the threshold.
        ask &= np.minimum(sizes[:k], sizes[k]) >= threshold * np.maximum(sizes[:k], sizes[k])
        if not ask.any():
            continue
        own, counts = inverse[ends[k] - lengths[k] : ends[k]], bags[k][1]
        n = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(held_by[at], np.minimum(held[at], np.repeat(counts, n)), len(ids))[:k]
        alike = np.flatnonzero(ask & (common >= threshold * (sizes[:k] + sizes[k] - common)))
        for j in alike.tolist():
            if comps[j] != comps[k]:
                a.append(int(ids[k]))
                b.append(int(ids[j]))
                comps[comps == comps[j]] = comps[k]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def text_classes(documents: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """The signed documents and ``node, least, class_id, head`` of every different text.

    ``least`` is the smallest id of the text's documents, ``class_id`` that of its class.
    ``head`` marks one text of each class: that of the smallest id, then of the smallest digest.
    """
    signs = saved(signed(documents), "signs")
    nodes = signs.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))
    nodes = saved(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    buckets = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("pivot"))
    shared = saved(shared.filter("n > 1").select("bucket", "pivot"), "buckets")
    members = saved(buckets.join(shared, "bucket"), "members")
    labels = saved(members.select("id", F.col("id").alias("comp")).distinct(), "labels")
    # Each node meets the smallest pivot of its buckets first: that joins most of a large group.
    first = members.filter("id <> pivot").groupBy(F.col("id").alias("a")).agg(F.min("pivot").alias("b"))
    dealt, copies = _with_copies(first)
    # One document per text: its id and digest are the key, so a text with many copies is no hot key.
    wanted = labels.join(nodes, "id").join(dealt.withColumnRenamed("a", "id"), "id", "left")
    wanted = saved(wanted.select("id", "b", "copy", "node", F.coalesce("least", F.lit(NO_ID)).alias("key")), "wanted")
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"), _node().alias("node"), F.coalesce("doc_id", F.lit(NO_ID)).alias("key"))
    texts = texts.join(wanted.hint("merge"), ["node", "key"]).select("id", "text", "b", "copy")
    texts = saved(texts.dropDuplicates(["id"]), "texts")
    labels = merged(labels, saved(verified(texts, copies, threshold), "links"))
    # Then whatever is still in different classes of a bucket.
    rows = _block_keys(members, labels, BLOCK).join(texts.select("id", "text").join(nodes.select("id", "bands"), "id"), "id")
    links = rows.groupBy("bucket", "s", "t").applyInArrow(lambda table: _links_in_blocks(table, threshold), "a long, b long")
    labels = merged(labels, saved(links, "links"))

    placed = nodes.join(labels, "id", "left").select("node", "least", F.coalesce("comp", "id").alias("comp"))
    placed = saved(placed, "placed")
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("first")
    heads = saved(placed.groupBy("comp").agg(first).select("comp", F.col("first.least").alias("class_id"), F.col("first.node").alias("first")), "heads")
    head = (F.col("node") == F.col("first")).alias("head")
    return signs, saved(placed.join(heads, "comp").select("node", "least", "class_id", head), "classes")


def near_duplicate_classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id`` of every document; ``class_id`` is the smallest id of its class.

    Texts are compared as bags of five-word shingles in lower case; a shorter text is
    one shingle. Null and empty texts are equal texts without shingles, and a class of
    their own. Rows that repeat are in one class. A document without an id has the
    class of its text; a class without any id has none. No documents give no rows.
    """
    signs, classes = text_classes(documents, threshold)
    return signs.select("doc_id", "node").join(classes.select("node", "class_id"), "node").select("doc_id", "class_id")


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns.

    Of rows that repeat with the same id and text, one stays. Of different texts with
    the smallest id, or of a class without any id, that of the smallest digest stays.
    """
    _, classes = text_classes(documents, threshold)
    kept = classes.filter("head").select("node", F.coalesce("class_id", F.lit(NO_ID)).alias("key"))
    names = documents.columns
    node, key = (unused(name, names) for name in ("node", "key"))
    kept = kept.select(F.col("node").alias(node), F.col("key").alias(key))
    own = documents.withColumns({node: _node(), key: F.coalesce("doc_id", F.lit(NO_ID))})
    # Repeated rows go before the shuffle, which the join then shares.
    once = own.dropDuplicates([node, key])
    return once.join(kept.hint("merge"), [node, key], "left_semi").select(*[f"`{name}`" for name in names])
