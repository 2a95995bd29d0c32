"""Shards along a Hilbert curve over document metadata, with built-in functions only.

Each dimension is quantised to ``2**bits`` steps; the curve index of the cell keeps
cells that are near in all dimensions near in order. Documents are range-partitioned
and sorted by it, numbered through, and cut in equal runs, so a shard (and every
file in it) covers a small box of the dimensions and readers prune files on several
columns at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import saved, text_bytes

BITS = 5
ROWS_PER_PARTITION = 250_000
LEAST_PARTITIONS, MOST_PARTITIONS = 8, 20_000


def size_step(size: Column, bits: int = BITS) -> Column:
    """Step of a size: its doublings spread over the steps (2**31 in the last one); null counts as 0."""
    doublings = F.log2(F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("double") + 1)
    return F.least(F.floor(doublings * ((1 << bits) / 32)), F.lit((1 << bits) - 1)).cast("int")


def name_step(name: Column, bits: int = BITS) -> Column:
    """Step of a name: equal names share one, so it prunes on equality; null has step 0."""
    return F.pmod(F.coalesce(F.crc32(name), F.lit(0)), F.lit(1 << bits)).cast("int")


def with_curve_index(df: DataFrame, steps: list[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """Adds the Hilbert index of the cell in the columns ``steps``, which it uses up.

    Skilling's transform as a chain of projections: undo the turns of each level from
    the top, take the Gray code, interleave the bits.
    """
    if len(steps) * bits > 62:
        raise ValueError("the index must fit in a long")
    first, last = steps[0], steps[-1]
    for bit in range(bits - 1, 0, -1):
        low = F.lit((1 << bit) - 1)
        for step in steps:
            high = F.col(step).bitwiseAND(F.lit(1 << bit)) != 0
            swap = F.col(first).bitwiseXOR(F.col(step)).bitwiseAND(low)
            moved = {first: F.when(high, F.col(first).bitwiseXOR(low)).otherwise(F.col(first).bitwiseXOR(swap))}
            if step != first:
                moved[step] = F.when(high, F.col(step)).otherwise(F.col(step).bitwiseXOR(swap))
            df = df.withColumns(moved)
    for before, step in zip(steps, steps[1:], strict=False):
        df = df.withColumn(step, F.col(step).bitwiseXOR(F.col(before)))
    flips = F.lit(0)
    for bit in range(1, bits):
        flips = flips.bitwiseXOR(
            F.when(F.col(last).bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0))
        )
    df = df.withColumn(name, flips)
    df = df.withColumns({step: F.col(step).bitwiseXOR(F.col(name)) for step in steps})
    index = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for step in steps:
            index = F.shiftleft(index, 1) + F.shiftright(F.col(step), bit).bitwiseAND(F.lit(1)).cast("long")
    return df.withColumn(name, index).drop(*steps)


def hilbert_shards(documents: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """Every document's shard and place in it, along the curve over size, source and language.

    ``doc_id, size, text_crc32, curve, shard, slot``. The law is by rows: shards are
    runs of the order whose counts differ by one at most. Size is the text's UTF-8
    bytes plus one; a null text has none and the checksum 0, a null source or
    language is a name of its own. Equal cells are ordered by id (null first) and
    then by row, so a cell that holds a third of the rows is cut like any other and
    rows that repeat get slots of their own. No documents give no rows.

    The text is read once, for its size and checksum; what is sorted is a few numbers
    per row. Numbering needs one row per partition besides, never all rows in a task.
    """
    keyed = documents.select(
        "doc_id",
        (text_bytes(F.col("text")) + 1).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32"),
        name_step(F.col("source"), bits).alias("s"),
        name_step(F.col("lang"), bits).alias("l"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("z", size_step(F.col("size"), bits))
    keyed = saved(with_curve_index(keyed, ["z", "s", "l"], bits), "curve-keys")
    rows = keyed.count()
    order = [F.col("curve"), F.col("doc_id").asc_nulls_first(), F.col("row")]
    parts = min(MOST_PARTITIONS, max(LEAST_PARTITIONS, -(-rows // ROWS_PER_PARTITION)))
    place = F.monotonically_increasing_id()  # partition in the high bits, row of it in the low 33
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row").withColumn("place", place)
    ordered = saved(ordered, "curve-order").select(
        "*", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("at")
    )
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = ordered.groupBy("part").count().select("part", F.coalesce(before, F.lit(0)).alias("base"))
    # The first `longer` shards hold one row more than the others.
    each, longer = divmod(rows, shards)
    edge = longer * (each + 1)
    numbered = ordered.join(F.broadcast(bases), "part").withColumn("n", F.col("base") + F.col("at"))
    in_longer = F.col("n") < edge
    behind = F.col("n") - edge
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        "curve",
        F.when(in_longer, F.expr(f"n div {each + 1}")).otherwise(longer + F.floor(behind / max(each, 1))).cast("int").alias("shard"),
        F.when(in_longer, F.col("n") % (each + 1)).otherwise(behind % max(each, 1)).cast("long").alias("slot"),
    )


def write_shards(documents: DataFrame, shards: DataFrame, path: str) -> None:
    """Writes the documents in one folder per shard, each file sorted along the curve.

    Documents and their places are joined by ``doc_id``, which must be a key on both
    sides: ValueError where it is null or stands twice, or where the two differ, before
    anything is written. No documents write no files.
    """
    places = shards.groupBy("doc_id").agg(F.count("*").alias("places"))
    rows = documents.groupBy("doc_id").agg(F.count("*").alias("rows"))
    alike = (F.col("places") == 1) & (F.col("rows") == 1)
    odd = rows.join(places, "doc_id", "full").filter(~F.coalesce(alike, F.lit(False))).limit(1).collect()
    if odd:
        found = odd[0]
        raise ValueError(f"document {found.doc_id} has {found.rows or 0} rows and {found.places or 0} places")
    placed = documents.join(shards.select("doc_id", F.col("shard").alias("_shard"), F.col("slot").alias("_slot")), "doc_id")
    ordered = placed.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").drop("_slot")
    ordered.withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path)
