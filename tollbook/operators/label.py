"""Payment-type labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import check_paytype_map

BROADCAST_BYTES = 32 * 1024 * 1024


def row_salt(rows: DataFrame, salts: int) -> Column:
    """A number from 0 to ``salts - 1`` per row.

    It hashes the row, which splits a code, and the partition the row is in, which
    splits copies of one row. Both are the same again when a lost task is repeated.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(salts)).cast("int")


def label_paytype(
    rows: DataFrame,
    paytype_map: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    map_bytes: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Adds ``paytype_label`` by code; null for an unknown or null code.

    The map is broadcast once its measured size is within ``broadcast_bytes``,
    so the rows are not shuffled. A larger map is joined by code and salt, so that
    a code with a large part of the rows spreads over ``salts`` tasks (by default a
    third of the shuffle partitions, a hot code's share). Works on a stream too,
    where the map is static and the join keeps no state.
    ``map_bytes`` is the size of a map that is already checked.
    """
    if map_bytes is None:
        _, map_bytes = check_paytype_map(paytype_map)
    if map_bytes <= broadcast_bytes:
        return rows.join(F.broadcast(paytype_map), "paytype", "left")
    if salts is None:
        salts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 3)
    salted_rows = rows.withColumn("_salt", row_salt(rows, salts))
    salted_map = paytype_map.filter(F.col("paytype").isNotNull()).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted_rows.join(salted_map.hint("merge"), ["paytype", "_salt"], "left").drop("_salt")
