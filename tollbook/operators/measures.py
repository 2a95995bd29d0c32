"""Measures: the one row form that all reports read.

A measure row stands for one or more usage records of the same payment type and
window and carries their count and the sum, minimum and maximum of their recorded
charges. Sum, minimum, maximum and count can be combined again, so a report gives
the same result over single records (streams) and over pre-aggregated cells (batch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import CAUSES, WINDOW_LENGTH, WINDOW_MICROS, bucket_start, day_key
from .clean import is_usable


def _summable(debit: Column) -> Column:
    # One more digit than a charge: the sum then overflows only where its tenth leaves decimal(28,6).
    return debit.cast("decimal(15,2)")


def as_measures(rows: DataFrame) -> DataFrame:
    """Cleaned records as measure rows, one each; rows that are measures already stay as they are."""
    if "debit_sum" in rows.columns:
        return rows
    return rows.withColumns(
        {
            "record_count": F.lit(1).cast("long"),
            "debit_sum": _summable(F.col("debit")),
            "debit_min": F.col("debit"),
            "debit_max": F.col("debit"),
        }
    )


def window_cells(parsed: DataFrame) -> DataFrame:
    """One measure row per 15-minute window and payment type, from parsed records.

    One scan and one shuffle of partial sums serve all reports and the run
    counts. Unusable records are not filtered out but fall into cells without an
    ``event_time``, by ``cause``, which hold their number too.

    ``event_time`` is returned as an aggregate of the grouping key: null checks on
    it then stay above the shuffle and do not pull a second parse into the scan.
    """
    zone = parsed.sparkSession.conf.get("spark.sql.session.timeZone")
    keyed = parsed.select(
        F.when(is_usable(), bucket_start(F.col("event_time"), zone)).alias("bucket"),
        "paytype",
        F.when(F.col("event_time").isNotNull(), F.col("debit")).alias("debit"),
        "cause",
    )
    return (
        keyed.groupBy("bucket", "paytype", "cause")
        .agg(
            F.max("bucket").alias("event_time"),
            F.count("*").alias("record_count"),
            F.sum(_summable(F.col("debit"))).alias("debit_sum"),
            F.min("debit").alias("debit_min"),
            F.max("debit").alias("debit_max"),
        )
        .drop("bucket")
    )


def stream_cells(clean: DataFrame) -> DataFrame:
    """Window cells of a stream of cleaned records with a watermark on ``event_time``.

    As ``window_cells``, but keyed by the window itself, which lets the watermark
    close it, and by the local day, so that a cell lies within one. Both stay as
    columns, ``bucket`` (the window's start) and ``day``.
    """
    return (
        as_measures(clean)
        .groupBy(F.window("event_time", WINDOW_LENGTH), day_key(F.col("event_time")).alias("day"), F.col("paytype"))
        .agg(
            F.min("event_time").alias("first_time"),
            F.sum("record_count").alias("record_count"),
            F.sum("debit_sum").alias("debit_sum"),
            F.min("debit_min").alias("debit_min"),
            F.max("debit_max").alias("debit_max"),
        )
        .select(
            F.col("window.start").alias("bucket"),
            "day",
            F.col("first_time").alias("event_time"),
            "paytype",
            "record_count",
            "debit_sum",
            "debit_min",
            "debit_max",
        )
    )


def cell_keys(cells: DataFrame) -> DataFrame:
    """Usable window cells with the columns of ``stream_cells``."""
    micros = F.unix_micros("event_time")
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(WINDOW_MICROS)))
    measures = ["event_time", "paytype", "record_count", "debit_sum", "debit_min", "debit_max"]
    return usable_cells(cells).select(start.alias("bucket"), day_key(F.col("event_time")).alias("day"), *measures)


def usable_cells(cells: DataFrame) -> DataFrame:
    """The cells of usable records."""
    return cells.filter(F.col("event_time").isNotNull())


def run_counts(cells: DataFrame) -> DataFrame:
    """``input_rows``, ``clean_rows`` and ``rejected_rows`` of a run, from its cells."""
    everything = F.coalesce(F.sum("record_count"), F.lit(0))
    usable = F.coalesce(F.sum(F.when(F.col("event_time").isNotNull(), F.col("record_count"))), F.lit(0))
    return cells.agg(everything.alias("input_rows"), usable.alias("clean_rows")).withColumn(
        "rejected_rows", F.col("input_rows") - F.col("clean_rows")
    )


def run_counts_by_cause(cells: DataFrame) -> DataFrame:
    """``cause``, its ``reasons`` in words and ``rejected_rows`` of a run's unusable records, from its cells."""
    names = F.filter(
        F.array(*[F.when(F.col("cause").bitwiseAND(bit) > 0, F.lit(name)) for bit, name in CAUSES.items()]), lambda n: n.isNotNull()
    )
    rejected = cells.filter(F.col("event_time").isNull()).groupBy("cause").agg(F.sum("record_count").alias("rejected_rows"))
    return rejected.select("cause", F.array_join(names, ", ").alias("reasons"), "rejected_rows")
