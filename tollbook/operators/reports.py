"""The four revenue reports, one definition each for batch and streams.

All take cleaned records or usable window cells (see ``measures``) and return
unsorted results: sorting is left to the sink, where it is legal in every mode.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import WINDOW_LENGTH, amount, day_key, day_text, total
from .measures import as_measures


def daily_revenue(rows: DataFrame) -> DataFrame:
    """Revenue per calendar day of the session zone."""
    daily = as_measures(rows).groupBy(day_key(F.col("event_time")).alias("day")).agg(
        total(F.sum("debit_sum")).alias("daily_revenue")
    )
    return daily.select(day_text(F.col("day")).alias("date"), "daily_revenue")


def daily_revenue_closing(rows: DataFrame, watermark: str, zone: str) -> DataFrame:
    """``daily_revenue`` over a stream, in a form whose days the watermark closes.

    The watermark runs on local clock time, on which every day is a window of 24 hours
    whatever the zone's changes of clock. Where the clock goes back, the hour that
    comes twice is late by up to an hour, but its day is still open.
    """
    local = as_measures(rows).withColumn("local_time", F.from_utc_timestamp("event_time", zone))
    daily = local.withWatermark("local_time", watermark).groupBy(F.window("local_time", "1 day"))
    days = F.floor(F.unix_seconds("window.start") / 86_400).cast("int")
    return daily.agg(total(F.sum("debit_sum")).alias("daily_revenue")).select(
        day_text(F.date_from_unix_date(days)).alias("date"), "daily_revenue"
    )


def _per_window(rows: DataFrame, key: Column, *measures: Column) -> DataFrame:
    windowed = as_measures(rows).groupBy(F.window("event_time", WINDOW_LENGTH), key).agg(*measures)
    return windowed.withColumn("RECORD_DATE", F.col("window.start")).drop("window")


def revenue_15min(rows: DataFrame) -> DataFrame:
    """Revenue per 15-minute window and payment-type code."""
    revenue = total(F.sum("debit_sum")).alias("revenue")
    return _per_window(rows, F.col("paytype"), revenue).select("RECORD_DATE", "paytype", "revenue")


def minmax_15min(rows: DataFrame) -> DataFrame:
    """Lowest and highest charge per 15-minute window and payment-type code."""
    lowest = amount(F.min("debit_min")).alias("min_revenue")
    highest = amount(F.max("debit_max")).alias("max_revenue")
    return _per_window(rows, F.col("paytype"), lowest, highest).select(
        "RECORD_DATE", "paytype", "min_revenue", "max_revenue"
    )


def count_revenue_15min(rows: DataFrame) -> DataFrame:
    """Record count and revenue per 15-minute window and payment-type label."""
    records = F.sum("record_count").alias("record_count")
    revenue = total(F.sum("debit_sum")).alias("revenue")
    return _per_window(rows, F.col("paytype_label").alias("Pay_type"), records, revenue).select(
        "RECORD_DATE", "Pay_type", "record_count", "revenue"
    )


@dataclass(frozen=True)
class Report:
    """A report: how to build it, how to sort it and what it needs."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    sort_by: tuple[str, ...]
    labelled: bool = False
    windowed: bool = True


REPORTS: dict[str, Report] = {
    report.name: report
    for report in (
        Report("daily_revenue", daily_revenue, ("date",), windowed=False),
        Report("revenue_15min", revenue_15min, ("RECORD_DATE", "paytype")),
        Report("minmax_15min", minmax_15min, ("RECORD_DATE", "paytype")),
        Report("count_revenue_15min", count_revenue_15min, ("RECORD_DATE", "Pay_type"), labelled=True),
    )
}


def report_named(name: str) -> Report:
    """The report of that name; ValueError names the known ones."""
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; known: {', '.join(REPORTS)}")
    return REPORTS[name]
