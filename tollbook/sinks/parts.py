"""Parts of append and update streams: one folder per query and micro-batch, their folding and their reader.

A trigger of 30 seconds leaves a million folders a year. Folding puts the finished
micro-batches of a query into one version on its shelf ``_folds``, numbered by the
last micro-batch in it. The report is the newest fold and the parts after it. Parts
in a fold stay until the next folding, so a reader that has begun is not cut off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reports import Report, report_named
from ..workspace import child_names, delete
from .report_files import REPORT_SCHEMAS, parts_path
from .versions import new_name, newest, number_of, publish

SHELF = "_folds"


def _queries(spark: SparkSession, parts: str) -> list[str]:
    return [f"{parts}/{name}" for name in child_names(spark, parts) if name.startswith("query_id=")]


def _batches(spark: SparkSession, folder: str) -> list[int]:
    names = child_names(spark, folder)
    return sorted(int(name.partition("=")[2]) for name in names if name.startswith("batch_id="))


def _rows(spark: SparkSession, report: Report, folder: str) -> DataFrame:
    """All rows of one query with their ``batch_id``, of the newest fold and of the parts after it."""
    schema, shelf = f"{REPORT_SCHEMAS[report.name]}, batch_id bigint", f"{folder}/{SHELF}"
    reader = spark.read.schema(schema).option("header", True)
    while True:
        fold = newest(spark, shelf)
        parts = reader.csv(folder)  # lists the parts; the shelf is skipped
        if newest(spark, shelf) == fold:
            break
    if fold is None:
        return parts
    return reader.csv(f"{shelf}/{fold}").unionByName(parts.filter(F.col("batch_id") > number_of(fold)))


def _last(rows: DataFrame, report: Report) -> DataFrame:
    """The last rows written of each group, with their ``batch_id``.

    Labels can change, so a window of the labelled report is written with all its
    labels at once, and its last micro-batch holds all of it.
    """
    keys = ["RECORD_DATE"] if report.labelled else list(report.sort_by)
    values = [name for name in rows.columns if name not in {*keys, "batch_id"}]
    if report.labelled:
        written = rows.groupBy(*keys, "batch_id").agg(F.collect_list(F.struct(*values)).alias("written"))
        last = written.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"), F.max_by("written", "batch_id").alias("written"))
        return last.select(*keys, "batch_id", F.inline("written")).select(rows.columns)
    last = F.max_by(F.struct(*values), "batch_id").alias("last")
    return rows.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"), last).select(*keys, "batch_id", "last.*").select(rows.columns)


def read_parts(spark: SparkSession, name: str, path: str, mode: str) -> DataFrame:
    """The report that the parts beside ``path`` make: all rows in append mode, the last of each group in update mode."""
    report, parts = report_named(name), parts_path(path, mode)
    rows = None
    for folder in _queries(spark, parts):
        own = _rows(spark, report, folder)
        own = _last(own, report) if mode == "update" else own
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        return spark.createDataFrame([], REPORT_SCHEMAS[name])
    return rows.drop("batch_id")


def compact_report(
    spark: SparkSession, name: str, path: str, mode: str, files: int = 1, checkpoint: str | None = None
) -> dict[str, int]:
    """Folds the finished parts beside the report at ``path``; returns the last micro-batch in each query's fold.

    Micro-batches follow one another, so all but the newest part are finished. With
    the query's ``checkpoint``, those that it has committed are. The query may run
    meanwhile, and ``read_report`` reads the same before, during and after. In update
    mode only the last rows of each group are kept. Parts that the fold before holds
    are removed. A folding that dies leaves the one before; done again, it starts anew.
    """
    report = report_named(name)
    folded = {}
    for folder in _queries(spark, parts_path(path, mode)):
        shelf, batches = f"{folder}/{SHELF}", _batches(spark, folder)
        done = batches[:-1]
        if checkpoint is not None:
            commits = [int(n) for n in child_names(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()]
            done = [n for n in batches if n <= max(commits, default=-1)]
        before = newest(spark, shelf)
        held = number_of(before) if before else -1
        if done and done[-1] > held:
            rows = _rows(spark, report, folder).filter(F.col("batch_id") <= done[-1])
            rows = _last(rows, report) if mode == "update" else rows
            fold = new_name(spark, shelf, done[-1])
            sort_by = [*report.sort_by, "batch_id"]
            sorted_rows = rows.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by)
            sorted_rows.write.option("header", True).csv(f"{shelf}/{fold}")
            publish(spark, shelf, fold, keep=1)
            for n in batches:
                if n <= held:
                    delete(spark, f"{folder}/batch_id={n}")
            held = done[-1]
        if held >= 0:
            folded[folder.rpartition("query_id=")[2]] = held
    return folded
