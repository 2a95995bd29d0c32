"""Report output: sorted CSV files with a header, and their reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..workspace import beside, child_names, delete, replace
from .versions import new_name, newest, publish

# The columns of a written report.
REPORT_SCHEMAS = {
    "daily_revenue": "date string, daily_revenue decimal(28,6)",
    "revenue_15min": "RECORD_DATE timestamp, paytype int, revenue decimal(28,6)",
    "minmax_15min": "RECORD_DATE timestamp, paytype int, min_revenue decimal(18,6), max_revenue decimal(18,6)",
    "count_revenue_15min": "RECORD_DATE timestamp, Pay_type string, record_count bigint, revenue decimal(28,6)",
}


#: Shelf of a report's versions.
SHELF = "_versions"


def _write(report: DataFrame, path: str, sort_by: Sequence[str], files: int) -> int:
    written = Observation()
    (
        report.repartitionByRange(files, *sort_by)
        .sortWithinPartitions(*sort_by)
        .observe(written, F.count("*").alias("rows"))
        .write.option("header", True)
        .csv(path)
    )
    return written.get["rows"]


def write_report(
    report: DataFrame, path: str, sort_by: Sequence[str], files: int = 1, keep: int | None = None, empty: bool = True
) -> int:
    """Writes a report in sort order in the place of the earlier one and returns its row count.

    The report is computed once, whatever its size. It is range-partitioned on the
    sort columns and sorted per partition, so its files in name order are the sorted
    report. ``files`` is their number: one, the default, suits reports that one task
    can sort (it spills); give more for more rows.

    The files are written beside ``path`` first; a failure leaves the earlier report.
    Then, without ``keep``, the folders change places by renaming, so for a moment
    there is none. With ``keep`` the report becomes a version below ``path`` and the
    ``keep`` versions before it stay for readers that have begun (see ``versions``);
    ``read_report`` reads the newest. On stores where renaming copies, use versions.

    A report without rows replaces the earlier one only if ``empty`` is set. The row
    count is taken in the tasks that write, of which Spark counts each once, however
    often tasks before them are repeated.
    """
    spark, shelf = report.sparkSession, f"{path.rstrip('/')}/{SHELF}"
    name = None if keep is None else new_name(spark, shelf)
    staged = beside(path, "staged") if keep is None else f"{shelf}/{name}"
    try:
        rows = _write(report, staged, sort_by, files)
    except BaseException:
        delete(spark, staged)
        raise
    if not rows and not empty:
        delete(spark, staged)
    elif keep is None:
        replace(spark, path, staged)
    else:
        publish(spark, shelf, name, keep)
        for plain in child_names(spark, path):  # what a run without versions has left
            if not plain.startswith((SHELF, ".")):
                delete(spark, f"{path.rstrip('/')}/{plain}")
    return rows


def preview(report: DataFrame, sort_by: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of a report in sort order."""
    return report.orderBy(*sort_by).limit(n)


def parts_path(path: str, output_mode: str) -> str:
    """Where append and update streams put the parts of the report at ``path``: a folder beside it."""
    return f"{path.rstrip('/')}_{output_mode}"


def refuse_parts(spark: SparkSession, path: str) -> None:
    """ValueError if a folder that is to be replaced holds a stream's parts."""
    parts = [name for name in child_names(spark, path) if name.startswith(("batch_id=", "query_id="))]
    if parts:
        raise ValueError(f"{path} holds parts that a stream has written ({parts[0]}, ...); they would be lost")


def read_complete(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A written report with its types, as batch and complete mode leave it at ``path``: its newest version, if it has any."""
    version = newest(spark, f"{path.rstrip('/')}/{SHELF}")
    files = f"{path.rstrip('/')}/{SHELF}/{version}" if version else path
    return spark.read.schema(REPORT_SCHEMAS[name]).option("header", True).csv(files)
