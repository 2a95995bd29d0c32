"""Sinks."""

from pyspark.sql import DataFrame, SparkSession

from .parts import compact_report, read_parts
from .report_files import REPORT_SCHEMAS, parts_path, preview, read_complete, refuse_parts, write_report

__all__ = ["REPORT_SCHEMAS", "compact_report", "parts_path", "preview", "read_report", "refuse_parts", "write_report"]


def read_report(spark: SparkSession, name: str, path: str, mode: str = "complete") -> DataFrame:
    """A written report with its types.

    ``complete`` reads what batch jobs and streams in that mode leave at ``path``,
    ``append`` and ``update`` what the parts beside it make.
    """
    if mode == "complete":
        return read_complete(spark, name, path)
    return read_parts(spark, name, path, mode)
