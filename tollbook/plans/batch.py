"""All reports from one pass over a bounded set of usage records."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import parse_cdr
from ..operators.label import label_paytype
from ..operators.measures import run_counts, usable_cells, window_cells
from ..operators.reports import REPORTS, Report, report_named
from ..sinks.report_files import refuse_parts, write_report
from ..sources.files import check_paytype_map, read_cdr, read_paytype_map
from ..workspace import delete, job_session, scratch_path


def report_from_cells(
    name: str, cells: DataFrame, paytype_map: DataFrame | None = None, map_bytes: int | None = None
) -> DataFrame:
    """A report over window cells; the map is needed for the labelled one only."""
    report = report_named(name)
    rows = usable_cells(cells)
    if report.labelled:
        if paytype_map is None:
            raise ValueError(f"report {name} needs a payment-type map")
        rows = label_paytype(rows, paytype_map, map_bytes=map_bytes)
    return report.build(rows)


def batch_report(name: str, cdr: DataFrame, paytype_map: DataFrame | None = None) -> DataFrame:
    """A report over raw usage records."""
    return report_from_cells(name, window_cells(parse_cdr(cdr)), paytype_map)


def save_cells(spark: SparkSession, cdr_path: str | list[str], path: str, zone: str | None = "UTC") -> None:
    """Writes the window cells of a directory of usage records to ``path``, for the ``history`` of a stream in that zone."""
    cells = usable_cells(window_cells(parse_cdr(read_cdr(job_session(spark, zone), cdr_path))))
    cells.write.mode("overwrite").parquet(path)


def run_batch(
    spark: SparkSession,
    cdr_path: str | list[str],
    map_path: str,
    out_base: str,
    zone: str | None = "UTC",
    files: int = 1,
    scratch: str | None = None,
    keep: int | None = None,
) -> dict[str, int]:
    """Writes all four reports under ``out_base`` and returns the counts of the run.

    The records are scanned and shuffled once, into window cells. The cells are
    written to a scratch folder, so the counts and the reports read that small table
    and a lost executor never brings the scan back. Labels are joined to cells, not
    to records. The scratch folder lies below ``scratch``, else below the folder in
    ``spark.checkpoint.dir``, else below ``out_base``, and is deleted at the end.

    Counts: ``input_rows``, ``clean_rows``, ``rejected_rows``, ``map_rows`` and
    the rows of each report under its name. ``zone`` decides day boundaries; the
    job has a session of its own for it, so jobs in other zones may run beside it.
    ``files`` is the number of files of each report, ``keep`` makes them versions
    (``write_report``). Any failure is raised; a report is replaced when its own write
    ends, so after a failed write some are of this run and some of the one before.
    """
    session = job_session(spark, zone)
    out = out_base.rstrip("/")
    for name in REPORTS:
        refuse_parts(session, f"{out}/{name}")
    paytype_map = read_paytype_map(session, map_path, check=False)
    map_rows, map_bytes = check_paytype_map(paytype_map)
    cells_path = scratch_path(session, "cells", scratch, out)
    try:
        written = window_cells(parse_cdr(read_cdr(session, cdr_path)))
        written.write.parquet(cells_path)
        cells = session.read.schema(written.schema).parquet(cells_path)
        counts = run_counts(cells).first().asDict() | {"map_rows": map_rows}

        def write(report: Report) -> int:
            result = report_from_cells(report.name, cells, paytype_map, map_bytes)
            return write_report(result, f"{out}/{report.name}", report.sort_by, files, keep)

        # The reports are small and independent jobs, so their fixed costs overlap.
        with ThreadPoolExecutor(len(REPORTS)) as pool:
            rows = pool.map(inheritable_thread_target(session)(write), REPORTS.values())
            return counts | dict(zip(REPORTS, rows, strict=True))
    finally:
        delete(session, cells_path)
