"""tollbook: revenue reports over telecom usage records, on Spark."""

from .operators import (
    REPORTS,
    clean_cdr,
    count_revenue_15min,
    daily_revenue,
    label_paytype,
    minmax_15min,
    parse_cdr,
    revenue_15min,
    run_counts,
    run_counts_by_cause,
    usable_cells,
    window_cells,
)
from .plans import batch_report, report_from_cells, run_batch, save_cells
from .sinks import compact_report, preview, read_report, write_report
from .sources import CDR_SCHEMA, read_cdr, read_cdr_stream, read_paytype_map, s3a_conf
from .streaming import report_sink, stream_report, stream_reports, streaming_report
from .workspace import clear_intermediates

__all__ = [
    "CDR_SCHEMA",
    "REPORTS",
    "batch_report",
    "clean_cdr",
    "clear_intermediates",
    "compact_report",
    "count_revenue_15min",
    "daily_revenue",
    "label_paytype",
    "minmax_15min",
    "parse_cdr",
    "preview",
    "read_cdr",
    "read_cdr_stream",
    "read_paytype_map",
    "read_report",
    "report_from_cells",
    "report_sink",
    "revenue_15min",
    "run_batch",
    "run_counts",
    "run_counts_by_cause",
    "s3a_conf",
    "save_cells",
    "stream_report",
    "stream_reports",
    "streaming_report",
    "usable_cells",
    "window_cells",
    "write_report",
]
