"""DataFrame operators."""

from .clean import clean_cdr, is_usable, parse_cdr
from .label import label_paytype
from .measures import as_measures, run_counts, run_counts_by_cause, usable_cells, window_cells
from .reports import REPORTS, Report, count_revenue_15min, daily_revenue, minmax_15min, report_named, revenue_15min

__all__ = [
    "REPORTS",
    "Report",
    "as_measures",
    "clean_cdr",
    "count_revenue_15min",
    "daily_revenue",
    "is_usable",
    "label_paytype",
    "minmax_15min",
    "parse_cdr",
    "report_named",
    "revenue_15min",
    "run_counts",
    "run_counts_by_cause",
    "usable_cells",
    "window_cells",
]
