"""End-to-end batch plans."""

from .batch import batch_report, report_from_cells, run_batch, save_cells

__all__ = ["batch_report", "report_from_cells", "run_batch", "save_cells"]
