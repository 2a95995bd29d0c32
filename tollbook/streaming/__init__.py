"""Streaming plans."""

from .report_stream import INTAKE_METRICS, report_sink, stream_report, stream_reports, streaming_report

__all__ = ["INTAKE_METRICS", "report_sink", "stream_report", "stream_reports", "streaming_report"]
