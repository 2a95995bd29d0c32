"""Scalar column expressions."""

from .fields import amount, bucket_start, day_key, day_text, debit, event_time, paytype_code, total

__all__ = ["amount", "bucket_start", "day_key", "day_text", "debit", "event_time", "paytype_code", "total"]
