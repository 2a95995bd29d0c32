"""From raw usage records to typed, usable ones."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import amount, cause, debit, event_time, paytype_code


def parse_cdr(cdr: DataFrame) -> DataFrame:
    """``event_time``, ``paytype`` and ``debit`` (as recorded) of every record, null where malformed.

    ``cause`` says what is wrong with a record that is not usable; null for others, which are spared the tests for it.
    """
    parsed = cdr.select(
        "RECORD_DATE",
        "PAYTYPE_515",
        "DEBIT_AMOUNT_42",
        event_time(F.col("RECORD_DATE")).alias("event_time"),
        paytype_code(F.col("PAYTYPE_515")).alias("paytype"),
        debit(F.col("DEBIT_AMOUNT_42")).alias("debit"),
    )
    pairs = (("RECORD_DATE", "event_time"), ("PAYTYPE_515", "paytype"), ("DEBIT_AMOUNT_42", "debit"))
    why = cause(*[F.col(name) for pair in pairs for name in pair])
    return parsed.select("event_time", "paytype", "debit", F.when(~is_usable(), why).alias("cause"))


def is_usable() -> Column:
    """Whether a parsed record counts: it has a time and a charge. A null payment type is fine."""
    return F.col("event_time").isNotNull() & F.col("debit").isNotNull()


def clean_cdr(cdr: DataFrame, metrics: str | None = None) -> DataFrame:
    """The usable records, with ``debit_amount decimal(18,6)`` next to the parsed fields.

    Input and usable rows are observed under the name ``metrics``, so a stream
    reports them in its progress without another action. The observation also
    keeps the optimizer from copying the parsing into the filter below it, which
    would parse every line twice; for that it is there without a name as well.

    A name may stand once in a plan: give two cleaned inputs that meet in one plan
    two names. Without one, each call gets a random name, so frames of two calls are
    never the same to Spark (no shared cache or exchange); a name of the caller's
    makes them so. A filter put on the result stays above the observation.
    """
    observed = parse_cdr(cdr).drop("cause").observe(
        metrics or f"cdr_{uuid4().hex}",
        F.count("*").alias("input_rows"),
        F.count_if(is_usable()).alias("clean_rows"),
    )
    return observed.filter(is_usable()).withColumn("debit_amount", amount(F.col("debit")))
