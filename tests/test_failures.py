"""Results stay whole when tasks fail half-way and are repeated."""

from __future__ import annotations

import pytest
from pyspark import TaskContext

import __spark_entry__ as driver
import tollbook as tb
from conftest import SMALL


@pytest.fixture
def flaky(spark):
    def break_first_attempt(batches):
        """Passes rows on, then fails the task if it runs for the first time."""
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    cdr = driver.dirty_cdr_rows(spark, SMALL).repartition(4, "CDR_ID_1")
    return cdr.mapInPandas(break_first_attempt, cdr.schema)


def test_counts_are_exact_after_repeated_tasks(spark, flaky):
    whole = tb.run_counts(tb.window_cells(tb.parse_cdr(driver.dirty_cdr_rows(spark, SMALL)))).first()
    assert tb.run_counts(tb.window_cells(tb.parse_cdr(flaky))).first() == whole


@pytest.mark.parametrize("name", list(tb.REPORTS))
def test_reports_are_exact_after_repeated_tasks(spark, flaky, paytypes, name):
    whole = tb.batch_report(name, driver.dirty_cdr_rows(spark, SMALL), paytypes).collect()
    assert sorted(map(str, tb.batch_report(name, flaky, paytypes).collect())) == sorted(map(str, whole))


def test_salted_join_is_exact_after_repeated_tasks(spark, flaky, paytypes):
    columns = ["event_time", "paytype", "debit", "paytype_label"]
    whole = tb.label_paytype(tb.clean_cdr(driver.dirty_cdr_rows(spark, SMALL)), paytypes).select(columns)
    joined = tb.label_paytype(tb.clean_cdr(flaky), paytypes, broadcast_bytes=0).select(columns)
    assert sorted(map(str, joined.collect())) == sorted(map(str, whole.collect()))
