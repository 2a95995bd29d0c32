"""The physical plans that the work at scale depends on."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
import tollbook as tb
from conftest import SMALL
from fixtures import write_cdr


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def csv_cdr(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [("2020/08/30 00:00:00", "0", 10)])
    return tb.read_cdr(spark, str(tmp_path))


@pytest.mark.parametrize("name", list(tb.REPORTS))
def test_report_reads_used_columns_and_parses_once(spark, csv_cdr, paytypes, name):
    plan = plan_of(tb.batch_report(name, csv_cdr, paytypes))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "RECORD_DATE:string,PAYTYPE_515:string,DEBIT_AMOUNT_42:double"
    assert plan.count("gettimestamp(") == 1
    assert "Python" not in plan


@pytest.mark.parametrize("name", list(tb.REPORTS))
def test_facts_are_shuffled_only_as_partial_cells(spark, csv_cdr, paytypes, name):
    plan = plan_of(tb.batch_report(name, csv_cdr, paytypes))
    lowest_shuffle = plan.rindex("Exchange hashpartitioning")
    assert "partial_max" in plan[lowest_shuffle:]
    assert "hashpartitioning(bucket" in plan[lowest_shuffle:]
    assert "rangepartitioning" not in plan


def test_cleaning_parses_once(spark, csv_cdr):
    plan = plan_of(tb.clean_cdr(csv_cdr).select("event_time", "debit_amount"))
    assert plan.count("gettimestamp(") == 1
    assert "PAYTYPE_515" not in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)


def test_labels_join_cells_not_records(spark, csv_cdr, paytypes):
    plan = plan_of(tb.batch_report("count_revenue_15min", csv_cdr, paytypes))
    assert plan.index("BroadcastHashJoin") < plan.index("Exchange hashpartitioning(bucket")


def test_parquet_scan_is_pruned(spark):
    plan = plan_of(tb.batch_report("revenue_15min", driver.cdr_rows(spark, SMALL)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
