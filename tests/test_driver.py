from __future__ import annotations

import pytest

import __spark_entry__ as driver
from compare import canonical, duck
from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


# Queries of the optional subpackage have tests of their own.
LLM = set(driver.llm.queries()) | {"pipeline"} if driver.llm else set()
QUERIES = [name for name in driver.queries() if name not in LLM]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(driver.oracle_sql()) - LLM


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    got = driver.queries()[name](spark, SMALL).toPandas()
    want = con.execute(driver.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_dirty_query_drops_some_rows_and_keeps_others(spark):
    counts = driver.queries()["run_counts"](spark, SMALL).first()
    assert 0 < counts.clean_rows < counts.input_rows
