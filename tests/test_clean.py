from __future__ import annotations

import hypothesis.strategies as st
import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

import tollbook as tb
from fixtures import DIRTY, HEADER, line, write_cdr
from tollbook.functions import paytype_code


def cleaned(df):
    rows = tb.clean_cdr(df).select(
        F.col("event_time").cast("string"), "paytype", F.col("debit_amount").cast("string")
    )
    return sorted((tuple(row) for row in rows.collect()), key=str)


def test_dirty_rows_of_a_batch_scan(spark, ansi, tmp_path):
    write_cdr(tmp_path, "a.csv", [row for row, _ in DIRTY])
    with open(tmp_path / "a.csv", "a") as out:
        out.write("short,row\n")
    assert cleaned(tb.read_cdr(spark, str(tmp_path))) == sorted((kept for _, kept in DIRTY if kept), key=str)


def test_header_lines_read_as_data_are_dropped(spark, ansi, tmp_path):
    write_cdr(tmp_path, "a.csv", [row for row, _ in DIRTY])
    write_cdr(tmp_path, "b.csv", [("2020/08/30 00:00:00", "0", 1)], header=False)
    raw = spark.read.schema(tb.CDR_SCHEMA).csv(str(tmp_path))
    expected = [kept for _, kept in DIRTY if kept] + [("2020-08-30 00:00:00", 0, "0.100000")]
    assert cleaned(raw) == sorted(expected, key=str)


def test_cleaned_types(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [])
    types = dict(tb.clean_cdr(tb.read_cdr(spark, str(tmp_path))).dtypes)
    assert types == {
        "event_time": "timestamp",
        "paytype": "int",
        "debit": "decimal(14,2)",
        "debit_amount": "decimal(18,6)",
    }


def test_records_bind_by_position_not_by_name(spark, tmp_path):
    names = HEADER.split(",")
    (tmp_path / "a.csv").write_text(",".join(reversed(names)) + "\n" + line("2020/08/30 00:00:00", "1", 7) + "\n")
    assert cleaned(tb.read_cdr(spark, str(tmp_path))) == [("2020-08-30 00:00:00", 1, "0.700000")]


@pytest.fixture(scope="module")
def old_cast(spark):
    """The integer cast that gives null instead of an error, as reports were first defined with."""

    def run(texts):
        before = spark.conf.get("spark.sql.ansi.enabled")
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = [r[0] for r in df.orderBy("i").select(paytype_code(F.col("t"))).collect()]
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            want = [r[0] for r in df.orderBy("i").select(F.col("t").cast("int")).collect()]
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)
        return got, want

    return run


def test_paytype_code_examples(old_cast):
    texts = ["0", "1", "1.", "1.9", "-1.9", "+1", "01", "1e0", "1.x", "x", "", ".", ".5", "-.5", "+", " 1 ", "\t1.9\n"]
    texts += ["1 .0", "--1", "1.0.0", "1-", "\u0663", None]
    texts += ["2147483647.5", "2147483648", "2147483648.0", "-2147483648.9", "-2147483649", "9" * 30, "0" * 30 + "7"]
    got, want = old_cast(texts)
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.text(alphabet="01.9+- x\t\ne", max_size=6),
            st.from_regex(r"[ \t]?[+-]?0{0,3}[0-9]{0,22}(\.[0-9]{0,3})?[ \n]?", fullmatch=True),
            st.integers(-(2**33), 2**33).map(str),
            st.text(max_size=3),
        ),
        min_size=60,
        max_size=60,
    )
)
def test_paytype_code_equals_the_lenient_cast(old_cast, texts):
    got, want = old_cast(texts)
    assert got == want


def test_counts_of_a_run(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [row for row, _ in DIRTY])
    cells = tb.window_cells(tb.parse_cdr(tb.read_cdr(spark, str(tmp_path))))
    kept = sum(1 for _, k in DIRTY if k)
    assert tb.run_counts(cells).first().asDict() == {
        "input_rows": len(DIRTY),
        "clean_rows": kept,
        "rejected_rows": len(DIRTY) - kept,
    }


def test_counts_of_no_input(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [])
    cells = tb.window_cells(tb.parse_cdr(tb.read_cdr(spark, str(tmp_path))))
    assert tuple(tb.run_counts(cells).first()) == (0, 0, 0)
