from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import tollbook as tb
from conftest import SMALL
from fixtures import DIRTY, write_cdr, session_zone

SCHEMAS = {
    "daily_revenue": [("date", "string"), ("daily_revenue", "decimal(28,6)")],
    "revenue_15min": [("RECORD_DATE", "timestamp"), ("paytype", "int"), ("revenue", "decimal(28,6)")],
    "minmax_15min": [
        ("RECORD_DATE", "timestamp"),
        ("paytype", "int"),
        ("min_revenue", "decimal(18,6)"),
        ("max_revenue", "decimal(18,6)"),
    ],
    "count_revenue_15min": [
        ("RECORD_DATE", "timestamp"),
        ("Pay_type", "string"),
        ("record_count", "bigint"),
        ("revenue", "decimal(28,6)"),
    ],
}


def by_records(name, cdr, paytypes):
    """The report over single records, as a stream computes it."""
    rows = tb.clean_cdr(cdr)
    if tb.REPORTS[name].labelled:
        rows = tb.label_paytype(rows, paytypes)
    return tb.REPORTS[name].build(rows)


def contents(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute_force(spark):
    """The four reports over the small events table, in plain Python."""
    labels = {0: "Prepaid", 1: "Postpaid"}
    daily, revenue = defaultdict(Decimal), defaultdict(Decimal)
    spread, counted = defaultdict(list), defaultdict(lambda: [0, Decimal(0)])
    for row in spark.read.parquet(f"{SMALL}/events.parquet").collect():
        charge = Decimal(repr(row.value)).quantize(Decimal("0.01"), ROUND_HALF_UP) / 10
        start = datetime.min + (row.ts - datetime.min) // timedelta(minutes=15) * timedelta(minutes=15)
        code = row.user_id % 3
        daily[row.ts.strftime("%Y-%m-%d")] += charge
        revenue[start, code] += charge
        spread[start, code].append(charge)
        cell = counted[start, labels.get(code)]
        cell[0] += 1
        cell[1] += charge
    return {
        "daily_revenue": [(k, v) for k, v in daily.items()],
        "revenue_15min": [(*k, v) for k, v in revenue.items()],
        "minmax_15min": [(*k, min(v), max(v)) for k, v in spread.items()],
        "count_revenue_15min": [(*k, *v) for k, v in counted.items()],
    }


def as_text(rows):
    return sorted(
        tuple(f"{v:.6f}" if isinstance(v, Decimal) else str(v) for v in row) for row in rows
    )


@pytest.mark.parametrize("name", list(tb.REPORTS))
def test_report_equals_brute_force(spark, paytypes, name):
    got = tb.batch_report(name, driver.cdr_rows(spark, SMALL), paytypes).collect()
    assert as_text(got) == as_text(brute_force(spark)[name])


@pytest.mark.parametrize("name", list(tb.REPORTS))
def test_report_schema(spark, ansi, paytypes, name):
    cdr = driver.cdr_rows(spark, SMALL)
    assert tb.batch_report(name, cdr, paytypes).dtypes == SCHEMAS[name]
    assert by_records(name, cdr, paytypes).dtypes == SCHEMAS[name]


@pytest.mark.parametrize("name", list(tb.REPORTS))
@pytest.mark.parametrize("zone", ["UTC", "Asia/Kathmandu", "America/St_Johns", "Africa/Monrovia"])
def test_cells_and_records_give_the_same_report(spark, ansi, paytypes, tmp_path, name, zone):
    """Also where a local day starts within a window, as with Monrovia's and Kathmandu's offsets of 1910."""
    odd = [("1910/01/01 00:05:00", "0", 10), ("1909/12/31 23:50:00", "0", 20), ("1909/12/31 23:59:59", "0", 30)]
    odd += [(f"1910/01/0{d} {h:02}:{m:02}:00", "1", d * h + m) for d in (1, 2) for h in (0, 23) for m in range(60)]
    write_cdr(tmp_path, "a.csv", [row for row, _ in DIRTY] + odd)
    with session_zone(spark, zone):
        cdr = tb.read_cdr(spark, str(tmp_path))
        assert contents(tb.batch_report(name, cdr, paytypes)) == contents(by_records(name, cdr, paytypes))


def test_windows_start_inclusive_and_unknown_codes_share_one_label(spark, paytypes, tmp_path):
    rows = [("2020/08/30 00:14:59", "0", 10), ("2020/08/30 00:15:00", "0", 20), ("2020/08/30 00:15:00", "7", 30),
            ("2020/08/30 00:15:00", "", 40), ("2020/08/30 00:29:59", "x", 50)]
    write_cdr(tmp_path, "a.csv", rows)
    cdr = tb.read_cdr(spark, str(tmp_path))
    first, second = datetime(2020, 8, 30, 0, 0), datetime(2020, 8, 30, 0, 15)
    counted = tb.batch_report("count_revenue_15min", cdr, paytypes)
    assert as_text(counted.collect()) == as_text(
        [(first, "Prepaid", 1, Decimal(1)), (second, "Prepaid", 1, Decimal(2)), (second, None, 3, Decimal(12))]
    )
    per_code = tb.batch_report("revenue_15min", cdr)
    assert as_text(per_code.collect()) == as_text(
        [(first, 0, Decimal(1)), (second, 0, Decimal(2)), (second, 7, Decimal(3)), (second, None, Decimal(9))]
    )


def test_day_boundary_follows_the_session_zone(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [("2020/08/30 23:59:59", "0", 10), ("2020/08/31 00:00:00", "0", 20)])
    for zone in ("UTC", "Asia/Kathmandu"):
        with session_zone(spark, zone):
            daily = tb.batch_report("daily_revenue", tb.read_cdr(spark, str(tmp_path)))
            assert as_text(daily.collect()) == as_text([("2020-08-30", Decimal(1)), ("2020-08-31", Decimal(2))])


def test_day_that_starts_within_a_window(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [("1909/12/31 23:59:59", "0", 10), ("1910/01/01 00:00:30", "0", 20)])
    with session_zone(spark, "Africa/Monrovia"):
        cdr = tb.read_cdr(spark, str(tmp_path))
        daily = tb.batch_report("daily_revenue", cdr).collect()
        per_window = tb.batch_report("revenue_15min", cdr).select("revenue").collect()
    assert as_text(daily) == as_text([("1909-12-31", Decimal(1)), ("1910-01-01", Decimal(2))])
    assert as_text(per_window) == as_text([(Decimal(3),)])


def test_totals_agree_across_reports(spark, paytypes):
    cdr = driver.dirty_cdr_rows(spark, SMALL)
    cells = tb.window_cells(tb.parse_cdr(cdr))
    daily = tb.batch_report("daily_revenue", cdr).agg(F.sum("daily_revenue")).first()[0]
    per_code = tb.batch_report("revenue_15min", cdr).agg(F.sum("revenue")).first()[0]
    per_label = tb.batch_report("count_revenue_15min", cdr, paytypes).agg(F.sum("revenue"), F.sum("record_count")).first()
    counts = tb.run_counts(cells).first()
    assert daily == per_code == per_label[0]
    assert counts.clean_rows == per_label[1] == tb.clean_cdr(cdr).count()
    assert counts.input_rows == cdr.count() == counts.clean_rows + counts.rejected_rows
    assert tb.batch_report("minmax_15min", cdr).filter("min_revenue > max_revenue").isEmpty()


def test_large_sums_stay_exact(spark, tmp_path):
    write_cdr(tmp_path, "a.csv", [("2020/08/30 00:00:00", "0", "999999999999.99")])
    one = tb.read_cdr(spark, str(tmp_path))
    many = one.crossJoin(spark.range(200_000).select())
    total = tb.batch_report("daily_revenue", many).first()["daily_revenue"]
    assert total == Decimal("99999999999.999") * 200_000


def test_labelled_report_asks_for_the_map(spark):
    with pytest.raises(ValueError, match="needs a payment-type map"):
        tb.batch_report("count_revenue_15min", driver.cdr_rows(spark, SMALL))
    with pytest.raises(ValueError, match="unknown report"):
        tb.batch_report("hourly", driver.cdr_rows(spark, SMALL))
