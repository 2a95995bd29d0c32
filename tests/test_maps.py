"""Payment-type maps that change under a running stream; streams that go on from a batch; archives; causes."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

import __spark_entry__ as driver
import tollbook as tb
from conftest import SMALL
from fixtures import DIRTY, write_cdr
from test_streaming import drain, times
from tollbook.sources import PaytypeMaps

NAME = "count_revenue_15min"


def write_map(path, *entries):
    path.write_text("PayType,value\n" + "".join(f"{code},{label}\n" for code, label in entries))


def report(spark, tmp_path, mode="complete"):
    read = tb.read_report(spark, NAME, str(tmp_path / "out"), mode).collect()
    return sorted(((f"{r.RECORD_DATE:%H:%M}", r.Pay_type, r.record_count, float(r.revenue)) for r in read), key=str)


@pytest.mark.parametrize("as_frame", [False, True])
@pytest.mark.parametrize("mode", ["complete", "update", "append"])
def test_a_map_that_repeats_a_code_is_refused_and_named(spark, tmp_path, caplog, mode, as_frame):
    """The map is rewritten between two micro-batches; each record counts once."""
    labels = tmp_path / "map.csv"
    write_map(labels, (0, "Prepaid"), (1, "Postpaid"))
    given = tb.read_paytype_map(spark, str(labels)) if as_frame else str(labels)
    write_cdr(tmp_path / "in", "0.csv", times(("12:00", 1)), order=0)
    drain(spark, NAME, tmp_path, given, output_mode=mode)
    write_map(labels, (0, "Prepaid"), (1, "Postpaid"), (0, "Twice"))
    write_cdr(tmp_path / "in", "1.csv", times(("12:01", 2), ("15:00", 4)), order=1)
    with caplog.at_level("ERROR", "tollbook"):
        drain(spark, NAME, tmp_path, given, output_mode=mode)
    assert any("2 rows for code 0" in record.getMessage() for record in caplog.records)
    closed = [("12:00", "Prepaid", 2, 3.0)]
    assert report(spark, tmp_path, mode) == closed + ([] if mode == "append" else [("15:00", "Prepaid", 1, 4.0)])


def test_a_corrected_map_holds_from_the_next_micro_batch_on(spark, tmp_path):
    labels = tmp_path / "map.csv"
    write_map(labels, (0, "Old"))
    for i, (entries, label) in enumerate([([(0, "Old")], "Old"), ([(0, "New")], "New"), ([(0, "New"), (0, "X")], "New"), ([(0, "Last")], "Last")]):
        write_map(labels, *entries)
        write_cdr(tmp_path / "in", f"{i}.csv", times((f"12:0{i}", 1)), order=i)
        drain(spark, NAME, tmp_path, str(labels))
        assert report(spark, tmp_path) == [("12:00", label, i + 1, i + 1.0)]


def test_update_mode_leaves_no_row_of_a_label_that_is_gone(spark, tmp_path):
    """Codes 0 and 1 share a window; their labels merge, then part again under other names."""
    labels = tmp_path / "map.csv"
    for i, (entries, want) in enumerate(
        [
            ([(0, "A"), (1, "B")], [("12:00", "A", 1, 1.0), ("12:00", "B", 1, 2.0)]),
            ([(0, "C"), (1, "C")], [("12:00", "C", 3, 4.0)]),
            ([(0, "D"), (1, "A")], [("12:00", "A", 1, 2.0), ("12:00", "D", 3, 3.0)]),
        ]
    ):
        write_map(labels, *entries)
        rows = [("2020/08/30 12:00:00", "0", 10)] + ([("2020/08/30 12:01:00", "1", 20)] if i == 0 else [])
        write_cdr(tmp_path / "in", f"{i}.csv", rows, order=i)
        drain(spark, NAME, tmp_path, str(labels), output_mode="update")
        assert report(spark, tmp_path, "update") == want
    tb.compact_report(spark, NAME, str(tmp_path / "out"), "update", checkpoint=str(tmp_path / "out-state"))
    assert report(spark, tmp_path, "update") == want


def test_a_map_without_a_good_version_stops_the_stream(spark, tmp_path):
    write_map(tmp_path / "map.csv", (0, "A"), (0, "B"))
    write_cdr(tmp_path / "in", "0.csv", times(("12:00", 1)))
    with pytest.raises(StreamingQueryException, match="2 rows for code 0"):
        drain(spark, NAME, tmp_path, str(tmp_path / "map.csv"))
    write_map(tmp_path / "map.csv", (0, "A"))
    drain(spark, NAME, tmp_path, str(tmp_path / "map.csv"))
    assert report(spark, tmp_path) == [("12:00", "A", 1, 1.0)]


def test_a_repeated_micro_batch_gets_the_map_it_had(spark, tmp_path):
    labels = tmp_path / "map.csv"
    write_map(labels, (0, "A"))
    folder = str(tmp_path / "maps")
    assert [tuple(r) for r in PaytypeMaps(spark, str(labels), folder).at(3)[0].collect()] == [(0, "A")]
    write_map(labels, (0, "Other"))
    maps = PaytypeMaps(spark, str(labels), folder)
    assert [tuple(r) for r in maps.at(3)[0].collect()] == [(0, "A")]
    assert [tuple(r) for r in maps.at(4)[0].collect()] == [(0, "Other")]
    assert [tuple(r) for r in maps.at(5)[0].collect()] == [(0, "Other")]
    labels.unlink()
    assert [tuple(r) for r in maps.at(6)[0].collect()] == [(0, "Other")] and maps.refused
    write_map(labels, (0, "Back"))
    assert [tuple(r) for r in maps.at(7)[0].collect()] == [(0, "Back")] and maps.refused is None
    # A copy that a driver left unfinished does not count.
    (tmp_path / "maps/from_batch=000000000007/_complete").unlink()
    assert [tuple(r) for r in PaytypeMaps(spark, str(labels), folder).at(7)[0].collect()] == [(0, "Back")]


def cdr_by_day(spark, tmp_path):
    used = driver.cdr_rows(spark, SMALL).select("RECORD_DATE", "PAYTYPE_515", "DEBIT_AMOUNT_42")
    rows = sorted(tuple(row) for row in used.collect())
    cut = len(rows) * 2 // 3  # within a day and within a window
    write_cdr(tmp_path / "old", "a.csv", rows[:cut])
    for i in range(3):
        write_cdr(tmp_path / "in", f"{i}.csv", rows[cut:][i::3], order=i)
        write_cdr(tmp_path / "whole", f"{i}.csv", rows[i::3], order=i)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_a_stream_goes_on_from_the_cells_of_a_batch(spark, paytypes, tmp_path, mode):
    cdr_by_day(spark, tmp_path)
    tb.save_cells(spark, str(tmp_path / "old"), str(tmp_path / "cells"))
    options = {"output_mode": mode, "trigger": {"availableNow": True}, "max_files": 1, "history": str(tmp_path / "cells"), "watermark": "90 days"}
    paths = (str(tmp_path / "in"), str(tmp_path / "all"), str(tmp_path / "state"))
    tb.stream_reports(spark, list(tb.REPORTS), *paths, paytypes, **options).awaitTermination()
    for name in tb.REPORTS:
        whole = sorted(map(str, tb.batch_report(name, tb.read_cdr(spark, str(tmp_path / "whole")), paytypes).collect()))
        got = sorted(map(str, tb.read_report(spark, name, str(tmp_path / "all" / name), mode).collect()))
        if mode == "complete":
            assert got == whole
        else:  # all that the stream has touched, whole
            old = sorted(map(str, tb.batch_report(name, tb.read_cdr(spark, str(tmp_path / "old")), paytypes).collect()))
            assert set(got) <= set(whole) and set(whole) - set(old) <= set(got)
    with pytest.raises(ValueError, match="history"):
        tb.stream_report(spark, "revenue_15min", *paths, history=str(tmp_path / "cells"), output_mode="append")


def test_a_single_report_goes_on_from_cells_with_other_state_partitions(spark, tmp_path):
    cdr_by_day(spark, tmp_path)
    tb.save_cells(spark, str(tmp_path / "old"), str(tmp_path / "cells"))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        drain(spark, "daily_revenue", tmp_path, history=str(tmp_path / "cells"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    whole = tb.batch_report("daily_revenue", tb.read_cdr(spark, str(tmp_path / "whole")))
    got = tb.read_report(spark, "daily_revenue", str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_archive_empties_the_folder_and_a_restart_is_exact(spark, tmp_path):
    count = 1000
    for i in range(count):
        write_cdr(tmp_path / "in", f"{i:04d}.csv", times((f"{i % 24:02d}:{i % 60:02d}", 1)), order=i)
    options = {"max_files": 250, "archive": str(tmp_path / "archive")}
    drain(spark, "daily_revenue", tmp_path, **options)
    for k in range(3):  # the last micro-batch's files leave with the next one
        write_cdr(tmp_path / "in", f"more{k}.csv", times(("03:00", 1)), order=count + k)
        drain(spark, "daily_revenue", tmp_path, **options)
    left = [p.name for p in (tmp_path / "in").glob("*.csv")]
    assert len(left) <= 2 and all(name.startswith("more") for name in left)
    assert len(list((tmp_path / "archive").rglob("*.csv"))) == count + 3 - len(left)
    read = tb.read_report(spark, "daily_revenue", str(tmp_path / "out")).collect()
    assert [(r.date, float(r.daily_revenue)) for r in read] == [("2020-08-30", count + 3.0)]


WRONG = {
    "bad": 2, "2020/8/30 0:00:00": 2, "2020-08-30 00:00:00": 2, "2020/08/30 00:01:02.5": 2,
    "2020/02/30 00:01:02": 2, "2020/08/30 24:00:00": 2, "": 1,
}


def test_rejects_by_cause(spark, ansi, tmp_path):
    write_cdr(tmp_path / "in", "a.csv", [row for row, _ in DIRTY] + [("bad", "x", "oops"), ("", "y", "NaN")])
    cells = tb.window_cells(tb.parse_cdr(tb.read_cdr(spark, str(tmp_path / "in"))))
    want = {}
    for (date, _, charge), kept in DIRTY:
        if kept is None:
            cause = WRONG.get(date, 0) + {"oops": 4, "": 4, "NaN": 8, "10000000000000": 8}.get(charge, 0)
            want[cause] = want.get(cause, 0) + 1
    want |= {2 + 4 + 16: 1, 1 + 8 + 16: 1}
    got = {r.cause: r for r in tb.run_counts_by_cause(cells).collect()}
    assert {cause: r.rejected_rows for cause, r in got.items()} == want
    assert got[22].reasons == "malformed time, no charge, malformed payment type" and got[1].reasons == "no time"
    counts = tb.run_counts(cells).first()
    assert sum(want.values()) == counts.rejected_rows


def test_causes_come_from_the_same_parse(spark):
    cells = tb.window_cells(tb.parse_cdr(driver.dirty_cdr_rows(spark, SMALL)))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp(") == 1 and plan.count("Exchange hashpartitioning") == 1
