"""What the streams send the driver: no state task runs twice, and nothing grows with the days of a micro-batch."""

from __future__ import annotations

import pytest

import tollbook as tb
from fixtures import write_cdr
from tollbook.streaming import report_stream

KEY = "spark.sql.shuffle.partitions"


def sixty_days(tmp_path, folder="in"):
    """Three files, each with records of all sixty days."""
    days = [f"2020/{7 + i // 30:02d}/{1 + i % 30:02d}" for i in range(60)]
    for i in range(3):
        write_cdr(tmp_path / folder, f"{i}.csv", [(f"{day} {h:02d}:00:00", str(h % 2), 10 + i) for day in days for h in (1, 13)], order=i)


def drain(spark, names, tmp_path, labels=None, **options):
    paths = (str(tmp_path / "in"), str(tmp_path / "all"), str(tmp_path / "state"))
    query = tb.stream_reports(spark, names, *paths, labels, trigger={"availableNow": True}, max_files=1, **options)
    query.awaitTermination()
    return query


@pytest.fixture
def plans(monkeypatch):
    """The plans of the written micro-batches by report."""
    seen = []
    whole = report_stream._write_batch

    def write(rows, path, report, *args):
        seen.append((report.name, rows._jdf.queryExecution().toString()))
        whole(rows, path, report, *args)

    monkeypatch.setattr(report_stream, "_write_batch", write)
    return seen


@pytest.mark.parametrize(("given", "partitions"), [(None, None), (2, 2)])
def test_state_partitions_do_not_follow_those_of_shuffles(spark, tmp_path, given, partitions):
    write_cdr(tmp_path / "in", "a.csv", [("2020/08/30 00:01:00", "0", 10)])
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "200")
    try:
        query = drain(spark, ["revenue_15min"], tmp_path, state_partitions=given)
    finally:
        spark.conf.set(KEY, before)
    most = partitions or max(report_stream.STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    assert {op.numShufflePartitions for p in query.recentProgress for op in p.stateOperators} == {most}


def test_reports_of_a_micro_batch_do_not_run_its_state_tasks_again(spark, tmp_path, paytypes, plans):
    sixty_days(tmp_path)
    drain(spark, list(tb.REPORTS), tmp_path, paytypes)
    assert len(plans) == 3 * len(tb.REPORTS)
    assert not [name for name, plan in plans if "ExistingRDD" in plan]
    assert not list((tmp_path / "state/micro_batch").iterdir())
    for name in tb.REPORTS:
        want = tb.batch_report(name, tb.read_cdr(spark, str(tmp_path / "in")), paytypes)
        got = tb.read_report(spark, name, str(tmp_path / "all" / name))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_stream_from_cells_does_not_run_its_state_tasks_again(spark, tmp_path, paytypes, plans):
    sixty_days(tmp_path)
    sixty_days(tmp_path, "old")
    tb.save_cells(spark, str(tmp_path / "old"), str(tmp_path / "cells"))
    drain(spark, list(tb.REPORTS), tmp_path, paytypes, history=str(tmp_path / "cells"))
    assert not [name for name, plan in plans if "ExistingRDD" in plan]
    for name in tb.REPORTS:
        cdr = tb.read_cdr(spark, [str(tmp_path / "in"), str(tmp_path / "old")])
        got = tb.read_report(spark, name, str(tmp_path / "all" / name))
        assert sorted(map(str, got.collect())) == sorted(map(str, tb.batch_report(name, cdr, paytypes).collect()))


def test_updates_of_many_days_broadcast_no_keys_and_keep_few_folders(spark, tmp_path, paytypes, plans):
    sixty_days(tmp_path)
    drain(spark, list(tb.REPORTS), tmp_path, paytypes, output_mode="update", watermark="90 days")
    joins = [line for _, plan in plans for line in plan.splitlines() if "Join" in line and "LeftSemi" in line and "[" in line]
    assert not [line for line in joins if "Broadcast" in line]
    assert sorted(p.name for p in (tmp_path / "state/cells").glob("on=*")) == ["on=2020-07", "on=2020-08"]
    for name in tb.REPORTS:
        want = tb.batch_report(name, tb.read_cdr(spark, str(tmp_path / "in")), paytypes)
        got = tb.read_report(spark, name, str(tmp_path / "all" / name), "update")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_days_that_close_at_once_are_kept_in_one_folder(spark, tmp_path):
    """Two thirds of the days close with the first file; the last one stays open over micro-batches and a restart.

    Of that day the second file holds one record that is late and one that counts.
    """
    days = [f"2020/{7 + i // 30:02d}/{1 + i % 30:02d}" for i in range(60)]
    files = [days[:40], days[39:50], days[50:]]
    for i, some in enumerate(files):
        write_cdr(tmp_path / "in", f"{i}.csv", [(f"{day} {h + 2 * i:02d}:00:00", "0", 10) for day in some for h in (1, 13)], order=i)
        drain(spark, ["daily_revenue", "revenue_15min"], tmp_path, output_mode="append")
    kept = sorted(str(p.relative_to(tmp_path / "state/cells")) for p in (tmp_path / "state/cells").rglob("*") if p.is_dir())
    assert kept[0] == "open" and 2 <= len(kept) <= 3
    got = tb.read_report(spark, "daily_revenue", str(tmp_path / "all/daily_revenue"), "append")
    want = {day.replace("/", "-"): (3 if day == days[39] else 2) for day in days[:-1]}
    assert {row.date: int(row.daily_revenue) for row in got.collect()} == want and got.count() == len(want)


def test_cells_that_an_earlier_version_kept_by_day_are_refused(spark, tmp_path):
    (tmp_path / "state/cells/on=2020-08-30/batch=0").mkdir(parents=True)
    write_cdr(tmp_path / "in", "a.csv", [("2020/08/30 00:01:00", "0", 10)])
    with pytest.raises(ValueError, match="cells by day"):
        drain(spark, ["revenue_15min"], tmp_path, output_mode="update")
