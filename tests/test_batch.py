from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

import __spark_entry__ as driver
import tollbook as tb
from conftest import SMALL
from fixtures import DIRTY, report_lines, write_cdr
from tollbook import workspace


@pytest.fixture
def map_file(tmp_path):
    (tmp_path / "map.csv").write_text("PayType,value\n0,Prepaid\n1,Postpaid\n")
    return str(tmp_path / "map.csv")


ROWS = [
    ("2020/08/30 00:16:00", "1", 40),
    ("2020/08/30 00:01:00", "0", 10.5),
    ("2020/08/30 00:02:00", "1", 20),
    ("2020/08/31 00:00:00", "9", -5),
    ("2020/08/31 00:00:01", "9", 0),
    ("2020/08/30 00:14:59", "0", 30),
]


def test_written_reports_byte_for_byte(spark, ansi, tmp_path, map_file):
    write_cdr(tmp_path / "in", "a.csv", ROWS[:2])
    write_cdr(tmp_path / "in", "b.csv", [*ROWS[2:], ("bad", "0", 1)])
    counts = tb.run_batch(spark, str(tmp_path / "in"), map_file, str(tmp_path / "out") + "/")
    assert report_lines(tmp_path / "out/daily_revenue") == [
        "date,daily_revenue",
        "2020-08-30,10.050000",
        "2020-08-31,-0.500000",
    ]
    assert report_lines(tmp_path / "out/revenue_15min") == [
        "RECORD_DATE,paytype,revenue",
        "2020-08-30T00:00:00.000Z,0,4.050000",
        "2020-08-30T00:00:00.000Z,1,2.000000",
        "2020-08-30T00:15:00.000Z,1,4.000000",
        "2020-08-31T00:00:00.000Z,9,-0.500000",
    ]
    assert report_lines(tmp_path / "out/minmax_15min") == [
        "RECORD_DATE,paytype,min_revenue,max_revenue",
        "2020-08-30T00:00:00.000Z,0,1.050000,3.000000",
        "2020-08-30T00:00:00.000Z,1,2.000000,2.000000",
        "2020-08-30T00:15:00.000Z,1,4.000000,4.000000",
        "2020-08-31T00:00:00.000Z,9,-0.500000,0.000000",
    ]
    assert report_lines(tmp_path / "out/count_revenue_15min") == [
        "RECORD_DATE,Pay_type,record_count,revenue",
        "2020-08-30T00:00:00.000Z,Postpaid,1,2.000000",
        "2020-08-30T00:00:00.000Z,Prepaid,2,4.050000",
        "2020-08-30T00:15:00.000Z,Postpaid,1,4.000000",
        "2020-08-31T00:00:00.000Z,,2,-0.500000",
    ]
    for name in tb.REPORTS:
        assert len(list((tmp_path / "out" / name).glob("part-*.csv"))) == 1
    assert counts == {
        "input_rows": 7,
        "clean_rows": 6,
        "rejected_rows": 1,
        "map_rows": 2,
        "daily_revenue": 2,
        "revenue_15min": 4,
        "minmax_15min": 4,
        "count_revenue_15min": 4,
    }


def test_second_run_replaces_the_first(spark, tmp_path, map_file):
    for rows in (ROWS, ROWS[:1]):
        folder = tmp_path / f"in{len(rows)}"
        write_cdr(folder, "a.csv", rows)
        tb.run_batch(spark, str(folder), map_file, str(tmp_path / "out"))
    assert report_lines(tmp_path / "out/daily_revenue") == ["date,daily_revenue", "2020-08-30,4.000000"]


def test_no_usable_rows_leave_header_only_reports(spark, tmp_path, map_file):
    write_cdr(tmp_path / "in", "a.csv", [row for row, kept in DIRTY if not kept])
    counts = tb.run_batch(spark, str(tmp_path / "in"), map_file, str(tmp_path / "out"))
    assert counts["clean_rows"] == 0 and counts["revenue_15min"] == 0
    assert report_lines(tmp_path / "out/revenue_15min") == ["RECORD_DATE,paytype,revenue"]


def test_zone_decides_the_day_and_the_session_keeps_its_own(spark, tmp_path, map_file):
    write_cdr(tmp_path / "in", "a.csv", [("2020/08/30 23:30:00", "0", 10)])
    tb.run_batch(spark, str(tmp_path / "in"), map_file, str(tmp_path / "out"), zone="Asia/Kathmandu")
    assert report_lines(tmp_path / "out/revenue_15min")[1] == "2020-08-30T23:30:00.000+05:45,0,1.000000"
    assert report_lines(tmp_path / "out/daily_revenue")[1] == "2020-08-30,1.000000"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_errors_are_raised(spark, tmp_path, map_file):
    with pytest.raises(AnalysisException):
        tb.run_batch(spark, str(tmp_path / "missing"), map_file, str(tmp_path / "out"))
    write_cdr(tmp_path / "in", "a.csv", ROWS)
    (tmp_path / "twice.csv").write_text("PayType,value\n0,A\n0,B\n")
    with pytest.raises(ValueError, match="repeats a code"):
        tb.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "twice.csv"), str(tmp_path / "out"))


def test_large_report_is_many_files_that_read_in_order(spark, tmp_path):
    report = spark.range(1000).selectExpr("id * 37 % 1000 AS date", "id AS daily_revenue").repartition(7)
    assert tb.write_report(report, str(tmp_path / "r"), ["date"], files=4) == 1000
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 4
    assert [int(x.split(",")[0]) for x in report_lines(tmp_path / "r")[1:]] == list(range(1000))


def test_report_that_is_not_saved_reads_its_input_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    for files in (1, 3):
        before = read.value
        cdr = driver.cdr_rows(spark, SMALL)
        report = tb.batch_report("revenue_15min", cdr.mapInArrow(counted, cdr.schema))
        assert tb.write_report(report, str(tmp_path / f"r{files}"), ["RECORD_DATE", "paytype"], files=files) > 0
        assert read.value - before == cdr.count()


def test_batch_needs_no_scratch_setting_and_leaves_nothing(spark, tmp_path, map_file):
    write_cdr(tmp_path / "in", "a.csv", ROWS)
    for k, options in enumerate(({}, {"scratch": str(tmp_path / "scratch")})):
        tb.run_batch(spark, str(tmp_path / "in"), map_file, str(tmp_path / f"out{k}"), **options)
        assert sorted(p.name for p in (tmp_path / f"out{k}").iterdir()) == sorted(tb.REPORTS)
    assert list((tmp_path / "scratch").iterdir()) == []


def test_scratch_of_a_cluster_without_a_setting_is_below_the_output():
    assert workspace.scratch_path(FakeSession("yarn"), "cells", None, "hdfs://out/").startswith("hdfs://out/_scratch/cells-")
    assert workspace.scratch_path(FakeSession("yarn"), "cells", "hdfs://s", "hdfs://out").startswith("hdfs://s/cells-")


def test_jobs_at_once_keep_their_own_zones(spark, tmp_path, map_file):
    write_cdr(tmp_path / "in", "a.csv", [(f"2020/08/30 {h:02}:20:00", "0", 10) for h in range(24)])

    def run(zone, name):
        tb.run_batch(spark, str(tmp_path / "in"), map_file, str(tmp_path / name), zone=zone)
        return [report_lines(tmp_path / name / report) for report in tb.REPORTS]

    zones = ["UTC", "Asia/Kathmandu"]
    serial = [run(zone, f"serial-{k}") for k, zone in enumerate(zones)]
    for turn in range(3):
        with ThreadPoolExecutor(2) as pool:
            together = pool.map(run, zones, [f"together-{turn}-{k}" for k in range(2)])
            assert list(together) == serial
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_job_session_takes_runtime_settings(spark, ansi):
    own = workspace.job_session(spark, "Asia/Kathmandu")
    assert own.conf.get("spark.sql.ansi.enabled") == ansi
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert own.conf.get("spark.sql.session.timeZone") == "Asia/Kathmandu"


def test_batch_refuses_a_folder_of_parts(spark, tmp_path, map_file):
    write_cdr(tmp_path / "in", "a.csv", ROWS)
    (tmp_path / "out/revenue_15min/batch_id=3").mkdir(parents=True)
    with pytest.raises(ValueError, match="parts"):
        tb.run_batch(spark, str(tmp_path / "in"), map_file, str(tmp_path / "out"))
    assert (tmp_path / "out/revenue_15min/batch_id=3").exists()


def test_nulls_sort_first(spark, tmp_path):
    report = spark.createDataFrame([(1, None), (1, 2), (None, 5)], "a int, b int")
    tb.write_report(report, str(tmp_path / "r"), ["a", "b"])
    assert report_lines(tmp_path / "r") == ["a,b", ",5", "1,", "1,2"]


def test_preview_is_the_head_of_the_sorted_report(spark):
    report = spark.range(50).selectExpr("50 - id AS date", "id AS daily_revenue")
    assert [r.date for r in tb.preview(report, ["date"]).collect()] == list(range(1, 11))
    assert tb.preview(report, ["date"], 3).count() == 3


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class FakeSession:
    """A session as far as the shared folder is concerned."""

    def __init__(self, master, **settings):
        self.sparkContext = SimpleNamespace(master=master, applicationId="fake")
        self.conf = FakeConf(settings)


def test_shared_folder_comes_from_the_session(spark):
    named = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert workspace.shared_dir(named) == "hdfs://shared"
    assert workspace.new_path(named, "x").startswith("hdfs://shared/x-")
    assert workspace.shared_dir(spark) == workspace.shared_dir(spark)
    assert workspace.new_path(spark, "x") != workspace.new_path(spark, "x")


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_dir(FakeSession("yarn"))


def test_s3a_settings():
    conf = tb.s3a_conf("http://store:9000", "key", "secret")
    assert conf == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.access.key": "key",
        "spark.hadoop.fs.s3a.secret.key": "secret",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    }
    assert tb.s3a_conf("e", "k", "s", ssl=True)["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
