"""

The given tables hold no usage records, so these queries derive them from the
whole ``events`` table: its time as ``RECORD_DATE`` text, ``user_id % 3`` as the
payment type (2 has no label), ``value`` as the charge. Decimals leave as doubles.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

import tollbook as tb
from tollbook.sources.schema import CDR_SCHEMA
from tollbook.workspace import new_path

try:  # the subpackage is optional, and so is what its queries need
    import corpus_pipeline
    from tollbook.llm import queries as llm
except ImportError as missing:
    llm = None
    if missing.name not in ("corpus_pipeline", "tollbook.llm"):
        warnings.warn(f"the queries of tollbook.llm are left out: {missing}", stacklevel=1)

#: Files of the usage records, so that a stream has several micro-batches.
FILES = 8

SMOKE_DIR = "/root/testdata/sf0.001"

# The payment-type map.
PAYTYPES = [("0", "Prepaid"), ("1", "Postpaid")]

_written: dict[tuple[str, ...], object] = {}


def _once(spark: SparkSession, *key: str, make: Callable[[], object]) -> object:
    """The result of ``make``, made once per application and key."""
    full_key = (spark.sparkContext.applicationId, *key)
    if full_key not in _written:
        _written[full_key] = make()
    return _written[full_key]


def _as_cdr(rows: DataFrame, **fields: Column) -> DataFrame:
    """Usage records with the given fields; the other columns are null."""
    return rows.select(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CDR_SCHEMA]
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def cdr_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One usage record per event."""
    return _as_cdr(
        _events(spark, sf_dir),
        CDR_ID_1=F.col("event_id"),
        RECORD_DATE=F.date_format("ts", "yyyy/MM/dd HH:mm:ss"),
        PAYTYPE_515=F.col("user_id") % 3,
        DEBIT_AMOUNT_42=F.col("value"),
    )


def dirty_cdr_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One usage record per event, each event type with its own kind of dirt in it."""
    kind, low = F.col("event_type"), F.col("value") < 40
    good = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    code = (F.col("user_id") % 3).cast("string")
    return _as_cdr(
        _events(spark, sf_dir),
        CDR_ID_1=F.col("event_id"),
        RECORD_DATE=F.when((kind == "click") & low, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when((kind == "view") & low, F.concat(good, F.lit(".5")))
        .when((kind == "error") & low, F.lit("RECORD_DATE"))
        .otherwise(good),
        PAYTYPE_515=F.when(kind == "signup", F.concat(code, F.lit(".0")))
        .when(kind == "purchase", F.when(low, F.lit("x")).otherwise(F.lit("")))
        .otherwise(code),
        DEBIT_AMOUNT_42=F.when((kind == "signup") & low, F.lit(None))
        .when((kind == "view") & (F.col("value") >= 60), F.col("value") * 1e12)
        .when(kind == "purchase", -F.col("value"))
        .otherwise(F.col("value")),
    )


def _paytype_file(spark: SparkSession) -> str:
    """CSV file of the payment-type map, in the shared folder."""

    def write() -> str:
        path = new_path(spark, "paytypes")
        rows = spark.createDataFrame(PAYTYPES, "PayType string, value string")
        rows.coalesce(1).write.option("header", True).csv(path)
        return path

    return _once(spark, "paytypes", make=write)


def paytype_map(spark: SparkSession) -> DataFrame:
    """The payment-type map; the label join checks it."""
    return tb.read_paytype_map(spark, _paytype_file(spark), check=False)


def _labels_for(name: str, spark: SparkSession) -> DataFrame | None:
    return paytype_map(spark) if tb.REPORTS[name].labelled else None


def _cdr_files(spark: SparkSession, sf_dir: str) -> str:
    """Directory of at least eight CSV files, with header lines, of all usage records."""

    def write() -> str:
        path = new_path(spark, "cdr")
        cdr_rows(spark, sf_dir).repartition(FILES).write.option("header", True).csv(path)
        return path

    return _once(spark, "cdr", sf_dir, make=write)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for a comparison across engines."""
    return df.select(
        *[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes]
    )


def q_cdr_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(tb.clean_cdr(cdr_rows(spark, sf_dir)).select("event_time", "paytype", "debit_amount"))


def q_cdr_clean_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(tb.clean_cdr(dirty_cdr_rows(spark, sf_dir)).select("event_time", "paytype", "debit_amount"))


def q_run_counts_by_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unusable records by what is wrong with them."""
    return tb.run_counts_by_cause(tb.window_cells(tb.parse_cdr(dirty_cdr_rows(spark, sf_dir))))


def q_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.run_counts(tb.window_cells(tb.parse_cdr(dirty_cdr_rows(spark, sf_dir))))


def q_paytype_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = tb.clean_cdr(cdr_rows(spark, sf_dir)).select("event_time", "paytype", "debit_amount")
    return _plain(tb.label_paytype(clean, paytype_map(spark)))


def q_paytype_label_join_large_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join as it runs for a map that is too large to broadcast."""
    clean = tb.clean_cdr(cdr_rows(spark, sf_dir)).select("event_time", "paytype", "debit_amount")
    return _plain(tb.label_paytype(clean, paytype_map(spark), broadcast_bytes=0))


def q_report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(tb.batch_report(name, cdr_rows(spark, sf_dir), _labels_for(name, spark)))


def q_dirty_count_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(tb.batch_report("count_revenue_15min", dirty_cdr_rows(spark, sf_dir), paytype_map(spark)))


def q_report_preview(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    report = tb.batch_report(name, cdr_rows(spark, sf_dir), _labels_for(name, spark))
    return _plain(tb.preview(report, tb.REPORTS[name].sort_by))


def q_csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(tb.batch_report("revenue_15min", tb.read_cdr(spark, _cdr_files(spark, sf_dir))))


def _read_report(spark: SparkSession, name: str, path: str, mode: str = "complete") -> DataFrame:
    return _plain(tb.read_report(spark, name, path, mode))


def _batch_job(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    def run() -> tuple[str, dict[str, int]]:
        out = new_path(spark, "batch")
        return out, tb.run_batch(spark, _cdr_files(spark, sf_dir), _paytype_file(spark), out)

    return _once(spark, "batch", sf_dir, make=run)


def q_batch_job(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _batch_job(spark, sf_dir)
    return _read_report(spark, name, f"{out}/{name}")


def q_batch_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = _batch_job(spark, sf_dir)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


def _drain(spark: SparkSession, name: str, cdr_path: str, out: str, checkpoint: str, **options: object) -> StreamingQuery:
    """Runs a report stream over the files that are there now."""
    now = {"availableNow": True}
    labels = options.pop("labels", None) or (_paytype_file(spark) if tb.REPORTS[name].labelled else None)
    query = tb.stream_report(spark, name, cdr_path, out, checkpoint, labels, trigger=now, **options)
    query.awaitTermination()
    return query


def _drain_all(spark: SparkSession, cdr_path: str, out: str, checkpoint: str, **options: object) -> StreamingQuery:
    """Runs one stream of all reports over the files that are there now."""
    now, labels = {"availableNow": True}, _paytype_file(spark)
    query = tb.stream_reports(spark, list(tb.REPORTS), cdr_path, out, checkpoint, labels, trigger=now, **options)
    query.awaitTermination()
    return query


def _check_batches(query: StreamingQuery, least: int = 4) -> None:
    """RuntimeError if a stream that is to carry state from one micro-batch to the next had too few of them."""
    batches = sum(1 for progress in query.recentProgress if progress.numInputRows)
    if batches < least:
        raise RuntimeError(f"{batches} micro-batches instead of {least}")


def q_stream_report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report stream over the CSV files, a quarter of them per micro-batch."""
    cdr_path, out = _cdr_files(spark, sf_dir), new_path(spark, "stream")
    _check_batches(_drain(spark, name, cdr_path, out, new_path(spark, "state"), max_files=FILES // 4))
    return _read_report(spark, name, out)


def q_stream_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report stream whose micro-batches are versions; the newest is read."""
    cdr_path, out = _cdr_files(spark, sf_dir), new_path(spark, "stream")
    _check_batches(_drain(spark, "minmax_15min", cdr_path, out, new_path(spark, "state"), max_files=FILES // 4, keep=2))
    return _read_report(spark, "minmax_15min", out)


def q_stream_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named report stream with a processing-time trigger, stopped when it has read all files."""
    out = new_path(spark, "stream")
    query = tb.stream_report(
        spark,
        "revenue_15min",
        _cdr_files(spark, sf_dir),
        out,
        new_path(spark, "state"),
        trigger={"processingTime": "1 second"},
        max_files=None,
        query_name=f"named_{uuid4().hex}",
    )
    query.processAllAvailable()
    query.stop()
    return _read_report(spark, "revenue_15min", out)


def q_stream_all(name: str, mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the one stream that keeps all four.

    The files are in no order of time, so update mode allows records to be late by more than all of it.
    """

    def run() -> str:
        out, state = new_path(spark, "stream-all"), new_path(spark, "state")
        options = {"output_mode": mode, "watermark": "36500 days" if mode == "update" else "10 minutes"}
        _check_batches(_drain_all(spark, _cdr_files(spark, sf_dir), out, state, max_files=FILES // 4, **options))
        return out

    return _read_report(spark, name, f"{_once(spark, 'stream-all', mode, sf_dir, make=run)}/{name}", mode)


def _second() -> Column:
    return F.unix_timestamp("RECORD_DATE", "yyyy/MM/dd HH:mm:ss")


def _thirds(cdr: DataFrame) -> list[Column]:
    """Conditions for the first, second and last third of the time."""
    second = _second()
    low, high = cdr.agg(F.min(second), F.max(second)).first()
    first_cut, second_cut = low + (high - low) // 3, low + 2 * ((high - low) // 3)
    return [second < first_cut, (second >= first_cut) & (second < second_cut), second >= second_cut]


def q_stream_from_batch(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of a stream over the last two thirds of the time that goes on from the window cells of the first."""

    def run() -> str:
        cdr, old, new = cdr_rows(spark, sf_dir), new_path(spark, "old-cdr"), new_path(spark, "new-cdr")
        first, *rest = _thirds(cdr)
        cdr.filter(first).write.option("header", True).csv(old)
        cdr.filter(rest[0] | rest[1]).repartition(FILES).write.option("header", True).csv(new)
        cells, out = new_path(spark, "cells"), new_path(spark, "from-batch")
        tb.save_cells(spark, old, cells)
        _check_batches(_drain_all(spark, new, out, new_path(spark, "state"), max_files=FILES // 4, history=cells))
        return out

    return _read_report(spark, name, f"{_once(spark, 'from-batch', sf_dir, make=run)}/{name}")


def q_stream_map_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled stream whose map is rewritten under it: another label, then a code with two labels, then the right ones."""
    cdr, source, labels = cdr_rows(spark, sf_dir), new_path(spark, "map-cdr"), new_path(spark, "map")
    out, state = new_path(spark, "map-out"), new_path(spark, "map-state")
    for part, entries in zip(_thirds(cdr), [[("0", "Old")], [*PAYTYPES, ("0", "Twice")], PAYTYPES], strict=True):
        rows = spark.createDataFrame(entries, "PayType string, value string")
        rows.coalesce(1).write.mode("overwrite").option("header", True).csv(labels)
        cdr.filter(part).write.mode("append").option("header", True).csv(source)
        _drain(spark, "count_revenue_15min", source, out, state, labels=labels, max_files=None)
    return _read_report(spark, "count_revenue_15min", out)


def q_stream_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report stream whose last files carry a modification time a month before the others'."""
    cdr, source = cdr_rows(spark, sf_dir), new_path(spark, "old-cdr")
    out, state = new_path(spark, "old-out"), new_path(spark, "old-state")
    late = F.pmod(F.xxhash64("CDR_ID_1"), F.lit(4)) == 0
    for part in (~late, late):
        before = set(spark.read.text(source).inputFiles()) if part is late else set()
        cdr.filter(part).write.mode("append").option("header", True).csv(source)
        if part is late:
            month_ago = int((time.time() - 30 * 86_400) * 1000)
            for file in set(spark.read.text(source).inputFiles()) - before:
                path = spark._jvm.org.apache.hadoop.fs.Path(file)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(path, month_ago, -1)
        _drain(spark, "revenue_15min", source, out, state, max_files=None)
    return _read_report(spark, "revenue_15min", out)


def _run_late(name: str, mode: str, spark: SparkSession, sf_dir: str, out: str | None = None, fold: bool = False) -> str:
    """Three drops of files, the first third of the time last, each drained by a restarted query.

    By then the watermark is far past those records: append and update mode drop
    them, complete mode counts them. One drop is one micro-batch, however many files.
    With ``fold`` the parts are folded after each drop; ``all`` is the one stream of
    all reports.
    """
    cdr, source = cdr_rows(spark, sf_dir), new_path(spark, "late-cdr")
    out, state = out or new_path(spark, "late-out"), new_path(spark, "late-state")
    first, second, last = _thirds(cdr)
    for drop in (second, last, first):
        cdr.filter(drop).write.mode("append").option("header", True).csv(source)
        if name == "all":
            _drain_all(spark, source, out, state, output_mode=mode, max_files=None)
        else:
            _drain(spark, name, source, out, state, output_mode=mode, max_files=None)
        if fold:
            tb.compact_report(spark, name, out, mode, checkpoint=state)
    return out


def q_stream_late(name: str, mode: str, spark: SparkSession, sf_dir: str, fold: bool = False) -> DataFrame:
    """What a mode has written; in update mode the last value of each window."""
    return _read_report(spark, name, _run_late(name, mode, spark, sf_dir, fold=fold), mode)


def q_stream_all_late_append(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the one stream of all in append mode, over files of which some are late."""
    out = _once(spark, "all-late", sf_dir, make=lambda: _run_late("all", "append", spark, sf_dir))
    return _read_report(spark, name, f"{out}/{name}", "append")


def q_stream_append_beside_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of an append stream after a batch job has written to the same base."""
    base = new_path(spark, "shared-base")
    out = _run_late("revenue_15min", "append", spark, sf_dir, f"{base}/revenue_15min")
    tb.run_batch(spark, _cdr_files(spark, sf_dir), _paytype_file(spark), base)
    return _read_report(spark, "revenue_15min", out, "append")


def entry(spark: SparkSession) -> DataFrame:
    """Record count and revenue per 15-minute window and payment-type label."""
    return q_report("count_revenue_15min", spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query, by name."""
    return {
        "cdr_clean": q_cdr_clean,
        "cdr_clean_dirty": q_cdr_clean_dirty,
        "run_counts": q_run_counts,
        "run_counts_by_cause": q_run_counts_by_cause,
        "paytype_label_join": q_paytype_label_join,
        "paytype_label_join_large_map": q_paytype_label_join_large_map,
        **{name: partial(q_report, name) for name in tb.REPORTS},
        "dirty_count_revenue_15min": q_dirty_count_revenue,
        "report_preview": partial(q_report_preview, "revenue_15min"),
        "report_preview_daily": partial(q_report_preview, "daily_revenue"),
        "report_preview_count_revenue": partial(q_report_preview, "count_revenue_15min"),
        "csv_scan_roundtrip": q_csv_scan_roundtrip,
        **{f"batch_job_{name}": partial(q_batch_job, name) for name in tb.REPORTS},
        "batch_job_counts": q_batch_job_counts,
        **{f"stream_{name}": partial(q_stream_report, name) for name in tb.REPORTS},
        "stream_versions": q_stream_versions,
        **{f"stream_all_{name}": partial(q_stream_all, name, "complete") for name in tb.REPORTS},
        **{f"stream_all_update_{name}": partial(q_stream_all, name, "update") for name in tb.REPORTS},
        **{f"stream_all_late_append_{name}": partial(q_stream_all_late_append, name) for name in tb.REPORTS},
        **{f"stream_from_batch_{name}": partial(q_stream_from_batch, name) for name in tb.REPORTS},
        "stream_map_change": q_stream_map_change,
        "stream_named": q_stream_named,
        "stream_old_files": q_stream_old_files,
        "stream_late_complete": partial(q_stream_late, "revenue_15min", "complete"),
        "stream_late_append": partial(q_stream_late, "revenue_15min", "append"),
        "stream_late_append_minmax": partial(q_stream_late, "minmax_15min", "append"),
        "stream_late_append_count_revenue": partial(q_stream_late, "count_revenue_15min", "append"),
        "stream_late_append_daily": partial(q_stream_late, "daily_revenue", "append"),
        "stream_late_append_folded": partial(q_stream_late, "revenue_15min", "append", fold=True),
        "stream_late_update_folded": partial(q_stream_late, "revenue_15min", "update", fold=True),
        "stream_late_update": partial(q_stream_late, "revenue_15min", "update"),
        "stream_append_beside_batch": q_stream_append_beside_batch,
        **({**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}),
    }


_CDR = """cdr AS (
  SELECT date_trunc('second', ts) AS event_time, CAST(user_id % 3 AS INTEGER) AS paytype,
         CAST(CAST(value AS DECIMAL(14,2)) * 0.1 AS DECIMAL(18,6)) AS debit_amount
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL)"""

_LABELS = "labels_of(paytype, paytype_label) AS (VALUES (0, 'Prepaid'), (1, 'Postpaid'))"

_DIRTY = """dirty AS (
  SELECT CASE WHEN event_type = 'click' AND value < 40 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              WHEN event_type = 'view' AND value < 40 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') || '.5'
              WHEN event_type = 'error' AND value < 40 THEN 'RECORD_DATE'
              ELSE strftime(ts, '%Y/%m/%d %H:%M:%S') END AS record_date,
         CASE WHEN event_type = 'signup' THEN (user_id % 3) || '.0'
              WHEN event_type = 'purchase' THEN CASE WHEN value < 40 THEN 'x' ELSE '' END
              ELSE CAST(user_id % 3 AS VARCHAR) END AS paytype_text,
         CASE WHEN event_type = 'signup' AND value < 40 THEN NULL
              WHEN event_type = 'view' AND value >= 60 THEN value * 1e12
              WHEN event_type = 'purchase' THEN -value
              ELSE value END AS debit
  FROM events),
parsed AS (
  SELECT CASE WHEN regexp_full_match(record_date, '\\d{4}/\\d{2}/\\d{2} \\d{2}:\\d{2}:\\d{2}')
              THEN try_strptime(record_date, '%Y/%m/%d %H:%M:%S') END AS event_time,
         TRY_CAST(regexp_extract(paytype_text, '^([0-9]+)(\\.[0-9]*)?$', 1) AS INTEGER) AS paytype,
         CAST(TRY_CAST(debit AS DECIMAL(14,2)) * 0.1 AS DECIMAL(18,6)) AS debit_amount
  FROM dirty),
cdr AS (SELECT * FROM parsed WHERE event_time IS NOT NULL AND debit_amount IS NOT NULL)"""

_WINDOW = "time_bucket(INTERVAL '15 minutes', event_time) AS RECORD_DATE"

_CLEAN = """SELECT event_time, paytype, CAST(debit_amount AS DOUBLE) AS debit_amount FROM cdr"""

_LABEL_JOIN = f"""WITH {_CDR}, {_LABELS}
SELECT event_time, paytype, CAST(debit_amount AS DOUBLE) AS debit_amount, paytype_label
FROM cdr LEFT JOIN labels_of USING (paytype)"""

_REVENUE = f"""SELECT {_WINDOW}, paytype, CAST(sum(debit_amount) AS DOUBLE) AS revenue FROM cdr GROUP BY 1, 2"""

_COUNT_REVENUE = f"""SELECT {_WINDOW}, paytype_label AS Pay_type, count(*) AS record_count,
  CAST(sum(debit_amount) AS DOUBLE) AS revenue
FROM cdr LEFT JOIN labels_of USING (paytype) GROUP BY 1, 2"""

_REPORTS = {
    "daily_revenue": f"""WITH {_CDR}
SELECT strftime(event_time, '%Y-%m-%d') AS date, CAST(sum(debit_amount) AS DOUBLE) AS daily_revenue
FROM cdr GROUP BY 1""",
    "revenue_15min": f"WITH {_CDR} {_REVENUE}",
    "minmax_15min": f"""WITH {_CDR}
SELECT {_WINDOW}, paytype, CAST(min(debit_amount) AS DOUBLE) AS min_revenue,
  CAST(max(debit_amount) AS DOUBLE) AS max_revenue
FROM cdr GROUP BY 1, 2""",
    "count_revenue_15min": f"WITH {_CDR}, {_LABELS} {_COUNT_REVENUE}",
}

_BATCH_COUNTS = f"""WITH {_CDR}, {_LABELS},
windowed AS (SELECT {_WINDOW}, event_time, paytype, paytype_label FROM cdr LEFT JOIN labels_of USING (paytype))
SELECT (SELECT count(*) FROM events) AS input_rows,
       (SELECT count(*) FROM cdr) AS clean_rows,
       (SELECT count(*) FROM events) - (SELECT count(*) FROM cdr) AS rejected_rows,
       (SELECT count(*) FROM labels_of) AS map_rows,
       (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM windowed) AS daily_revenue,
       (SELECT count(*) FROM (SELECT DISTINCT RECORD_DATE, paytype FROM windowed)) AS revenue_15min,
       (SELECT count(*) FROM (SELECT DISTINCT RECORD_DATE, paytype FROM windowed)) AS minmax_15min,
       (SELECT count(*) FROM (SELECT DISTINCT RECORD_DATE, paytype_label FROM windowed)) AS count_revenue_15min"""

# Late records are those of the first third of the time. A window is closed once
# the watermark, 10 minutes behind the last event, has passed its end.
_ON_TIME = """span AS (SELECT CAST(min(epoch(event_time)) AS BIGINT) AS low, CAST(max(epoch(event_time)) AS BIGINT) AS high FROM cdr),
on_time AS (SELECT cdr.* FROM cdr, span WHERE epoch(event_time) >= low + (high - low) // 3)"""

_CLOSED = """HAVING time_bucket(INTERVAL '15 minutes', event_time) + INTERVAL '15 minutes'
  <= (SELECT max(event_time) FROM cdr) - INTERVAL '10 minutes'"""

_LATE_UPDATE = f"""WITH {_CDR}, {_ON_TIME}
SELECT {_WINDOW}, paytype, CAST(sum(debit_amount) AS DOUBLE) AS revenue
FROM on_time GROUP BY 1, 2"""

_LATE_APPEND = f"{_LATE_UPDATE} {_CLOSED}"

_LATE_APPEND_MINMAX = f"""WITH {_CDR}, {_ON_TIME}
SELECT {_WINDOW}, paytype, CAST(min(debit_amount) AS DOUBLE) AS min_revenue,
  CAST(max(debit_amount) AS DOUBLE) AS max_revenue
FROM on_time GROUP BY 1, 2 {_CLOSED}"""

_LATE_APPEND_COUNT = f"""WITH {_CDR}, {_LABELS}, {_ON_TIME}
SELECT {_WINDOW}, paytype_label AS Pay_type, count(*) AS record_count, CAST(sum(debit_amount) AS DOUBLE) AS revenue
FROM on_time LEFT JOIN labels_of USING (paytype) GROUP BY 1, 2 {_CLOSED}"""


_DAY = "strftime(event_time, '%Y-%m-%d') AS date, CAST(sum(debit_amount) AS DOUBLE) AS daily_revenue"

_LATE_APPEND_DAILY = f"""WITH {_CDR}, {_ON_TIME}
SELECT {_DAY} FROM on_time GROUP BY 1
HAVING CAST(date AS TIMESTAMP) + INTERVAL '1 day' <= (SELECT max(event_time) FROM cdr) - INTERVAL '10 minutes'"""

# From cells: a day is over once a window of a later day is closed.
_LATE_APPEND_DAILY_CELLS = f"""WITH {_CDR}, {_ON_TIME},
closed AS (SELECT {_WINDOW} FROM on_time GROUP BY time_bucket(INTERVAL '15 minutes', event_time) {_CLOSED})
SELECT {_DAY} FROM on_time GROUP BY 1 HAVING date < (SELECT strftime(max(RECORD_DATE), '%Y-%m-%d') FROM closed)"""

_CAUSES = f"""WITH {_DIRTY},
caused AS (
  SELECT CASE WHEN event_time IS NULL THEN 2 ELSE 0 END + CASE WHEN d.debit IS NULL THEN 4 ELSE 0 END
    + CASE WHEN d.debit IS NOT NULL AND TRY_CAST(d.debit AS DECIMAL(14,2)) IS NULL THEN 8 ELSE 0 END
    + CASE WHEN d.paytype_text <> '' AND paytype IS NULL THEN 16 ELSE 0 END AS cause
  FROM (SELECT row_number() OVER () AS id, * FROM dirty) d JOIN (SELECT row_number() OVER () AS id, * FROM parsed) USING (id)
  WHERE event_time IS NULL OR debit_amount IS NULL)
SELECT CAST(cause AS INTEGER) AS cause, count(*) AS rejected_rows,
  array_to_string(list_filter(
    [CASE WHEN cause & 2 > 0 THEN 'malformed time' END, CASE WHEN cause & 4 > 0 THEN 'no charge' END,
     CASE WHEN cause & 8 > 0 THEN 'charge out of range' END, CASE WHEN cause & 16 > 0 THEN 'malformed payment type' END],
    lambda reason: reason IS NOT NULL), ', ') AS reasons
FROM caused GROUP BY cause"""


def oracle_sql() -> dict[str, str]:
    """The DuckDB statement of every registered query."""
    return {
        "cdr_clean": f"WITH {_CDR} {_CLEAN}",
        "cdr_clean_dirty": f"WITH {_DIRTY} {_CLEAN}",
        "run_counts": f"""WITH {_DIRTY}
SELECT (SELECT count(*) FROM dirty) AS input_rows, (SELECT count(*) FROM cdr) AS clean_rows,
       (SELECT count(*) FROM parsed WHERE event_time IS NULL OR debit_amount IS NULL) AS rejected_rows""",
        "run_counts_by_cause": _CAUSES,
        "paytype_label_join": _LABEL_JOIN,
        "paytype_label_join_large_map": _LABEL_JOIN,
        **_REPORTS,
        "dirty_count_revenue_15min": f"WITH {_DIRTY}, {_LABELS} {_COUNT_REVENUE}",
        "report_preview": f"WITH {_CDR} {_REVENUE} ORDER BY RECORD_DATE, paytype NULLS FIRST LIMIT 10",
        "report_preview_daily": f"{_REPORTS['daily_revenue']} ORDER BY date LIMIT 10",
        "report_preview_count_revenue": f"WITH {_CDR}, {_LABELS} {_COUNT_REVENUE} ORDER BY RECORD_DATE, Pay_type NULLS FIRST LIMIT 10",
        "csv_scan_roundtrip": _REPORTS["revenue_15min"],
        **{f"batch_job_{name}": sql for name, sql in _REPORTS.items()},
        "batch_job_counts": _BATCH_COUNTS,
        **{f"stream_{name}": sql for name, sql in _REPORTS.items()},
        "stream_versions": _REPORTS["minmax_15min"],
        **{f"stream_all_{name}": sql for name, sql in _REPORTS.items()},
        **{f"stream_all_update_{name}": sql for name, sql in _REPORTS.items()},
        "stream_all_late_append_daily_revenue": _LATE_APPEND_DAILY_CELLS,
        "stream_all_late_append_revenue_15min": _LATE_APPEND,
        "stream_all_late_append_minmax_15min": _LATE_APPEND_MINMAX,
        "stream_all_late_append_count_revenue_15min": _LATE_APPEND_COUNT,
        **{f"stream_from_batch_{name}": sql for name, sql in _REPORTS.items()},
        "stream_map_change": _REPORTS["count_revenue_15min"],
        "stream_named": _REPORTS["revenue_15min"],
        "stream_old_files": _REPORTS["revenue_15min"],
        "stream_late_complete": _REPORTS["revenue_15min"],
        "stream_late_append": _LATE_APPEND,
        "stream_late_append_minmax": _LATE_APPEND_MINMAX,
        "stream_late_append_count_revenue": _LATE_APPEND_COUNT,
        "stream_late_append_daily": _LATE_APPEND_DAILY,
        "stream_late_append_folded": _LATE_APPEND,
        "stream_late_update_folded": _LATE_UPDATE,
        "stream_late_update": _LATE_UPDATE,
        "stream_append_beside_batch": _LATE_APPEND,
        **(llm.oracle_sql() if llm else {}),
    }
