"""The reports as Structured Streaming queries."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_cdr
from ..operators.label import label_paytype
from ..operators.measures import cell_keys, stream_cells
from ..operators.reports import Report, daily_revenue_closing, report_named
from ..sinks.report_files import parts_path, preview, refuse_parts, write_report
from ..sources.files import read_cdr_stream
from ..sources.paytype_map import PaytypeMaps
from ..workspace import ZONE, child_names, delete, job_session
from .cell_store import CellStore

INTAKE_METRICS = "cdr_intake"

_PARTITIONS = "spark.sql.shuffle.partitions"
#: State partitions by default, or twice the cores if that is more; never more than the shuffle partitions.
STATE_PARTITIONS = 32

_log = logging.getLogger(__name__)


def _write_batch(
    rows: DataFrame, path: str, report: Report, output_mode: str, batch_id: int, preview_rows: int, keep: int | None = None
) -> None:
    """Writes one micro-batch of a report; an empty one leaves what is there."""
    target = path
    if output_mode != "complete":
        # The query's id is that of its checkpoint, so a restart goes on in its own folder.
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        target, keep = f"{parts_path(path, output_mode)}/query_id={query_id}/batch_id={batch_id}", None
    written = write_report(rows, target, report.sort_by, keep=keep, empty=False)
    _log.info("%s, micro-batch %d: %d rows", report.name, batch_id, written)
    if preview_rows and written:
        preview(rows, report.sort_by, preview_rows).show(preview_rows, truncate=False)


def report_sink(
    path: str, report: Report, output_mode: str = "complete", preview_rows: int = 0, keep: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that writes a report's micro-batches as CSV.

    In complete mode each micro-batch is the whole result and replaces ``path``, as
    plain files or, with ``keep``, as a version (``write_report``). In append and
    update mode it is a part and goes to a folder of the mode, the query and the
    micro-batch beside it (``parts_path``), which no batch job or other query
    overwrites. A repeated micro-batch leaves the same files. An empty one writes
    nothing. The batch is computed once (persisted if it is shown as well); an error
    fails the query, which resumes from its checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not preview_rows:
            _write_batch(batch, path, report, output_mode, batch_id, 0, keep)
            return
        batch.persist()
        try:
            _write_batch(batch, path, report, output_mode, batch_id, preview_rows, keep)
        finally:
            batch.unpersist()

    return write


def _check_output(spark: SparkSession, path: str, output_mode: str, checkpoint: str) -> None:
    """ValueError if a start would replace a stream's parts or mix two queries' parts."""
    if output_mode == "complete":
        refuse_parts(spark, path)
        return
    own = None
    if "metadata" in child_names(spark, checkpoint):
        own = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
    folder = parts_path(path, output_mode)
    others = [name for name in child_names(spark, folder) if name.startswith("query_id=") and name != f"query_id={own}"]
    if others:
        raise ValueError(
            f"{folder} holds parts of another query ({others[0]}); "
            "go on with that query's checkpoint or choose another output"
        )


def streaming_report(
    name: str, cdr: DataFrame, paytype_map: DataFrame | None = None, watermark: str = "10 minutes"
) -> DataFrame:
    """A report over a stream of raw usage records, not yet started; a map is taken as it is now and joined to records."""
    report = report_named(name)
    rows = clean_cdr(cdr, metrics=INTAKE_METRICS).withWatermark("event_time", watermark)
    if report.labelled:
        if paytype_map is None:
            raise ValueError(f"report {name} needs a payment-type map")
        rows = label_paytype(rows, paytype_map)
    return report.build(rows)


def stream_report(
    spark: SparkSession,
    name: str,
    cdr_path: str,
    out_path: str,
    checkpoint: str,
    paytype_map: str | DataFrame | None = None,
    output_mode: str = "complete",
    watermark: str = "10 minutes",
    trigger: dict[str, object] | None = None,
    max_files: int | None = 5,
    zone: str | None = "UTC",
    query_name: str | None = None,
    preview_rows: int = 0,
    source_options: dict[str, object] | None = None,
    max_file_age: str | None = None,
    archive: str | None = None,
    keep: int | None = None,
    history: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Starts a report over the CSV files arriving in ``cdr_path``.

    ``complete`` (the default) counts every record however late, rewrites the
    whole report at ``out_path`` per trigger and keeps all windows in state. ``append``
    and ``update`` drop records whose window (in append mode of the daily report:
    whose day) the watermark has closed and forget that window; ``append`` writes a
    window once, when it closes. Their parts go to folders beside ``out_path``, one
    per query (``read_report`` reads them); a start that finds another query's parts
    there raises ValueError. In update mode a day never closes, so the daily report
    counts late records as complete mode does. ``keep`` makes complete reports
    versions (``write_report``), ``archive`` moves files that were read away
    (``read_cdr_stream``). ``trigger`` holds the arguments of
    ``DataStreamWriter.trigger``, 30 seconds of processing time by default. The query
    has a session of its own, in ``zone``.

    The labelled report keeps cells by code and joins labels to them per micro-batch.
    ``paytype_map`` is the map's path or a frame; a change of its files holds from the
    next micro-batch on, for all cells that this one reports. A map that repeats a
    code is refused and logged, and the one before stays in force (``PaytypeMaps``).

    ``history`` is a path of window cells of earlier records (``save_cells``): complete and
    update mode add them to what the stream has counted, so a stream goes on where a
    batch ended, or where another stream's state did, without reading records again.
    The watermark starts anew, and append mode, which has no earlier windows to give,
    takes none. The cells are read per micro-batch and must not change.

    Rows read and kept are in the progress under ``observedMetrics``; they are for
    monitoring, as a repeated task counts again. ``state_partitions`` is fixed at the
    first start on a checkpoint: 32 or twice the cores by default, at most
    ``spark.sql.shuffle.partitions``. Each task on the state sends the driver metrics of
    all its partitions, so what a micro-batch sends grows with their square.
    """
    report = report_named(name)
    session, cdr = _source(spark, [(report, out_path)], cdr_path, checkpoint, output_mode, zone, max_files, max_file_age, archive, source_options)
    if report.labelled or history is not None:
        cells = stream_cells(clean_cdr(cdr, metrics=INTAKE_METRICS).withWatermark("event_time", watermark))
        sink = _cell_sink(session, [(report, out_path)], checkpoint, paytype_map, output_mode, preview_rows, keep, history)
        return _started(session, cells, sink, output_mode, checkpoint, trigger, query_name, state_partitions)
    if output_mode == "append" and not report.windowed:
        stream = daily_revenue_closing(clean_cdr(cdr, metrics=INTAKE_METRICS), watermark, session.conf.get(ZONE))
    else:
        stream = streaming_report(name, cdr, watermark=watermark)
    return _started(session, stream, report_sink(out_path, report, output_mode, preview_rows, keep), output_mode, checkpoint, trigger, query_name, state_partitions)


def stream_reports(
    spark: SparkSession,
    names: Sequence[str],
    cdr_path: str,
    out_base: str,
    checkpoint: str,
    paytype_map: str | DataFrame | None = None,
    output_mode: str = "complete",
    watermark: str = "10 minutes",
    trigger: dict[str, object] | None = None,
    max_files: int | None = 5,
    zone: str | None = "UTC",
    query_name: str | None = None,
    preview_rows: int = 0,
    source_options: dict[str, object] | None = None,
    max_file_age: str | None = None,
    archive: str | None = None,
    keep: int | None = None,
    history: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Starts one query that keeps several reports, each at ``out_base/<report>``.

    The files are scanned once and one state of window cells serves all reports;
    labels are joined to cells. Modes and parts are those of ``stream_report``, with
    what follows from cells:

    - ``update``: changed cells say which windows and days to derive again, from cells
      that the query has written down (``CellStore``). The watermark closes windows for
      all reports, so the daily one drops late records too.
    - ``append``: a day is written when a window of a later day closes.
    """
    reports = [(report_named(name), f"{out_base.rstrip('/')}/{name}") for name in names]
    session, cdr = _source(spark, reports, cdr_path, checkpoint, output_mode, zone, max_files, max_file_age, archive, source_options)
    cells = stream_cells(clean_cdr(cdr, metrics=INTAKE_METRICS).withWatermark("event_time", watermark))
    sink = _cell_sink(session, reports, checkpoint, paytype_map, output_mode, preview_rows, keep, history)
    return _started(session, cells, sink, output_mode, checkpoint, trigger, query_name, state_partitions)


def _source(
    spark: SparkSession,
    reports: Sequence[tuple[Report, str]],
    cdr_path: str,
    checkpoint: str,
    output_mode: str,
    zone: str | None,
    max_files: int | None,
    max_file_age: str | None,
    archive: str | None,
    options: dict[str, object] | None,
) -> tuple[SparkSession, DataFrame]:
    """The session of a query and its stream of records, after a check of the outputs."""
    for _, path in reports:
        _check_output(spark, path, output_mode, checkpoint)
    session = job_session(spark, zone)
    return session, read_cdr_stream(session, cdr_path, max_files, max_file_age, archive, **(options or {}))


def _cell_sink(
    session: SparkSession,
    reports: Sequence[tuple[Report, str]],
    checkpoint: str,
    paytype_map: str | DataFrame | None,
    output_mode: str,
    preview_rows: int,
    keep: int | None,
    history: str | None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that derives and writes reports from a micro-batch of window cells.

    A micro-batch that is read more than once is written to the checkpoint first. Kept by
    ``persist`` it would stay a result of the state's tasks, and every job on it would
    have as many and send the driver their metrics again.
    """
    labelled = [report.name for report, _ in reports if report.labelled]
    if labelled and paytype_map is None:
        raise ValueError(f"report {labelled[0]} needs a payment-type map")
    if history is not None and output_mode == "append":
        raise ValueError("append mode takes no history")
    earlier = None if history is None else cell_keys(session.read.parquet(history))
    folder = checkpoint.rstrip("/")
    maps = PaytypeMaps(session, paytype_map, f"{folder}/paytype_maps") if labelled else None
    store = CellStore(session, f"{folder}/cells")

    kept: list[DataFrame] = []

    def inputs(batch: DataFrame, batch_id: int) -> dict[bool, DataFrame]:
        """The cells to derive reports from: those by window and those by day."""
        if output_mode == "append" and not all(report.windowed for report, _ in reports):
            return {True: batch, False: store.days_over(batch, batch_id)}
        if output_mode != "update":
            cells = batch if earlier is None else batch.unionByName(earlier)
            return {True: cells, False: cells}
        cells = store.merged(batch, batch_id).persist()  # read once for all reports
        kept.append(cells)
        cells = cells if earlier is None else cells.unionByName(earlier)
        # Merged, not broadcast: the keys are as many as the windows and days that changed.
        changed = {windowed: batch.select(key).distinct().hint("merge") for windowed, key in ((True, "bucket"), (False, "day"))}
        return {windowed: cells.join(keys, keys.columns, "left_semi") for windowed, keys in changed.items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        written = None
        try:
            if output_mode != "complete" or len(reports) > 1 or preview_rows:
                written = f"{folder}/micro_batch/{batch_id}"
                batch.write.mode("overwrite").parquet(written)
                batch = session.read.schema(batch.schema).parquet(written)
            # Also where no cell has closed: the map of the first micro-batch is the one to fall back on.
            labels, size = maps.at(batch_id) if maps else (None, None)
            if output_mode != "complete" and batch.isEmpty():
                _log.info("micro-batch %d: no cells", batch_id)
                return
            cells = inputs(batch, batch_id)
            for report, path in reports:
                rows = cells[report.windowed]
                if report.labelled:
                    rows = label_paytype(rows, labels, map_bytes=size)
                _write_batch(report.build(rows), path, report, output_mode, batch_id, preview_rows, keep)
        finally:
            for frame in kept:
                frame.unpersist()
            kept.clear()
            if written:
                delete(session, written)

    return write


def _started(
    session: SparkSession,
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    output_mode: str,
    checkpoint: str,
    trigger: dict[str, object] | None,
    query_name: str | None,
    state_partitions: int | None,
) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
    )
    writer = writer.queryName(query_name) if query_name else writer
    given = session.conf.get(_PARTITIONS)
    most = max(STATE_PARTITIONS, 2 * session.sparkContext.defaultParallelism)
    session.conf.set(_PARTITIONS, str(state_partitions or min(int(given), most)))
    try:
        return writer.start()  # copies the settings; jobs on the micro-batches keep those of the caller
    finally:
        session.conf.set(_PARTITIONS, given)
