"""Command line of the jobs, for ``spark-submit run_reports.py``."""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .operators.reports import REPORTS
from .plans.batch import run_batch
from .sinks import compact_report
from .sources.object_store import s3a_conf
from .streaming.report_stream import stream_report, stream_reports

ALL = "all"

_log = logging.getLogger(__name__)

# Names and defaults of the environment variables that set the options.
INPUT = ("INPUT_DIR", None)
PAYTYPE_MAP = ("REF_MAP_PATH", None)
OUTPUT = ("OUTPUT_BASE", None)
CHECKPOINTS = ("CHECKPOINT_BASE", None)
TRIGGER = ("TRIGGER_INTERVAL", "30 seconds")
WATERMARK = ("WATERMARK_DELAY", "10 minutes")
USE_STORE = ("USE_MINIO", "false")
STORE_ENDPOINT = ("MINIO_ENDPOINT", None)
STORE_ACCESS = ("MINIO_ACCESS", None)
STORE_SECRET = ("MINIO_SECRET", None)


def _option(parser: argparse.ArgumentParser, flag: str, variable: tuple[str, str | None], text: str) -> None:
    name, fallback = variable
    value = os.environ.get(name, fallback)
    parser.add_argument(flag, default=value, required=value is None, help=f"{text} [{name}]")


def parser() -> argparse.ArgumentParser:
    """The command line; an option without a default is needed unless its variable is set."""
    top = argparse.ArgumentParser(prog="run_reports.py", description="Revenue reports over usage records")
    jobs = top.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="all reports over a directory of files")
    _option(batch, "--input", INPUT, "directory of usage record files")
    _option(batch, "--map", PAYTYPE_MAP, "payment-type map file")
    _option(batch, "--output", OUTPUT, "directory of the report directories")
    batch.add_argument("--files", type=int, default=1, help="files of each report")
    batch.add_argument("--scratch", help="shared directory for the run's own data; by default below the output")

    stream = jobs.add_parser("stream", help="reports over arriving files, until stopped; several share one scan")
    stream.add_argument("report", nargs="+", choices=[*REPORTS, ALL])
    _option(stream, "--input", INPUT, "directory in which files arrive")
    _option(stream, "--output", OUTPUT, "directory of the report directories")
    _option(stream, "--checkpoints", CHECKPOINTS, "directory of the checkpoint directories")
    _option(stream, "--trigger", TRIGGER, "time between micro-batches")
    _option(stream, "--watermark", WATERMARK, "time a record may be late, in append and update mode")
    stream.add_argument("--map", default=os.environ.get(PAYTYPE_MAP[0]), help=f"payment-type map file [{PAYTYPE_MAP[0]}]")
    stream.add_argument("--mode", choices=["complete", "append", "update"], default="complete")
    stream.add_argument("--max-files", type=int, default=5, help="most files of a micro-batch")
    stream.add_argument("--max-file-age", help="leave out files older than the newest by this much")
    stream.add_argument("--archive", help="directory to which files move once they are read")
    stream.add_argument("--max-bytes", help="most bytes of a micro-batch, such as 200g; replaces --max-files")
    stream.add_argument("--available-now", action="store_true", help="stop after the files that are there now")
    stream.add_argument("--preview", type=int, default=0, metavar="N", help="print N rows of each result")

    compact = jobs.add_parser("compact", help="fold the finished parts of append or update streams")
    compact.add_argument("report", nargs="+", choices=[*REPORTS, ALL])
    _option(compact, "--output", OUTPUT, "directory of the report directories")
    compact.add_argument("--mode", choices=["append", "update"], required=True)
    compact.add_argument("--files", type=int, default=1, help="files of each fold")

    for job in (batch, stream):
        job.add_argument("--versions", type=int, metavar="N", help="replace reports by versions and keep N earlier ones")
        job.add_argument("--zone", default="UTC", help="time zone of records and days")
    return top


def store_conf() -> dict[str, str]:
    """Object-store settings of the environment, none unless they are switched on."""
    if os.environ.get(*USE_STORE).lower() != "true":
        return {}
    missing = [name for name, _ in (STORE_ENDPOINT, STORE_ACCESS, STORE_SECRET) if not os.environ.get(name)]
    if missing:
        raise ValueError(f"{USE_STORE[0]} is set, so these are needed: {', '.join(missing)}")
    endpoint = os.environ[STORE_ENDPOINT[0]]
    return s3a_conf(
        endpoint, os.environ[STORE_ACCESS[0]], os.environ[STORE_SECRET[0]], ssl=endpoint.startswith("https:")
    )


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("tollbook")
    for key, value in store_conf().items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Runs the job of a parsed command line."""
    output = args.output.rstrip("/")
    if args.job == "batch":
        options = {"zone": args.zone, "files": args.files, "scratch": args.scratch, "keep": args.versions}
        print(json.dumps(run_batch(spark, args.input, args.map, output, **options)))
        return
    names = list(REPORTS) if ALL in args.report else list(dict.fromkeys(args.report))
    if args.job == "compact":
        for name in names:
            print(json.dumps({name: compact_report(spark, name, f"{output}/{name}", args.mode, args.files)}))
        return
    labelled = [name for name in names if REPORTS[name].labelled]
    if labelled and not args.map:
        raise ValueError(f"report {labelled[0]} needs --map or {PAYTYPE_MAP[0]}")
    label = ALL if ALL in args.report else "-".join(names)
    options = {
        "paytype_map": args.map if labelled else None,
        "output_mode": args.mode,
        "watermark": args.watermark,
        "trigger": {"availableNow": True} if args.available_now else {"processingTime": args.trigger},
        "max_files": None if args.max_bytes else args.max_files,
        "source_options": {"maxBytesPerTrigger": args.max_bytes} if args.max_bytes else None,
        "max_file_age": args.max_file_age,
        "archive": args.archive,
        "zone": args.zone,
        "query_name": f"{label}_stream",
        "preview_rows": args.preview,
        "keep": args.versions,
    }
    checkpoint = f"{args.checkpoints.rstrip('/')}/{label}"
    if len(names) > 1:
        query = stream_reports(spark, names, args.input, output, checkpoint, **options)
    else:
        query = stream_report(spark, names[0], args.input, f"{output}/{names[0]}", checkpoint, **options)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        # The checkpoint has every finished micro-batch; the next start repeats the one that this cuts off.
        _log.info("stopping %s", label)
        query.stop()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Entry point; stops the session only where it started one."""
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.WARNING, format="%(asctime)s %(message)s")
    logging.getLogger("tollbook").setLevel(logging.INFO)  # rows of each micro-batch
    session = spark or _session()
    try:
        run(session, args)
    finally:
        if spark is None:
            session.stop()
