"""Usage record files for tests."""

from __future__ import annotations

import os
from contextlib import contextmanager
from pathlib import Path

from tollbook.sources.schema import CDR_COLUMNS

HEADER = ",".join(CDR_COLUMNS)

# (RECORD_DATE, PAYTYPE_515, DEBIT_AMOUNT_42) and the cleaned row, or None where it is dropped.
DIRTY = [
    (("bad", "0", "5"), None),
    (("2020/08/30 00:03:00", "0", "oops"), None),
    (("2020/8/30 0:00:00", "0", "5"), None),
    (("2020-08-30 00:00:00", "0", "5"), None),
    (("2020/08/30 00:01:02.5", "0", "5"), None),
    (("2020/02/30 00:01:02", "0", "5"), None),
    (("2020/08/30 24:00:00", "0", "5"), None),
    (("2020/08/30 00:01:00", "0", "10000000000000"), None),
    (("2020/08/30 00:01:00", "0", "NaN"), None),
    (("2020/08/30 00:01:00", "0", ""), None),
    (("", "0", "5"), None),
    (("2020/08/30 12:01:00", "7", "10"), ("2020-08-30 12:01:00", 7, "1.000000")),
    (("2020/08/30 12:01:00", "", "20"), ("2020-08-30 12:01:00", None, "2.000000")),
    (("2020/08/30 12:01:00", "x", "20"), ("2020-08-30 12:01:00", None, "2.000000")),
    (("2020/08/30 12:01:00", "1.0", "20"), ("2020-08-30 12:01:00", 1, "2.000000")),
    (("2020/08/30 00:01:00", "0", "2.675"), ("2020-08-30 00:01:00", 0, "0.268000")),
    (("2020/08/30 00:01:00", "0", "-0.005"), ("2020-08-30 00:01:00", 0, "-0.001000")),
    (("2020/08/30 00:14:59", "0", "999999999999.99"), ("2020-08-30 00:14:59", 0, "99999999999.999000")),
    (("2020/08/30 00:15:00", "1", "-5450000"), ("2020-08-30 00:15:00", 1, "-545000.000000")),
]


def line(record_date: str, paytype: str, debit: object) -> str:
    given = {"RECORD_DATE": record_date, "PAYTYPE_515": paytype, "DEBIT_AMOUNT_42": debit}
    return ",".join(str(given.get(name, "0")) for name in CDR_COLUMNS)


def write_cdr(directory: Path, name: str, rows: list[tuple[str, str, object]], order: int = 0, header: bool = True) -> None:
    """One file of records; ``order`` sets the modification time, which a stream reads by."""
    directory.mkdir(parents=True, exist_ok=True)
    lines = [HEADER] if header else []
    staged = directory / f".{name}"
    staged.write_text("\n".join(lines + [line(*row) for row in rows]) + "\n")
    stamp = 1_700_000_000 + order
    os.utime(staged, (stamp, stamp))
    staged.rename(directory / name)


@contextmanager
def session_zone(spark, zone: str):
    """Runs a block under a session time zone."""
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, zone)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def report_lines(directory: Path) -> list[str]:
    """Text lines of a written report, its files in name order and one header line."""
    parts = sorted(directory.rglob("part-*.csv"))
    texts = [part.read_text().splitlines() for part in parts]
    return texts[0] + [row for text in texts[1:] for row in text[1:]]
