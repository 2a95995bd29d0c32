"""Column expressions that type the raw charging fields.

Every expression is built in, stays on the JVM and turns malformed input into
null under either ANSI setting, so one bad line never fails a job or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats, lengths and scales that decide the reported figures.
RECORD_DATE_FORMAT = "yyyy/MM/dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
WINDOW_MINUTES = 15
DEBIT_TYPE = "decimal(14,2)"
DEBIT_DIVISOR = 10
AMOUNT_TYPE = "decimal(18,6)"
TOTAL_TYPE = "decimal(28,6)"

#: What can be wrong with a record. The last alone does not make it unusable. Text in place of a charge reads as none.
CAUSES = {
    1: "no time",
    2: "malformed time",
    4: "no charge",
    8: "charge out of range",
    16: "malformed payment type",
}

WINDOW_LENGTH = f"{WINDOW_MINUTES} minutes"
WINDOW_MICROS = WINDOW_MINUTES * 60 * 1_000_000

# A number as a lenient integer cast takes it: padding, sign, digits, fraction.
_PADDING = r"[\x00-\x20\x7f]*"
_NUMBER = rf"^{_PADDING}(?<sign>[+-]?)0*(?:(?<digits>[0-9]{{1,18}})(?:\.[0-9]*)?|\.[0-9]*){_PADDING}$"


def event_time(text: Column) -> Column:
    """Timestamp of a ``yyyy/MM/dd HH:mm:ss`` text in the session zone, else null."""
    return F.try_to_timestamp(text, F.lit(RECORD_DATE_FORMAT))


def paytype_code(text: Column) -> Column:
    """Integer code of a text; a fraction is cut off, anything else is null.

    One digit is read as such, which settles almost every row. Other texts go
    through a pattern first, so that no cast ever fails: a failing ``try_cast``
    raises and catches an error per row, far slower than the rest of the scan.
    """
    is_digit = (F.octet_length(text) == 1) & text.between("0", "9")
    # Sign, zero and digits: the zero stands in where there are no digits, as in ".5".
    number = F.regexp_replace(text, F.lit(_NUMBER), F.lit("${sign}0${digits}")).try_cast("bigint")
    in_range = text.rlike(_NUMBER) & number.between(-(2**31), 2**31 - 1)
    return F.when(is_digit, F.ascii(text) - F.ascii(F.lit("0"))).when(in_range, number.try_cast("int"))


def debit(value: Column) -> Column:
    """Charge as recorded: two decimals, rounded half up, null on overflow or NaN."""
    return value.try_cast(DEBIT_TYPE)


def cause(record_date: Column, time: Column, paytype_text: Column, paytype: Column, value: Column, recorded: Column) -> Column:
    """What is wrong with a record, as a sum of ``CAUSES``: its raw texts and charge beside what they were parsed to."""

    def empty(text: Column) -> Column:
        return text.isNull() | (F.trim(text) == "")

    found = {
        "no time": empty(record_date),
        "malformed time": ~empty(record_date) & time.isNull(),
        "no charge": value.isNull(),
        "charge out of range": value.isNotNull() & recorded.isNull(),
        "malformed payment type": ~empty(paytype_text) & paytype.isNull(),
    }
    return sum((F.when(found[name], bit).otherwise(0) for bit, name in CAUSES.items()), F.lit(0))


def amount(recorded: Column) -> Column:
    """Reported amount of a recorded charge (or of a minimum or maximum of them)."""
    return (recorded / DEBIT_DIVISOR).cast(AMOUNT_TYPE)


def total(recorded_sum: Column) -> Column:
    """Reported amount of a sum of recorded charges.

    Dividing the sum gives the same digits as summing divided charges, at one
    decimal division per group where the other way needs one per row.
    """
    return (recorded_sum / DEBIT_DIVISOR).cast(TOTAL_TYPE)


def day_key(time: Column) -> Column:
    """Calendar day in the session zone, as a date: a cheaper key than its text."""
    return F.to_date(time)


def day_text(day: Column) -> Column:
    """A calendar day as it is reported."""
    return F.date_format(day, DAY_FORMAT)


def bucket_start(time: Column, zone: str) -> Column:
    """Start of the part of a 15-minute window that lies within one local day.

    That is the window start itself wherever the zone's offset is a multiple of
    15 minutes. Other offsets (local mean times of the past) put a day boundary
    inside a window; the later part then starts at the day.
    """
    micros = F.unix_micros(time)
    window_start = F.timestamp_micros(micros - F.pmod(micros, F.lit(WINDOW_MICROS)))
    if zone in {"UTC", "GMT", "Z", "Etc/UTC", "Etc/GMT"}:
        return window_start
    return F.greatest(window_start, F.date_trunc("day", time))
