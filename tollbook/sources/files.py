"""CSV sources: usage records (bounded or arriving) and the payment-type map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import paytype_code
from .schema import CDR_SCHEMA


def read_cdr(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All usage records of a directory of CSV files, each with a header line."""
    return spark.read.schema(CDR_SCHEMA).option("header", True).csv(path)


#: Long enough that no file is ever too old; Spark's own default drops files a week behind the newest.
ANY_AGE = "36500d"
#: The same where files that were read leave the folder.
ARCHIVED_AGE = "7d"


def read_cdr_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = 5,
    max_file_age: str | None = None,
    archive: str | None = None,
    **options: object,
) -> DataFrame:
    """Usage records of the CSV files that arrive in a directory.

    Files are read without a header option, so files with and without a header
    line both work: a header line fails to parse and is dropped by the cleaning.
    ``max_files`` bounds the files of one micro-batch (None: no bound).

    A stream knows each file it has read by name, about 100 bytes of the driver's
    memory. Without ``archive`` it knows all of them and reads any new one, whatever
    its modification time. With ``archive``, a folder outside ``path`` on the same
    file system, files move there once their micro-batch is committed, and names
    older than ``max_file_age`` (then 7 days) behind the newest are forgotten. A file
    that arrives with an older time than that is not read: it stays in the folder,
    where files that were read do not. Further file-source options such as
    ``maxBytesPerTrigger`` pass through.
    """
    age = max_file_age or (ARCHIVED_AGE if archive else ANY_AGE)
    reader = spark.readStream.schema(CDR_SCHEMA).option("maxFileAge", age).options(**options)
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def read_paytype_map(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Payment-type map ``paytype int, paytype_label string``, bound by position.

    Raises ValueError when a code has two labels: a join would repeat records.
    ``check=False`` leaves that to the caller's ``check_paytype_map``.
    """
    raw = spark.read.option("header", True).csv(path)
    named = raw.select(*[F.col(f"`{name}`") for name in raw.columns[:2]]).toDF("paytype", "paytype_label")
    typed = named.withColumn("paytype", paytype_code(F.col("paytype")))
    if check:
        check_paytype_map(typed)
    return typed


def check_paytype_map(paytype_map: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of a map, after a check that its codes are unique."""
    per_code = paytype_map.groupBy("paytype").agg(
        F.count("*").alias("copies"), F.sum(F.octet_length("paytype_label")).alias("label_bytes")
    )
    coded = F.col("paytype").isNotNull()
    found = per_code.agg(
        F.max(F.when(coded, F.struct("copies", "paytype"))).alias("most"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("label_bytes"), F.lit(0)).alias("label_bytes"),
    ).first()
    if found["most"] is not None and found["most"]["copies"] > 1:
        raise ValueError(f"payment-type map repeats a code ({found['most']['copies']} rows for code {found['most']['paytype']})")
    return found["rows"], found["label_bytes"] + 32 * found["rows"]
