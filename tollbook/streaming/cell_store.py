"""Window cells that a streaming query has written down, to derive again what a changed cell is part of.

A stream in update mode says which cells have changed. A day or a label's window is
made of several cells, of which most have not: these are read from here. One folder
of the query holds, per UTC month of the window and per micro-batch that changed it,
all cells of that month as they were afterwards. By month and not by day, as Spark
lists each folder in a task of its own, whose findings go to the driver. A micro-batch
reads only what earlier ones wrote, so a repeated one does the same again.

In append mode cells come once, when they are closed; the store holds those of the
day that is not yet over, per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import child_names, delete

_KEY = ["bucket", "day", "paytype"]


def _utc_date(time: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86_400).cast("int"))


def _month(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 7)


class CellStore:
    """The cells of one query, in a folder of its own that outlives restarts.

    ValueError if an earlier version has left cells by day there: they would not be found.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder.rstrip("/")
        by_day = [name for name in child_names(spark, self._folder) if name.startswith("on=") and len(name) > len("on=yyyy-mm")]
        if by_day:
            raise ValueError(f"{self._folder} holds cells by day ({by_day[0]}), as an earlier version wrote them; start on a new checkpoint")

    def _read(self, like: DataFrame, paths: list[str]) -> DataFrame:
        if not paths:
            return like.limit(0)
        return self._spark.read.schema(like.schema).option("basePath", self._folder).parquet(*paths).select(like.columns)

    def _newest(self, folder: str, batch_id: int) -> str | None:
        """A folder's state before a micro-batch. Older ones are removed: no repetition can ask for them."""
        names = [name for name in child_names(self._spark, folder) if name.startswith("batch=")]
        earlier = sorted(n for n in (int(name.partition("=")[2]) for name in names) if n < batch_id)
        for n in earlier[:-1]:
            delete(self._spark, f"{folder}/batch={n}")
        return f"{folder}/batch={earlier[-1]}" if earlier else None

    def merged(self, changed: DataFrame, batch_id: int) -> DataFrame:
        """All cells of the months that ``changed`` touches, as they are after this micro-batch.

        Months are those of the windows in UTC and, so that local days are whole, those of
        the days before and after. The driver gets the months, one or two per micro-batch
        of a stream in the order of time.
        """
        on = _month(_utc_date(F.col("bucket")))
        near_days = F.array(*[_month(F.date_add("day", d)) for d in (-1, 0, 1)])
        touched = changed.select(on.alias("on"), F.explode(near_days).alias("near")).distinct().collect()
        months = {row.on for row in touched}
        before = {month: self._newest(f"{self._folder}/on={month}", batch_id) for month in sorted(months | {row.near for row in touched})}
        earlier = self._read(changed, [path for month, path in before.items() if path and month in months])
        values = [name for name in changed.columns if name not in _KEY]
        last = F.max_by(F.struct(*values), "_new").alias("last")
        both = earlier.withColumn("_new", F.lit(0)).unionByName(changed.withColumn("_new", F.lit(1)))
        cells = both.groupBy(*_KEY).agg(last).select(*_KEY, "last.*").select(changed.columns)
        (
            cells.withColumns({"on": on, "batch": F.lit(batch_id)})
            .repartition("on")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("on", "batch")
            .parquet(self._folder)
        )
        now = [f"{self._folder}/on={month}/batch={batch_id}" for month in sorted(months)]
        return self._read(changed, now + [path for month, path in before.items() if path and month not in months])

    def days_over(self, closed: DataFrame, batch_id: int) -> DataFrame:
        """Keeps closed cells of the last day and returns those of days that are over with this micro-batch.

        Windows close in the order of time, so a day is over when a cell of a later one
        is closed. The driver gets the last day.
        """
        folder = f"{self._folder}/open"
        before = self._newest(folder, batch_id)
        cells = closed
        if before:
            cells = self._spark.read.schema(closed.schema).parquet(before).unionByName(closed)
        last = cells.agg(F.max("day")).first()[0]
        cells.filter(F.col("day") == F.lit(last)).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        return cells.filter(F.col("day") < F.lit(last))
