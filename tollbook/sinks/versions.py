"""Versions: folders that never change, of which the newest complete one counts.

They stand on a *shelf*, a folder whose name readers of the folder above skip, as
``<number>-<writer>``. A version counts once an empty file ``_complete`` stands in
it, which its writer makes last, in one step on any file system. So there is no
moment without a version, a writer that dies leaves the earlier one in force, and a
reader that has begun goes on with files that stay until newer versions are complete.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

from ..workspace import child_names, delete, exists, touch

COMPLETE = "_complete"
#: A version without its mark may be one that is being written, unless this many newer ones are complete.
ABANDONED = 10


def number_of(name: str) -> int:
    """The number of a version's name."""
    return int(name.partition("-")[0])


def newest(spark: SparkSession, shelf: str) -> str | None:
    """Name of the version in force, if there is any."""
    # Newest first: of many versions one is looked at.
    for name in reversed(child_names(spark, shelf)):
        if exists(spark, f"{shelf}/{name}/{COMPLETE}"):
            return name
    return None


def new_name(spark: SparkSession, shelf: str, number: int | None = None) -> str:
    """A free name, by default after all that are there, complete or not."""
    if number is None:
        number = max(map(number_of, child_names(spark, shelf)), default=0) + 1
    return f"{number:012d}-{uuid4().hex[:8]}"


def publish(spark: SparkSession, shelf: str, name: str, keep: int) -> None:
    """Puts a written version in force and removes those older than the ``keep`` before the newest."""
    touch(spark, f"{shelf}/{name}/{COMPLETE}")
    names = child_names(spark, shelf)
    complete = [n for n in names if exists(spark, f"{shelf}/{n}/{COMPLETE}")]
    for old in complete[: -1 - keep]:
        delete(spark, f"{shelf}/{old}")
    for left in set(names) - set(complete):
        if number_of(left) < number_of(complete[-1]) - keep - ABANDONED:
            delete(spark, f"{shelf}/{left}")
