"""Helpers of the text operators: batches in bounded slices, paths in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import new_path

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of ``column``; one longer row is a run of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(
        zero_copy_only=False
    )
    start, held = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > start and held + length > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null is the empty text."""
    return [text or "" for text in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def map_slices(
    df: DataFrame,
    schema: str,
    work: Callable[[pa.RecordBatch], dict[str, object]],
    column: str = "text",
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Maps slices of rows to the columns of ``schema``; memory is one slice and what ``work`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, most):
                yield pa.RecordBatch.from_pydict(work(part))

    return df.mapInArrow(run, schema)


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def unused(name: str, names: list[str]) -> str:
    """A column name like ``name`` that is not among ``names``, in any case of letters."""
    taken = {other.lower() for other in names}
    while name.lower() in taken:
        name = f"_{name}"
    return name
