"""The payment-type map of a running stream: read again when its files change, checked, versioned.

A stream runs for months and its map file is edited under it. Read per micro-batch
without a check, an edit that repeats a code would count records twice, and an edit
half-way through a repeated micro-batch would give it two results. So every map that
passes the check is copied to the query's checkpoint, as the version that holds from
the micro-batch which first saw it, and micro-batches read copies only.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..workspace import child_names, delete, exists, file_states, touch
from .files import check_paytype_map, read_paytype_map

MAP_SCHEMA = "paytype int, paytype_label string"
_COMPLETE = "_complete"

_log = logging.getLogger(__name__)


class PaytypeMaps:
    """The maps of one streaming query, by micro-batch.

    ``source`` is the map's path, or a frame of ``paytype, paytype_label``, whose files
    are watched as well. ``folder`` belongs to the query and outlives restarts.
    """

    def __init__(self, spark: SparkSession, source: str | DataFrame, folder: str) -> None:
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._read: Callable[[], DataFrame]
        if isinstance(source, str):
            self._read, self._files = lambda: read_paytype_map(spark, source, check=False), [source]
        else:
            self._read, self._files = lambda: source, list(source.inputFiles())
        self._seen: str | None = None
        self._bytes: dict[int, int] = {}
        #: Why the newest state of the files is not in use; None if it is.
        self.refused: str | None = None

    def _path(self, batch_id: int) -> str:
        return f"{self._folder}/from_batch={batch_id:012d}"

    def _known(self, batch_id: int) -> int | None:
        """The micro-batch whose version holds for this one."""
        names = child_names(self._spark, self._folder)
        known = [int(name.partition("=")[2]) for name in names if name.startswith("from_batch=")]
        for first in sorted((n for n in known if n <= batch_id), reverse=True):
            if exists(self._spark, f"{self._path(first)}/{_COMPLETE}"):
                return first
        return None

    def _adopt(self, batch_id: int) -> None:
        """Makes the files as they are now the version from this micro-batch on; ValueError if they repeat a code."""
        path = self._path(batch_id)
        if exists(self._spark, path):  # of a driver that died before it was complete
            delete(self._spark, path)
        self._read().select("paytype", "paytype_label").write.parquet(path)
        # The copy is checked, not the files: they may change in between.
        try:
            self._bytes[batch_id] = check_paytype_map(self._spark.read.schema(MAP_SCHEMA).parquet(path))[1]
        except ValueError:
            delete(self._spark, path)
            raise
        touch(self._spark, f"{path}/{_COMPLETE}")

    def at(self, batch_id: int) -> tuple[DataFrame, int]:
        """The map for a micro-batch and its size in bytes.

        That is the files' newest state if it can be read and no code has two labels.
        Otherwise the version before stays in force and the reason is logged; without
        one, the error is raised. A repeated micro-batch gets what it had.
        """
        known = self._known(batch_id)
        if known != batch_id:
            state = "\n".join(file_states(self._spark, path) for path in self._files)
            if known is None or state != self._seen:
                try:
                    self._adopt(batch_id)
                    known, self.refused = batch_id, None
                except (ValueError, PySparkException) as error:
                    if known is None:
                        raise
                    self.refused = str(error)
                    _log.error("micro-batch %d keeps the payment-type map of micro-batch %d: %s", batch_id, known, error)
                self._seen = state
        rows = self._spark.read.schema(MAP_SCHEMA).parquet(self._path(known))
        if known not in self._bytes:
            self._bytes[known] = check_paytype_map(rows)[1]
        return rows, self._bytes[known]
