"""Tables that micro-batches are appended to, in few folders, with versions that readers resolve.

``path/_versions/<n>.json`` lists the data folders of version n and the range of micro-batches each holds: the table's
commit log.  A batch is written to a folder of its own, then published as the next version.  Neighbouring folders of as
many batches each are merged, so n batches leave log2(n) folders or fewer and a row is written again log2(n) times at
most.  ``merge`` can drop what later rows replace, such as older rows of a key.

A reader takes the newest version's folders; what a version does not name any more is deleted when the version after it
is published, so a reader that has started keeps its folders until the table has moved on twice.  A batch that the log
holds already adds nothing when it is written again.  One writer at a time, as for a streaming query's sink.
"""

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from roadstream.shared import delete, file_system

_LOG = "_versions"


class VersionedTable:
    """A table of ``schema`` in ``path``; rows are clustered by range of ``sort`` when folders are written."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, merge: Callable[[DataFrame], DataFrame] | None = None,
                 sort: tuple[str, ...] = (), partition: tuple[str, ...] = ()):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.merge, self.sort, self.partition = merge, sort, partition

    def _children(self, folder: str) -> list[str]:
        files, place = file_system(self.spark, folder)
        return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []

    def versions(self) -> list[int]:
        names = self._children(f"{self.path}/{_LOG}")
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json"))

    def folders(self, version: int | None = None) -> list[dict]:
        """Entries (folder, low, high) of a version, the newest by default."""
        known = self.versions()
        if not known:
            return []
        files, place = file_system(self.spark, f"{self.path}/{_LOG}/{known[-1] if version is None else version}.json")
        stream = files.open(place)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, with older rows of a key left out where the table merges."""
        rows = self._rows(self.folders(version))
        return self.merge(rows) if self.merge else rows

    def _rows(self, entries: list[dict]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        rows = None
        for entry in entries:
            part = self.spark.read.schema(self.schema).parquet(f"{self.path}/{entry['folder']}")
            rows = part if rows is None else rows.unionByName(part)
        return rows.select(self.schema.names)

    def _write(self, rows: DataFrame, low: int, high: int) -> dict:
        folder = f"data-{low}-{high}-{uuid.uuid4().hex}"
        if self.sort:
            rows = rows.repartitionByRange(*self.sort).sortWithinPartitions(*self.sort)
        writer = rows.select(self.schema.names).write
        (writer.partitionBy(*self.partition) if self.partition else writer).parquet(f"{self.path}/{folder}")
        return {"folder": folder, "low": low, "high": high}

    def _publish(self, entries: list[dict]) -> None:
        known = self.versions()
        number = known[-1] + 1 if known else 0
        files, draft = file_system(self.spark, f"{self.path}/{_LOG}/.{number}-{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(entries).encode()))
        stream.close()
        final = file_system(self.spark, f"{self.path}/{_LOG}/{number}.json")[1]
        if files.exists(final) or not files.rename(draft, final):
            raise RuntimeError(f"version {number} of {self.path} was published by another writer")
        self._clean(number)

    def _clean(self, newest: int) -> None:
        """Drop versions before the last two and folders that neither names."""
        kept = [n for n in self.versions() if n >= newest - 1]
        named = {entry["folder"] for n in kept for entry in self.folders(n)}
        for name in self._children(self.path):
            if name.startswith("data-") and name not in named:
                delete(self.spark, f"{self.path}/{name}")
        for name in self._children(f"{self.path}/{_LOG}"):
            if name.endswith(".json") and int(name.removesuffix(".json")) not in kept:
                delete(self.spark, f"{self.path}/{_LOG}/{name}")

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Add a micro-batch and merge what has become alike; False if the log holds the batch already."""
        entries = self.folders()
        if any(x["low"] <= batch <= x["high"] for x in entries):
            return False
        entries = [*entries, self._write(rows, batch, batch)]
        tail = 1
        while tail < len(entries) and self._size(entries[-tail - 1]) <= sum(map(self._size, entries[-tail:])):
            tail += 1
        self._publish(entries if tail == 1 else [*entries[:-tail], self._merged(entries[-tail:])])
        return True

    @staticmethod
    def _size(entry: dict) -> int:
        return entry["high"] - entry["low"] + 1

    def _merged(self, entries: list[dict]) -> dict:
        rows = self._rows(entries)
        return self._write(self.merge(rows) if self.merge else rows, entries[0]["low"], entries[-1]["high"])

    def compact(self) -> None:
        """Merge all folders into one, in place."""
        entries = self.folders()
        if len(entries) > 1:
            self._publish([self._merged(entries)])
