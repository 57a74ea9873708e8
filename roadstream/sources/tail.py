"""Lines of log files that grow and are rotated, as a streaming data source with byte offsets.

The query's checkpoint holds how far each file was read.  A micro-batch takes the complete lines that were appended since;
a last line without its end waits for it.  Files are known by their number in the file system (by their path where a file
system has none), so a file that was renamed goes on under its new name and a new file of the old name starts anew.
The names read have to stay below ``folder`` and match ``glob`` until their lines are read.  Large stretches are split at
line ends into ranges of ``split`` bytes, read side by side by the executors, which have to reach the folder.
"""

import fnmatch
import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 64 << 20
_BLOCK = 1 << 16


def files_below(folder: str, glob: str) -> dict[str, tuple[str, int]]:
    """Path and size of each file, by its number."""
    found = {}
    for entry in os.scandir(folder):
        if entry.is_file() and fnmatch.fnmatch(entry.name, glob):
            stat = entry.stat()
            found[f"{stat.st_dev}:{stat.st_ino}" if stat.st_ino else entry.path] = entry.path, stat.st_size
    return found


def line_end(path: str, start: int, size: int) -> int:
    """Where the last complete line between ``start`` and ``size`` ends."""
    with open(path, "rb") as file:
        at = size
        while at > start:
            low = max(start, at - _BLOCK)
            file.seek(low)
            found = file.read(at - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            at = low
    return start


class _Range(InputPartition):
    def __init__(self, number: str, path: str, start: int, low: int, high: int):
        super().__init__((number, low, high))
        self.number, self.path, self.start, self.low, self.high = number, path, start, low, high


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.glob = options["path"], options.get("glob", "*log*")
        self.split = int(options.get("split", SPLIT_BYTES))
        self.last: dict = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        known, files = self.last, {}
        for number, (path, size) in files_below(self.folder, self.glob).items():
            start = known.get(number, 0)
            # A file that shrank was emptied and written anew.
            files[number] = line_end(path, start if start <= size else 0, size)
        self.last = files
        return {"files": json.dumps(files, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        paths, found = files_below(self.folder, self.glob), []
        for number, high in sorted(after.items()):
            first = before.get(number, 0)
            first = 0 if first > high else first
            if first < high and number not in paths:
                raise FileNotFoundError(f"file {number} left {self.folder} before its lines were read")
            for low in range(first, high, self.split):
                found.append(_Range(number, paths[number][0], first, low, min(low + self.split, high)))
        return found

    def commit(self, end: dict) -> None:
        pass

    def read(self, partition: _Range) -> Iterator[tuple[str]]:
        """Lines that begin in the range."""
        path = partition.path
        if not os.path.exists(path) or f"{os.stat(path).st_dev}:{os.stat(path).st_ino}" != partition.number:
            path = files_below(self.folder, self.glob).get(partition.number, (path, 0))[0]  # renamed meanwhile
        with open(path, "rb") as file:
            at = partition.low
            if at > partition.start:
                file.seek(at - 1)
                at += len(file.readline()) - 1
            else:
                file.seek(at)
            while at < partition.high:
                line = file.readline()
                if not line:
                    break
                at += len(line)
                yield (line.rstrip(b"\r\n").decode("utf-8", "replace"),)


class GrowingFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(self.options)


def growing_lines(spark: SparkSession, folder: str, glob: str = "*log*", split: int = SPLIT_BYTES) -> DataFrame:
    """Stream of the lines that are and will be in the log files of ``folder``."""
    spark.dataSource.register(GrowingFiles)
    return spark.readStream.format("growing_files").options(path=folder, glob=glob, split=str(split)).load()
