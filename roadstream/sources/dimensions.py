"""Reference tables: checkpoints with their limits, listed cars, areas.

A loader is a function without arguments that makes a fresh DataFrame.  Batch
jobs call it once; streaming jobs call it again while they run, because a
reader made earlier does not see rows or files added later.
"""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadstream.operators.enrich import upsert_dimension
from roadstream.schemas import AREA, MONITOR, VIOLATION_LIST
from roadstream.shared import delete, new_path

Loader = Callable[[], DataFrame]

# Table names.
MONITOR_TABLE = "t_monitor_info"
VIOLATION_TABLE = "t_violation_list"
AREA_TABLE = "t_area_info"


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **extra}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def jdbc_loader(spark: SparkSession, schema: StructType, url: str, table: str, **options: str) -> Loader:
    columns = [f.name for f in schema]
    return lambda: spark.read.format("jdbc").options(
        **jdbc_options(url, table, **options)).load().select(*columns)


def parquet_loader(spark: SparkSession, schema: StructType, path: str) -> Loader:
    return lambda: spark.read.schema(schema).parquet(path)


def monitors_jdbc(spark: SparkSession, url: str, **options: str) -> Loader:
    return jdbc_loader(spark, MONITOR, url, MONITOR_TABLE, **options)


def violation_list_jdbc(spark: SparkSession, url: str, **options: str) -> Loader:
    return jdbc_loader(spark, VIOLATION_LIST, url, VIOLATION_TABLE, **options)


def areas_jdbc(spark: SparkSession, url: str, **options: str) -> Loader:
    return jdbc_loader(spark, AREA, url, AREA_TABLE, **options)


class Refreshed:
    """Reads its table again once ``refresh_seconds`` have passed.

    The rows read are kept in the shared folder until then, so that however
    many jobs join with them, the source is read once for each refresh.  Two
    readings are kept: a micro-batch that began with the last one can end with
    it; older ones are deleted.
    """

    def __init__(self, loader: Loader, refresh_seconds: float = 2.0):
        self._loader, self._every = loader, refresh_seconds
        self._kept: list[tuple[str, DataFrame]] = []
        self._read_at = 0.0

    def __call__(self) -> DataFrame:
        now = time.monotonic()
        if not self._kept or now - self._read_at >= self._every:
            rows = self._next()
            path = new_path(rows.sparkSession, "dimension")
            rows.write.parquet(path)
            self._kept.append((path, rows.sparkSession.read.schema(rows.schema).parquet(path)))
            self._read_at = now
            while len(self._kept) > 2:
                delete(rows.sparkSession, self._kept.pop(0)[0])
        return self._kept[-1][1]

    def _next(self) -> DataFrame:
        return self._loader()


class Upserted(Refreshed):
    """A table that is kept up to date by its changes in place of whole readings.

    ``changes(since)`` loads the rows whose ``version`` is above ``since``
    (None at first: all rows).  The newest row per ``keys`` counts; rows can
    be replaced, not removed.
    """

    def __init__(self, changes: Callable[[int | None], DataFrame], keys: list[str], version: str = "version",
                 refresh_seconds: float = 2.0):
        super().__init__(lambda: changes(self._since), refresh_seconds)
        self._keys, self._version, self._since = keys, version, None

    def _next(self) -> DataFrame:
        rows = self._loader()
        if self._kept:
            rows = self._kept[-1][1].unionByName(rows)
        return upsert_dimension(rows, self._keys, [self._version])

    def __call__(self) -> DataFrame:
        before = len(self._kept), self._read_at
        table = super().__call__()
        if before != (len(self._kept), self._read_at):
            self._since = table.agg(F.max(self._version)).first()[0]
        return table
