"""Starting streaming queries.

Every query has a checkpoint folder; pass one on storage that all executors
reach.  ``available_now`` processes what is there and stops, else the query
runs with the given trigger interval.
"""

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadstream.sources.dimensions import Loader, Refreshed

_PARTITIONS = "spark.sql.shuffle.partitions"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """State store for large state; the stateful operators need it and are started with it."""
    spark.conf.set(_PROVIDER, ROCKSDB)


@contextmanager
def _store_for(df: DataFrame):
    """Queries with typed keyed state start with RocksDB; a query keeps the settings it is started with."""
    spark = df.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    typed = "TransformWithState" in df._jdf.queryExecution().analyzed().toString()
    if typed:
        use_rocksdb(spark)
    try:
        yield
    finally:
        if typed:
            spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


@contextmanager
def state_partitions(spark: SparkSession, n: int):
    """Queries started inside keep their state in ``n`` partitions.

    A query keeps the number it is first started with, so it is worth choosing
    by the size of its input rather than once for a whole session.
    """
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, n)
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def _trigger(writer: DataStreamWriter, available_now: bool, every: str | None) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
               every: str | None = None) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    with _store_for(df):
        return _trigger(writer, available_now, every).start(path)


def to_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append", available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """``each(batch, batch_id)`` per micro-batch; make it safe to repeat."""
    writer = df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
    with _store_for(df):
        return _trigger(writer, available_now, every).start()


def print_rows(df: DataFrame, label: str | None = None, mode: str = "append",
               checkpoint: str | None = None, available_now: bool = True, every: str | None = None):
    """Print rows: a stream to the console sink, a table by ``show``."""
    if not df.isStreaming:
        if label:
            print(label)
        return df.show(truncate=False)
    writer = df.writeStream.format("console").option("truncate", "false").outputMode(mode)
    if label:
        writer = writer.queryName(label)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    with _store_for(df):
        return _trigger(writer, available_now, every).start()


def with_table(passages: DataFrame, loader: Loader, combine: Callable[[DataFrame, DataFrame], DataFrame],
               each: Callable[[DataFrame, int], None], checkpoint: str, refresh_seconds: float = 2.0,
               available_now: bool = True, every: str | None = None) -> StreamingQuery:
    """Join every micro-batch with a reference table that is read again as it ages.

    The table is read before the batch, so changed and deleted rows count from
    the next batch on.
    """
    table = Refreshed(loader, refresh_seconds)
    return to_batches(passages, lambda batch, batch_id: each(combine(batch, table()), batch_id),
                      checkpoint, available_now=available_now, every=every)


def split_outcomes(writers: dict[str, Callable[[DataFrame, int], None]],
                   column: str = "outcome") -> Callable[[DataFrame, int], None]:
    """A ``to_batches`` body that sends each outcome to its own writer."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for outcome, write in writers.items():
                write(batch.filter(batch[column] == outcome), batch_id)
        finally:
            batch.unpersist()
    return each
