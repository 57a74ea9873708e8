"""Exact deduplication with a stateful stream over disk-backed keyed state.

Texts are equal when identical without blanks, tabs, line ends, vertical tabs and form feeds.  Of equal texts the
longest original stays (in code points), then the smallest key, then the row stored first.

A written content store gives each row a number, its stable identifier and locator.  A stream over the store keeps,
per digest and without expiry, the number of rows and the row that stays, with its key and locator; RocksDB holds that
state on disk, and rows are combined before they are dealt to it.  Every hit is then compared with the content at
the locator, all bytes of it.  Should a digest turn out to stand for several texts, its rows are grouped again by
their whole normalised text.

Null counts as empty, and empty texts are equal to one another.  Equal rows, keys included, are rows of their own, of
which one stays.  An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadstream.llm.texts import text_of
from roadstream.operators.sizing import for_lookup
from roadstream.shared import new_path
from roadstream.streaming import runner

#: The characters that do not count.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_STATE = {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
          "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
          # A store that stays open keeps blocks of disk set aside, some megabytes for each partition.
          "spark.sql.streaming.stateStore.unloadOnCommit": "true"}


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


def store(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", digest=digest_of) -> DataFrame:
    """Write the content store: row (number), doc_id, length, digest, whole (the row's columns)."""
    body = text_of(docs, text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), docs[key].alias("doc_id"), F.length(body).cast("long").alias("length"),
        digest(normalised(body)).alias("digest"), F.struct(*(docs[x] for x in docs.columns)).alias("whole"))
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def keyed_state(stored: DataFrame) -> DataFrame:
    """State per digest, of a stream or a table: ``best`` (the row that stays) and ``size``."""
    return stored.groupBy("digest").agg(
        F.min(F.struct((-F.col("length")).alias("shorter"), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("size"))


def _streamed_state(spark: SparkSession, stored: DataFrame, path: str, batch_bytes: int) -> DataFrame:
    """Run the stream over the store to its end and read the last state of each digest."""
    before = {x: spark.conf.get(x, None) for x in [*_STATE, "spark.sql.streaming.stateStore.providerClass"]}
    runner.use_rocksdb(spark)
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    out = new_path(spark, "dedup-state")
    try:
        # Columns that the state does not need are not read.
        rows = spark.readStream.schema(stored.select("row", "doc_id", "length", "digest").schema).option(
            "maxBytesPerTrigger", batch_bytes).parquet(path)

        def each(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

        runner.to_batches(keyed_state(rows), each, f"{out}/checkpoint", "update").awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    schema = keyed_state(stored).schema
    if not stored.head(1):
        return spark.createDataFrame([], schema)
    changes = spark.read.schema(schema).parquet(f"{out}/rows/*")
    return changes.groupBy("digest").agg(F.min("best").alias("best"), F.max("size").alias("size"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=digest_of,
           batch_bytes: int = 256 << 20) -> tuple[DataFrame, DataFrame]:
    """The content store, and per stored row: row, doc_id, digest, keep_id, keep_row, group_size, kept.

    batch_bytes: size of the store's files that a micro-batch takes, one file at least.
    """
    spark = docs.sparkSession
    path = new_path(spark, "content")
    stored = store(docs, path, key, text, digest)
    state = _streamed_state(spark, stored, path, batch_bytes)
    state = state.select("digest", "size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    assigned_at = new_path(spark, "assigned")
    stored.select("row", "doc_id", "digest").join(state, "digest").write.parquet(assigned_at)
    assigned = spark.read.parquet(assigned_at)
    stored = stored.withColumn("normal", normalised(F.coalesce(F.col("whole")[text], F.lit(""))))
    differing = _differing(stored, assigned, new_path(spark, "differing"))
    result = assigned.select("row", "doc_id", "digest", "keep_id", "keep_row", F.col("size").alias("group_size"))
    if differing.head(1):
        result = result.join(differing, "digest", "left_anti").unionByName(_by_text(stored, differing))
    return stored, result.withColumn("kept", F.col("row") == F.col("keep_row"))


def _differing(stored: DataFrame, assigned: DataFrame, path: str) -> DataFrame:
    """Digests of hits whose bytes are not those at the locator."""
    shared = assigned.filter("size > 1").select("row", "keep_row", "digest")
    content = stored.select("row", F.col("normal").cast("binary").alias("bytes")).join(for_lookup(shared), "row")
    first = content.filter("row = keep_row").select("keep_row", F.col("bytes").alias("first_bytes"))
    hits = content.filter("row <> keep_row").select("keep_row", "digest", "bytes")
    hits.join(first.hint("merge"), "keep_row").filter("bytes <> first_bytes").select("digest").distinct().write.parquet(path)
    return stored.sparkSession.read.schema("digest string").parquet(path)


def _by_text(stored: DataFrame, differing: DataFrame) -> DataFrame:
    rows = stored.join(differing, "digest", "left_semi")
    best = rows.groupBy("digest", "normal").agg(
        F.min(F.struct((-F.col("length")).alias("shorter"), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(best, ["digest", "normal"]).select(
        "row", "doc_id", "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that another row stands for."""
    stored, rows = groups(docs, key, text)
    gone = for_lookup(rows.filter(~F.col("kept")).select("row"))
    return stored.select("row", "whole").join(gone, "row", "left_anti").select("whole.*")
