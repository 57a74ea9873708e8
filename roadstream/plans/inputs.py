"""The driver's tables seen as passages, checkpoints, listed cars and records."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstream.functions.timing import to_ms


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def _size(spark: SparkSession, folder: str, name: str) -> int:
    return int(table(spark, folder, name)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def partitions(spark: SparkSession, folder: str, name: str, cores: int = 8) -> int:
    """Shuffle partitions for a table: one per 64 MB of its files, from 8 up to the session's number.

    With ``cores`` a larger table, of 2 MB a core or more, has one per core at least.
    """
    size = _size(spark, folder, name)
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, min(cores, size >> 21), size >> 26))


def files(spark: SparkSession, folder: str, name: str, n: int) -> int:
    """Files for each of ``n`` parts of a table: one per 4 MB of them, up to one per core."""
    return min(spark.sparkContext.defaultParallelism, max(1, (_size(spark, folder, name) // n) >> 22))


def as_passages(events: DataFrame) -> DataFrame:
    """Events as passages: user = car, ``props.k`` = checkpoint, type = area, value = speed."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    return events.select(
        F.col("event_id").alias("id"), to_ms("ts").alias("action_time"), k.alias("monitor_id"),
        F.concat(F.lit("cam"), k).alias("camera_id"), F.col("user_id").cast("string").alias("car"),
        F.col("value").alias("speed"), F.concat(F.lit("road"), k).alias("road_id"),
        F.col("event_type").alias("area_id"))


def as_violations(passages: DataFrame) -> DataFrame:
    return passages.filter(F.col("area_id") == "error").select(
        "id", "car", F.col("monitor_id").alias("msg"), F.col("action_time").alias("create_time"))


def as_police_actions(passages: DataFrame) -> DataFrame:
    return passages.filter(F.col("area_id") == "signup").select(
        "id", F.col("camera_id").alias("police_id"), "car", F.col("road_id").alias("action_status"), "action_time")


def passages(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    return as_passages((table_stream if streaming else table)(spark, folder, "events"))


def monitors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("monitor_id"), F.col("s_nationkey").cast("string").alias("road_id"),
        F.floor(F.col("s_acctbal") / 100).cast("int").alias("speed_limit"), F.lit(None).cast("string").alias("area_id"))


def violation_list(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("car"), F.col("c_mktsegment").alias("violation"),
        F.lit(None).cast("bigint").alias("create_time"))


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a denser passage table: supplier = checkpoint, quantity = speed."""
    return table(spark, folder, "lineitem").select(
        to_ms("l_shipdate").alias("action_time"), F.col("l_suppkey").cast("string").alias("monitor_id"),
        F.col("l_quantity").alias("speed"), F.col("l_partkey").cast("string").alias("car"),
        F.col("l_returnflag").alias("area_id"))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Passages written as wire lines, with their id."""
    p = passages(spark, folder)
    return p.select(F.concat_ws(",", F.col("action_time").cast("string"), "monitor_id", "camera_id", "car",
                                F.col("speed").cast("string"), "road_id", "area_id").alias("value"), "id")


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A mixed log: wire lines and, as foreign lines, the texts of ``documents``."""
    texts = table(spark, folder, "documents").select(F.col("text").alias("value"), F.col("doc_id").alias("id"))
    return lines(spark, folder).unionByName(texts)
