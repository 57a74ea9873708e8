"""Result tables as parquet folders or JDBC tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from roadstream.functions.timing import DAY, local_day, newest_first_key
from roadstream.schemas import AVERAGE_SPEED, OVERSPEED, TRACK, VIOLATION_LIST
from roadstream.shared import frozen
from roadstream.sinks.versions import VersionedTable
from roadstream.sources.dimensions import jdbc_options

# Table names.
SPEEDING_TABLE = "t_speeding_info"
AVERAGE_SPEED_TABLE = "t_average_speed"
JDBC_BATCH_ROWS = 1_000


def _as(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def append_parquet(rows: DataFrame, schema: StructType, path: str, batch_id: int | None = None) -> None:
    """Append ``rows``.  With a ``batch_id`` a repeated batch replaces its first try."""
    rows = _as(rows, schema)
    if batch_id is None:
        rows.write.mode("append").parquet(path)
    else:
        (rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch")
         .option("partitionOverwriteMode", "dynamic").parquet(path))


def append_jdbc(rows: DataFrame, schema: StructType, url: str, table: str, **options: str) -> None:
    options = {"batchsize": str(JDBC_BATCH_ROWS), **options}
    _as(rows, schema).write.format("jdbc").mode("append").options(**jdbc_options(url, table, **options)).save()


def write_speeding(alerts: DataFrame, path: str, batch_id: int | None = None) -> None:
    append_parquet(alerts, OVERSPEED, path, batch_id)


def write_speeding_jdbc(alerts: DataFrame, url: str, **options: str) -> None:
    append_jdbc(alerts, OVERSPEED, url, SPEEDING_TABLE, **options)


def write_average_speed(speeds: DataFrame, path: str, batch_id: int | None = None) -> None:
    append_parquet(speeds, AVERAGE_SPEED, path, batch_id)


def write_average_speed_jdbc(speeds: DataFrame, url: str, **options: str) -> None:
    append_jdbc(speeds, AVERAGE_SPEED, url, AVERAGE_SPEED_TABLE, **options)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema, StructField("batch", LongType())])


def appended(spark: SparkSession, path: str, schema: StructType) -> VersionedTable:
    """A table that a stream appends to for months: few folders, rows with their micro-batch (``sinks.versions``)."""
    return VersionedTable(spark, path, _with_batch(schema))


def append_batch(rows: DataFrame, schema: StructType, path: str, batch_id: int) -> None:
    """Append a micro-batch; one that was committed before adds nothing."""
    appended(rows.sparkSession, path, schema).append(_as(rows, schema).withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)


def read_speeding(spark: SparkSession, path: str) -> DataFrame:
    return appended(spark, path, OVERSPEED).read()


def read_average_speed(spark: SparkSession, path: str) -> DataFrame:
    return appended(spark, path, AVERAGE_SPEED).read()


def first_of_day(alerts: DataFrame, time: str = "action_time", msg: str = "msg") -> DataFrame:
    """The earliest alert per car and local calendar day."""
    first = F.min(F.struct(F.col(time).alias("create_time"), F.col(msg).alias("violation"))).alias("_first")
    return (alerts.groupBy("car", local_day(F.col(time)).alias("day")).agg(first)
            .select("car", "_first.violation", "_first.create_time", "day"))


def violations_once_per_day(alerts: DataFrame, stored: DataFrame, time: str = "action_time",
                            msg: str = "msg") -> DataFrame:
    """Alerts to insert: the first per car and day that ``stored`` lacks.

    Stored rows without a time belong to no day.
    """
    known = (stored.filter(F.col("create_time").isNotNull())
             .select("car", local_day(F.col("create_time")).alias("day")))
    return first_of_day(alerts, time, msg).join(known, ["car", "day"], "left_anti").select(
        "car", "violation", "create_time", "day")


def write_violations_once_per_day(alerts: DataFrame, path: str, time: str = "action_time",
                                  msg: str = "msg") -> None:
    """Insert into a parquet table partitioned by day; only the alerts' days are read.

    A repeated call adds nothing, so a replayed micro-batch is harmless.
    """
    spark = alerts.sparkSession
    with frozen(first_of_day(alerts, time, msg), "first-of-day") as firsts:
        low, high = firsts.agg(F.min("day"), F.max("day")).first()
        if low is None:
            return
        new = firsts
        if _exists(spark, path):
            stored = spark.read.parquet(path).filter(F.col("day").between(F.lit(low), F.lit(high)))
            new = firsts.join(stored.select("car", "day"), ["car", "day"], "left_anti")
        dated = _as(new, VIOLATION_LIST).withColumn("day", local_day(F.col("create_time")))
        dated.repartitionByRange("day", "car").write.mode("append").partitionBy("day").parquet(path)


def write_violations_once_per_day_jdbc(alerts: DataFrame, url: str, table: str = "t_violation_list",
                                       time: str = "action_time", msg: str = "msg", **options: str) -> None:
    """As above for a JDBC table; the time range of the alerts is pushed down."""
    spark = alerts.sparkSession
    with frozen(first_of_day(alerts, time, msg), "first-of-day") as firsts:
        low, high = firsts.agg(F.min("create_time"), F.max("create_time")).first()
        if low is None:
            return
        stored = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
        stored = stored.filter(F.col("create_time").between(low - DAY, high + DAY))
        with frozen(violations_once_per_day(firsts, stored, "create_time", "violation"), "new-violations") as new:
            append_jdbc(new, VIOLATION_LIST, url, table, **options)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def keyed_tracks(tracks: DataFrame, version: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``row_key``; the row with the highest ``version`` wins.

    Without a version, rows of one key are ordered by their values.
    """
    names = [f.name for f in TRACK]
    keyed = tracks.withColumn("row_key", newest_first_key(F.col("car"), "action_time"))
    last = F.max(F.struct(*[F.col(v).alias(f"_v{i}") for i, v in enumerate(version)], *names)).alias("_last")
    return keyed.groupBy("row_key").agg(last).select("row_key", *[f"_last.{n}" for n in names])


def write_tracks(tracks: DataFrame, path: str, version: int, order: tuple[str, ...] = ()) -> None:
    """Upsert a batch: write it once, as version ``version`` of its rows.

    Files are split by range of (day, row_key), so a frequent car does not end
    up in one task, and sorted, so a car's newest rows are found by min/max
    statistics.  A repeated batch replaces its first try.
    """
    rows = keyed_tracks(tracks, order).withColumns(
        {"day": local_day(F.col("action_time")), "version": F.lit(version).cast("bigint")})
    (rows.repartitionByRange("day", "row_key").sortWithinPartitions("day", "row_key")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "version").parquet(path))


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """Current rows: per ``row_key`` the one of the newest version."""
    stored = spark.read.parquet(path)
    names = [f.name for f in TRACK]
    last = F.max(F.struct("version", *names)).alias("_last")
    return stored.groupBy("row_key", "day").agg(last).select(
        "row_key", *[f"_last.{n}" for n in names], "day")


def compact_tracks(spark: SparkSession, path: str, low, high, target: str) -> None:
    """Write the current rows of the days ``low``..``high`` as one version to ``target``."""
    rows = read_tracks(spark, path).filter(F.col("day").between(F.lit(low), F.lit(high)))
    (rows.withColumn("version", F.lit(0).cast("bigint"))
     .repartitionByRange("day", "row_key").sortWithinPartitions("day", "row_key")
     .write.partitionBy("day", "version").parquet(target))


_TRACKS = StructType([StructField("row_key", StringType()), *TRACK, StructField("day", DateType()), StructField("version", LongType())])


def _newest(rows: DataFrame) -> DataFrame:
    names = [f.name for f in TRACK]
    return rows.groupBy("row_key", "day").agg(F.max(F.struct("version", *names)).alias("_last")).select(
        "row_key", *[f"_last.{n}" for n in names], "day", "_last.version")


def track_table(spark: SparkSession, path: str) -> VersionedTable:
    """Upserted tracks that are compacted in place: folders are merged as batches come, the newest row of a key stays.

    ``read`` gives the current rows with their ``version``; readers during a compaction see one version of the table.
    """
    return VersionedTable(spark, path, _TRACKS, _newest, ("day", "row_key"), ("day",))


def upsert_tracks(tracks: DataFrame, path: str, version: int, order: tuple[str, ...] = ()) -> None:
    """Add a micro-batch's rows as ``version`` (its number); of rows of one key in it the last by ``order`` counts."""
    rows = keyed_tracks(tracks, order).withColumns(
        {"day": local_day(F.col("action_time")), "version": F.lit(version).cast("bigint")})
    track_table(tracks.sparkSession, path).append(rows, version)
