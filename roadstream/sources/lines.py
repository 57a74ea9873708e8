"""Lines of text from files, watched folders and topics, and back to a topic."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter

from roadstream.operators.sizing import for_lookup
from roadstream.shared import freeze


def kafka_source_options(servers: str, topic: str, group: str | None = None,
                         max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of ``format("kafka")`` for reading a topic from its first offset."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_lines(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                streaming: bool = True, **options) -> DataFrame:
    """UTF-8 lines of a topic; ``id`` is their place (partition, then offset)."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.format("kafka").options(**kafka_source_options(servers, topic, group, **options)).load()
    return rows.select(F.col("value").cast("string").alias("value"), place(F.col("partition"), F.col("offset")))


def place(partition: Column, offset: Column) -> Column:
    """A number per topic row, unique and growing within a partition."""
    return (F.shiftleft(partition.cast("bigint"), 44) + offset).alias("id")


def file_lines(spark: SparkSession, path: str, streaming: bool = False, glob: str | None = None,
               max_files_per_trigger: int | None = None, arrival_id: bool = False) -> DataFrame:
    """One row per line of the text files below ``path``.

    ``arrival_id`` numbers the lines of a table from 0: files by their time and
    name, lines as they stand.  The lines are written once to the shared
    folder; only a count per block of a file meets in one place.
    """
    if streaming and arrival_id:
        raise ValueError("a stream's lines carry their own id; only tables are numbered")
    reader = spark.readStream if streaming else spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(path)
    return _numbered(lines) if arrival_id else lines.select("value")


def _numbered(lines: DataFrame) -> DataFrame:
    block = ["file_modification_time", "file_path", "file_block_start"]
    lines = freeze(lines.select("value", *(F.col(f"_metadata.{x}") for x in block), F.monotonically_increasing_id().alias("_at")), "lines")
    sizes = lines.groupBy(*block).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = sizes.select(*block, "_first", (F.sum("_n").over(Window.orderBy(*block)) - F.col("_n")).alias("_before"))
    return lines.join(for_lookup(before), block).select("value", (F.col("_before") + F.col("_at") - F.col("_first")).alias("id"))


def to_topic(lines: DataFrame, servers: str, topic: str,
             checkpoint: str | None = None) -> DataStreamWriter | None:
    """Publish every line with a null key: at once, or as a stream writer to start."""
    values = lines.select(F.col("value").cast("string").alias("value"))
    options = kafka_sink_options(servers, topic)
    if values.isStreaming:
        return values.writeStream.format("kafka").options(checkpointLocation=checkpoint, **options)
    values.write.format("kafka").options(**options).save()
    return None


def tail_folder(spark: SparkSession, folder: str, glob: str = "*log",
                max_files_per_trigger: int = 100) -> DataFrame:
    """Lines of log files that appear in ``folder``; feed the result to ``to_topic``.

    A file is read once, so move it in when it is closed: lines appended to a
    file that was read already are not seen.
    """
    return file_lines(spark, folder, streaming=True, glob=glob,
                      max_files_per_trigger=max_files_per_trigger)
