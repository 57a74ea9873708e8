"""Running totals over micro-batches, with a committed total per key and batch.

A stream's running total needs what came before.  The totals after each
micro-batch are written under its number, so a batch that runs again starts
from the totals of the batch before it and replaces its own.  Within a batch
the rows of a key are numbered as on tables (``operators.ordered``), so a key
with most of the rows spreads over tasks.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadstream.functions.timing import SECOND
from roadstream.operators.ordered import GROUP_ROWS, over_groups
from roadstream.operators.sizing import for_lookup
from roadstream.shared import delete, file_system, frozen
from roadstream.streaming import runner, stateful

Write = Callable[[DataFrame, int], None]


class Totals:
    """The totals per key after each micro-batch, in ``path``; those of the last two batches are kept."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        files, place = file_system(self.spark, self.path)
        if not files.exists(place):
            return []
        names = [x.getPath().getName() for x in files.listStatus(place)]
        done = [n for n in names if n.startswith("batch-") and files.exists(file_system(self.spark, f"{self.path}/{n}/_SUCCESS")[1])]
        return sorted(int(n.removeprefix("batch-")) for n in done)

    def before(self, batch: int) -> DataFrame | None:
        """Totals after the batches below ``batch``."""
        earlier = [n for n in self._numbers() if n < batch]
        return self.spark.read.parquet(f"{self.path}/batch-{earlier[-1]}") if earlier else None

    def commit(self, totals: DataFrame, batch: int) -> None:
        totals.write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        for n in [n for n in self._numbers() if n < batch][:-1]:
            delete(self.spark, f"{self.path}/batch-{n}")


def _key(keys: list[str]) -> Column:
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def add_totals(batch: DataFrame, number: int, totals: Totals, keys: list[str], order: list[str], name: str, value: Column,
               write: Write, ends: Column | None = None, max_rows: int | None = GROUP_ROWS) -> None:
    """Write a micro-batch with the running sum ``name`` of ``value`` per key over all batches so far, then commit.

    ``ends``: when a key's last row can come, as a column over ``keys``; keys whose end the batch's rows
    (``order[0]``, in event-time order over batches) have passed are forgotten.
    """
    with frozen(batch.withColumn("_value", value.cast("long")), "batch") as rows:
        sums = rows.groupBy(_key(keys).alias("_key")).agg(F.sum("_value").alias("_sum"))
        known = totals.before(number)
        running = over_groups(rows, keys, order, lambda rows, groups: groups.running(rows, sums={name: F.col("_value")}), max_rows)
        if known is None:
            after = sums
        else:
            past = for_lookup(known.select(F.col("_key").alias("_known"), F.col("_sum").alias("_past")))
            running = running.join(past, _key(keys) == F.col("_known"), "left").withColumn(
                name, F.col(name) + F.coalesce("_past", F.lit(0))).drop("_known", "_past")
            after = known.unionByName(sums).groupBy("_key").agg(F.sum("_sum").alias("_sum"))
        if ends is not None:
            newest = rows.agg(F.max(order[0])).first()[0]
            if newest is not None:
                after = after.select("_key.*", "_sum").filter(ends > newest).select(_key(keys).alias("_key"), "_sum")
        write(running.drop("_value"), number)
        totals.commit(after, number)


def running_distinct(passages: DataFrame, size: int, write: Write, path: str, checkpoint: str,
                     order: tuple[str, ...] = ("action_time", "id"), delay: int = 5 * SECOND,
                     max_rows: int | None = GROUP_ROWS, **trigger):
    """``operators.distinct.running_distinct`` on a stream: every passage once, with the cars of its area and window so far.

    Passages come out when the watermark has reached them, in order of time over micro-batches.  Totals go to ``path``.
    """
    totals = Totals(passages.sparkSession, path)

    def each(batch: DataFrame, number: int) -> None:
        def shown(rows: DataFrame, number: int) -> None:
            end = (F.col("start_time") + F.lit(size)).alias("end_time")
            write(rows.select("area_id", "start_time", end, "car", *order, "cars"), number)

        add_totals(batch, number, totals, ["area_id", "start_time"], list(order), "cars", F.col("new"), shown,
                   F.col("start_time") + F.lit(size), max_rows)

    return runner.to_batches(stateful.first_passages(passages, size, order, delay=delay), each, checkpoint, **trigger)


def count_batches(rows: DataFrame, order: list[str], write: Write, path: str, checkpoint: str, size: int = 10,
                  max_rows: int | None = GROUP_ROWS, **trigger):
    """``operators.batching.count_batches`` on a stream: rows are numbered as their micro-batches come, by ``order`` within one."""
    totals = Totals(rows.sparkSession, path)

    def each(batch: DataFrame, number: int) -> None:
        def shown(rows: DataFrame, number: int) -> None:
            place = F.call_function("div", F.col("_at") - F.lit(1), F.lit(size))
            write(rows.withColumn("batch_id", place).drop("_at"), number)

        add_totals(batch, number, totals, [], order, "_at", F.lit(1), shown, max_rows=max_rows)

    return runner.to_batches(rows, each, checkpoint, **trigger)
