"""Speeds and car counts per event-time window."""

from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstream.functions import messages
from roadstream.functions.numeric import mean2, speed_units
from roadstream.functions.timing import MINUTE, SECOND, to_timestamp, window_start


SPREAD = 16
#: Rows whose panes are summed and multiplied into windows in one task, so that its hash tables stay small however many rows there are.
TASK_ROWS = 250_000


def _interval(ms: int) -> str:
    return f"{ms} milliseconds"


def event_window(time: str, size: int, slide: int | None = None) -> Column:
    return F.window(time, _interval(size), _interval(slide or size))


def with_event_time(rows: DataFrame, ms: str = "action_time", delay: int | None = None,
                    name: str = "event_time") -> DataFrame:
    """Adds a TIMESTAMP column and, on streams, its watermark."""
    rows = rows.withColumn(name, to_timestamp(F.col(ms)))
    if delay is not None and rows.isStreaming:
        rows = rows.withWatermark(name, _interval(delay))
    return rows


def with_ingest_time(rows: DataFrame, name: str = "action_time") -> DataFrame:
    """The wall clock of the batch in place of the record's own time.

    Results then depend on when they are computed; event time is the default
    everywhere.
    """
    return rows.withColumn(name, F.unix_millis(F.current_timestamp()))


def sum_count(rows: DataFrame, keys: list[str], speed: str = "speed") -> DataFrame:
    """Sum of speeds (fixed point), count and mean per key."""
    total = rows.groupBy(*keys).agg(
        F.sum(speed_units(speed)).alias("_units"), F.count(speed).alias("car_count"))
    return total.select(*keys, F.col("_units").alias("speed_units"), "car_count",
                        mean2(F.col("_units"), F.col("car_count")).alias("avg_speed"))


def avg_speed_sliding(passages: DataFrame, size: int = 5 * MINUTE, slide: int = MINUTE,
                      key: str = "monitor_id", time: str = "action_time", speed: str = "speed",
                      delay: int = 5 * SECOND) -> DataFrame:
    """Mean speed and number of cars per checkpoint and sliding window.

    Batch: rows are first summed per pane (the stretch between two window
    edges); only those sums are copied into the windows that cover them, so
    raw rows are neither multiplied nor shuffled one by one.  The pane sums
    move once, by checkpoint, and are multiplied after that; a checkpoint has
    one row per pane by then, however many cars it saw.  The rows are counted
    first, for as many tasks as their panes may need: Spark alone would choose
    them by the panes' size before they are multiplied.  Where there are more
    panes than a task may hold, summing them in each task that reads rows would
    take its memory and save little: the rows are dealt out by pane first.
    Stream: one windowed aggregation with a watermark of ``delay``.
    """
    if passages.isStreaming:
        grouped = with_event_time(passages, time, delay).groupBy(
            event_window("event_time", size, slide).alias("_window"), F.col(key))
        sums = grouped.agg(F.sum(speed_units(speed)).alias("_units"), F.count(F.lit(1)).alias("car_count"))
        return sums.select(*_window_columns(), key, *_means())

    pane = gcd(size, slide)
    rows = passages.select(key, window_start(time, pane).alias("_pane"), speed_units(speed).alias("_units"))
    n, n_panes = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(key, "_pane"))).first()
    tasks, groups = n // TASK_ROWS + 1, [key, "_pane"]
    if n_panes > TASK_ROWS:
        groups.append("_share")
        rows = rows.withColumn("_share", F.pmod(F.xxhash64("_units"), F.lit(SPREAD))).repartition(tasks, *groups)
    panes = rows.groupBy(*groups).agg(F.sum("_units").alias("_units"), F.count(F.lit(1)).alias("car_count"))
    newest = window_start("_pane", slide)
    starts = F.transform(F.sequence(F.lit(0), F.lit((size - 1) // slide)),
                         lambda k: newest - k.cast("bigint") * F.lit(slide))
    by_key = panes.repartition(tasks, key) if tasks > 1 else panes.repartition(key)
    spread = by_key.withColumn("start_time", F.explode(starts))
    if size % slide:
        spread = spread.filter(F.col("start_time") + F.lit(size) > F.col("_pane"))
    sums = spread.groupBy("start_time", key).agg(
        F.sum("_units").alias("_units"), F.sum("car_count").alias("car_count"))
    return sums.select("start_time", (F.col("start_time") + F.lit(size)).alias("end_time"), key, *_means())


def _window_columns() -> list[Column]:
    return [F.unix_millis("_window.start").alias("start_time"),
            F.unix_millis("_window.end").alias("end_time")]


def _means() -> list[Column]:
    return [mean2(F.col("_units"), F.col("car_count")).alias("avg_speed"), F.col("car_count")]


def top_n_monitors(speeds: DataFrame, n: int = 3, key: str = "monitor_id") -> DataFrame:
    """The ``n`` checkpoints with most cars per window.

    Ties go to the smaller checkpoint id.  Catalyst limits every task to ``n``
    rows per window before the shuffle (``WindowGroupLimit``).
    """
    order = Window.partitionBy("start_time", "end_time").orderBy(F.desc("car_count"), F.col(key))
    return (speeds.withColumn("rank", F.row_number().over(order).cast("bigint"))
            .filter(F.col("rank") <= n))


def top_n_lines(top: DataFrame, n: int = 3, key: str = "monitor_id") -> DataFrame:
    """One text line per window; a window holds at most ``n`` rows here."""
    items = F.array_sort(F.collect_list(F.struct("rank", F.col(key).alias("monitor_id"), "car_count", "avg_speed")))
    return top.groupBy("start_time", "end_time").agg(items.alias("_items")).select(
        "start_time", "end_time",
        messages.top_line(F.col("start_time"), F.col("end_time"), n, F.col("_items")).alias("line"))


def _best(entries: Column, n: int) -> Column:
    return F.slice(F.array_sort(entries), 1, n).alias("_items")


def _top_items(passages: DataFrame, n: int, size: int, slide: int, key: str, time: str, speed: str,
               delay: int) -> DataFrame:
    """Two stages on a stream: windowed sums, then the best ``n`` of each window in ``_items``.

    The second stage never sees passages, only one entry per checkpoint of a
    window.  It keeps the best ``n`` of each of ``SPREAD`` shares of the
    checkpoints first and ranks those.
    """
    first = with_event_time(passages, time, delay).groupBy(
        event_window("event_time", size, slide).alias("_window"), F.col(key)).agg(
        F.sum(speed_units(speed)).alias("_units"), F.count(F.lit(1)).alias("car_count"))
    entry = F.struct((-F.col("car_count")).alias("_minus"), F.col(key).alias("monitor_id"),
                     "car_count", mean2(F.col("_units"), F.col("car_count")).alias("avg_speed"))
    share = F.pmod(F.xxhash64(key), F.lit(SPREAD)).alias("_share")
    shares = first.groupBy("_window", share).agg(_best(F.collect_list(entry), n))
    second = shares.groupBy("_window").agg(_best(F.flatten(F.collect_list("_items")), n))
    return second.select(*_window_columns(), "_items")


def top_n_stream(passages: DataFrame, n: int = 3, size: int = 5 * MINUTE, slide: int = MINUTE,
                 key: str = "monitor_id", time: str = "action_time", speed: str = "speed",
                 delay: int = 5 * SECOND) -> DataFrame:
    """``top_n_monitors`` of ``avg_speed_sliding`` on a stream."""
    items = _top_items(passages, n, size, slide, key, time, speed, delay)
    ranked = items.select("start_time", "end_time", F.posexplode("_items").alias("_at", "_item"))
    return ranked.select("start_time", "end_time", F.col("_item.monitor_id").alias(key),
                         "_item.avg_speed", "_item.car_count",
                         (F.col("_at") + 1).cast("bigint").alias("rank"))


def top_n_stream_lines(passages: DataFrame, n: int = 3, size: int = 5 * MINUTE, slide: int = MINUTE,
                       key: str = "monitor_id", time: str = "action_time", speed: str = "speed",
                       delay: int = 5 * SECOND) -> DataFrame:
    """``top_n_lines`` on a stream."""
    items = _top_items(passages, n, size, slide, key, time, speed, delay)
    return items.select("start_time", "end_time", messages.top_line(
        F.col("start_time"), F.col("end_time"), n, F.col("_items")).alias("line"))
