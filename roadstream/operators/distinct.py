"""Distinct cars per area and window: exact, bloom-style, sketched, running."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstream.functions import messages
from roadstream.functions.hashing import bit_offsets
from roadstream.functions.timing import MINUTE, SECOND, window_start
from roadstream.operators.ordered import CHUNK, GROUP, GROUP_ROWS, Ordered, over_groups
from roadstream.operators.windows import event_window, with_event_time

BLOOM_BITS = 1 << 22


def _bounded(counts: DataFrame, size: int) -> DataFrame:
    values = [c for c in counts.columns if c not in ("area_id", "start_time")]
    return counts.select("area_id", "start_time", (F.col("start_time") + F.lit(size)).alias("end_time"), *values)


def distinct_cars_tumbling(passages: DataFrame, size: int = 10 * SECOND, time: str = "action_time",
                           area: str = "area_id", car: str = "car", delay: int = 5 * SECOND) -> DataFrame:
    """Exact number of cars per area and tumbling window.

    Rows are first made distinct on (area, window, car), which combines before
    the shuffle and spreads over cars; only then are the few areas counted.
    """
    if passages.isStreaming:
        seen = with_event_time(passages, time, delay).select(
            F.col(area).alias("area_id"), event_window("event_time", size).alias("_window"), F.col(car).alias("_car"))
        seen = seen.dropDuplicates(["_window", "area_id", "_car"])
        counts = seen.groupBy("_window", "area_id").agg(F.count(F.lit(1)).alias("cars"))
        return counts.select("area_id", F.unix_millis("_window.start").alias("start_time"),
                             F.unix_millis("_window.end").alias("end_time"), "cars")
    seen = passages.select(F.col(area).alias("area_id"), window_start(time, size).alias("start_time"),
                           F.col(car).alias("_car")).distinct()
    counts = seen.groupBy("area_id", "start_time").agg(F.count(F.lit(1)).alias("cars"))
    return _bounded(counts, size)


def area_lines(counts: DataFrame, cars: str = "cars") -> DataFrame:
    return counts.withColumn("line", messages.area_line(
        F.col("area_id"), F.col("start_time"), F.col("end_time"), F.col(cars)))


def distinct_cars_bloom(passages: DataFrame, size: int = 10 * MINUTE, bits: int = BLOOM_BITS,
                        hash: str = "xxhash64", time: str = "action_time", arrival: str | Column = "id",
                        area: str = "area_id", car: str = "car", delay: int = 5 * SECOND) -> DataFrame:
    """What a two-hash bloom filter per area and window would have counted.

    A passage finds an unset bit exactly when it is the first one at one of
    its car's positions.  So the count is the number of different passages
    that are first at some position.  Minima merge, hence every step combines
    before its shuffle, and the result never exceeds the exact count.
    ``arrival`` is a unique number that grows with arrival.

    On streams the same steps are chained aggregates over one window: state is
    a row per car, per set bit and per counted passage of the open windows.
    """
    if passages.isStreaming:
        keys = ["_window", "area_id"]
        cars = with_event_time(passages, time, delay).groupBy(
            event_window("event_time", size).alias("_window"), F.col(area).alias("area_id"), F.col(car).alias("_car")).agg(
            F.min(arrival).alias("_first"))
        bits_set = cars.select(*keys, "_first", F.explode(bit_offsets("_car", bits, hash)).alias("_bit")).groupBy(
            *keys, "_bit").agg(F.min("_first").alias("_first"))
        counts = bits_set.dropDuplicates([*keys, "_first"]).groupBy(*keys).agg(F.count(F.lit(1)).alias("cars"))
        return counts.select("area_id", F.unix_millis("_window.start").alias("start_time"),
                             F.unix_millis("_window.end").alias("end_time"), "cars")
    counted = _bloom_firsts(passages, size, bits, hash, time, arrival, area, car)
    return _bounded(counted.groupBy("area_id", "start_time").agg(F.count(F.lit(1)).alias("cars")), size)


def _bloom_firsts(passages, size, bits, hash, time, arrival, area, car) -> DataFrame:
    """The passages that find an unset bit: area, window and ``_first``, their number."""
    cars = passages.groupBy(F.col(area).alias("area_id"), window_start(time, size).alias("start_time"),
                            F.col(car).alias("_car")).agg(F.min(arrival).alias("_first"))
    positions = cars.select("area_id", "start_time", "_first",
                            F.explode(bit_offsets("_car", bits, hash)).alias("_bit"))
    firsts = positions.groupBy("area_id", "start_time", "_bit").agg(F.min("_first").alias("_first"))
    return firsts.select("area_id", "start_time", "_first").distinct()


def running_bloom(passages: DataFrame, size: int = 10 * MINUTE, bits: int = BLOOM_BITS,
                  hash: str = "xxhash64", time: str = "action_time", arrival: str = "id",
                  area: str = "area_id", car: str = "car", max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """For every passage, the bloom-style count of its area and window so far, in order of arrival."""
    firsts = _bloom_firsts(passages, size, bits, hash, time, arrival, area, car).select(
        F.col("_first").alias(arrival), F.lit(1).cast("bigint").alias("_new"))
    rows = passages.select(F.col(area).alias("area_id"), window_start(time, size).alias("start_time"),
                           F.col(car).alias("car"), time, arrival)
    # The passage number is unique, so this join has no frequent key.
    rows = rows.join(firsts, arrival, "left").withColumn("_new", F.coalesce("_new", F.lit(0)))
    counted = over_groups(rows, ["area_id", "start_time"], [arrival], lambda rows, groups: groups.running(
        rows, sums={"cars": F.col("_new")}).drop("_new"), max_rows)
    return _bounded(counted, size)


def car_sketches(passages: DataFrame, size: int = 10 * MINUTE, time: str = "action_time",
                 area: str = "area_id", car: str = "car", lg_k: int = 12) -> DataFrame:
    """A mergeable HLL sketch of the cars per area and window."""
    return passages.groupBy(F.col(area).alias("area_id"), window_start(time, size).alias("start_time")).agg(
        F.hll_sketch_agg(car, lg_k).alias("sketch"))


def distinct_cars_sketch(sketches: DataFrame, size: int = 10 * MINUTE) -> DataFrame:
    """Merge sketches into windows of ``size`` and estimate each."""
    merged = sketches.groupBy("area_id", window_start("start_time", size).alias("start_time")).agg(
        F.hll_union_agg("sketch").alias("sketch"))
    return _bounded(merged.select("area_id", "start_time", F.hll_sketch_estimate("sketch").alias("cars")), size)


def distinct_cars_approx(passages: DataFrame, size: int = 10 * MINUTE, time: str = "action_time",
                         area: str = "area_id", car: str = "car", delay: int = 5 * SECOND,
                         error: float = 0.005) -> DataFrame:
    """Approximate count with constant state per window, for batch and streams."""
    rows = with_event_time(passages, time, delay)
    counts = rows.groupBy(event_window("event_time", size).alias("_window"), F.col(area).alias("area_id")).agg(
        F.approx_count_distinct(car, error).alias("cars"))
    return counts.select("area_id", F.unix_millis("_window.start").alias("start_time"),
                         F.unix_millis("_window.end").alias("end_time"), "cars")


def running_distinct(passages: DataFrame, size: int = 10 * MINUTE,
                     order: tuple[str, ...] = ("action_time", "id"), area: str = "area_id",
                     car: str = "car", max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """For every passage, the number of cars of its area and window so far."""
    rows = passages.select(F.col(area).alias("area_id"), window_start(order[0], size).alias("start_time"),
                           F.col(car).alias("car"), *order)
    keys = ["area_id", "start_time"]

    def counts(rows: DataFrame, groups: Ordered) -> DataFrame:
        in_group = Window.partitionBy(*groups.group, "car").orderBy(*order)
        if not groups.chunked:
            # One exchange on the group serves both windows.
            rows = rows.repartition(*keys)
        rows = rows.withColumn("_new", (F.row_number().over(in_group) == 1).cast("bigint"))
        if groups.chunked:
            # A car is new only in the first chunk that has it.  At most one
            # row per car and chunk takes part in this second window.
            firsts = rows.filter(F.col("_new") == 1).withColumn("_chunk_first", F.min(CHUNK).over(
                Window.partitionBy(GROUP, "car")))
            firsts = firsts.withColumn("_new", (F.col(CHUNK) == F.col("_chunk_first")).cast("bigint"))
            rows = groups.settled(rows.filter(F.col("_new") == 0).unionByName(firsts.drop("_chunk_first")))
        return groups.running(rows, sums={"cars": F.col("_new")}).drop("_new")

    return _bounded(over_groups(rows, keys, list(order), counts, max_rows), size)
