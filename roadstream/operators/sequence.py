"""Per-car event sequences: cloned plates and repeated dangerous driving."""

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadstream.functions import messages
from roadstream.functions.numeric import mean2, speed_units
from roadstream.functions.timing import MINUTE, gap_seconds
from roadstream.operators.enrich import DANGEROUS_FACTOR, overspeed_predicate
from roadstream.operators.ordered import GROUP_ROWS, Ordered, over_groups
from roadstream.shared import freeze

# Both sides of these joins grow with the passages.  Spark would take a frozen table for its compressed size on disk and
# send one that is many times larger as rows to every task by way of the driver.
SHUFFLED = "merge"


def numbered_runs(rows: DataFrame, groups: Ordered, columns: list[str], breaks: Column) -> DataFrame:
    """Splits every group where ``breaks`` holds and numbers the rows of each run.

    ``breaks`` may use ``prev`` (null on the first row of a group).  Adds
    ``prev``, ``next`` and ``position`` (from 1).
    """
    rows = groups.neighbours(rows, columns)
    rows = rows.withColumn("_break", F.col("prev").isNull() | breaks)
    rows = groups.running(rows, sums={"_at": F.lit(1).cast("bigint")})
    rows = groups.running(rows, maxima={"_run_at": F.when(F.col("_break"), F.col("_at"))})
    return (rows.withColumn("position", F.col("_at") - F.col("_run_at") + F.lit(1))
            .drop("_break", "_at", "_run_at"))


def cloned_plates(passages: DataFrame, max_gap_seconds: int = 10, car: str = "car",
                  order: tuple[str, ...] = ("action_time", "id"), monitor: str = "monitor_id",
                  max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Pairs of consecutive passages of one plate at most ``max_gap_seconds`` apart.

    Gaps are whole seconds rounded down, and a passage belongs to one pair at
    most.  ``first_id`` / ``second_id`` tell the rows apart.  On equal times both
    monitor columns name the later row's checkpoint.
    """
    time = order[0]

    def pairs(rows: DataFrame, groups: Ordered) -> DataFrame:
        gap = gap_seconds(F.col(time), F.col(f"prev.{time}"))
        numbered = numbered_runs(rows, groups, [*order, monitor], gap > max_gap_seconds)
        return numbered.filter(F.col("position") % 2 == 0).select(
            F.col(car), *_pair_ids(order),
            F.when(F.col(time) > F.col(f"prev.{time}"), F.col(f"prev.{monitor}"))
            .otherwise(F.col(monitor)).alias("first_monitor"),
            F.col(monitor).alias("second_monitor"),
            F.lit(messages.CLONED_PLATE).alias("msg"),
            F.col(time).alias("action_time"))

    needed = passages.select(car, *order, monitor)
    return over_groups(needed, [car], list(order), pairs, max_rows)


def cloned_plates_arrival(passages: DataFrame, max_gap_seconds: int = 10, max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Pairs in order of arrival (``id``), as the stream operator finds them with ``arrival``.

    A row waits for a partner; one more than the gap later takes its place, one
    more than the gap older is passed over.  A row that far after all that came
    before it waits whatever happened earlier, so a car's rows are cut there.
    The pieces are dealt out on their own and each is read once, row by row.
    """
    late = F.col("prev").isNull() | (gap_seconds(F.col("action_time"), F.col("prev._high")) > max_gap_seconds) & (
        F.col("action_time") > F.col("prev._high"))

    def pieces(rows: DataFrame, groups: Ordered) -> DataFrame:
        rows = groups.running(rows, maxima={"_high": F.col("action_time")})
        rows = groups.neighbours(rows, ["_high"]).withColumn("_cut", late.cast("bigint"))
        return groups.running(rows, sums={"_piece": F.col("_cut")})

    needed = passages.select("car", "id", "action_time", "monitor_id")
    cut = over_groups(needed, ["car"], ["id"], pieces, max_rows).select("car", "_piece", "id", "action_time", "monitor_id")
    dealt = cut.repartition("car", "_piece").sortWithinPartitions("car", "_piece", "id")

    def pairs(frames):
        piece, first = None, None
        for frame in frames:
            found = []
            for car, number, id_, time, monitor in frame.itertuples(index=False, name=None):
                if (car, number) != piece:
                    piece, first = (car, number), None
                if first is None or abs(time - first[1]) // 1000 > max_gap_seconds:
                    first = (id_, time, monitor) if first is None or time > first[1] else first
                    continue
                low = first[2] if first[1] < time else monitor
                high = first[2] if first[1] > time else monitor
                found.append((car, first[0], id_, low, high, messages.CLONED_PLATE, max(time, first[1])))
                first = None
            yield pd.DataFrame(found, columns=names)

    names = ["car", "first_id", "second_id", "first_monitor", "second_monitor", "msg", "action_time"]
    return dealt.mapInPandas(
        pairs, "car string, first_id long, second_id long, first_monitor string, second_monitor string, msg string, action_time long")


def _pair_ids(order: tuple[str, ...]) -> list[Column]:
    return [c for name in order[1:] for c in
            (F.col(f"prev.{name}").alias(f"first_{name}"), F.col(name).alias(f"second_{name}"))]


def _qualifying(passages, factor, car, order, speed, limit, monitor) -> DataFrame:
    return passages.filter(overspeed_predicate(factor, limit, speed)).select(
        car, *order, monitor, speed_units(speed).alias("_units"))


def fast_passages(passages: DataFrame, factor: float = DANGEROUS_FACTOR) -> DataFrame:
    """The passages that ``dangerous_drivers`` and ``qualifying`` use, written once so that both read only these."""
    return freeze(passages.filter(overspeed_predicate(factor)), "fast")


def _numbers() -> dict[str, Column]:
    """``seq`` (from 1) and the running total of speeds."""
    return {"seq": F.lit(1).cast("bigint"), "_upto": F.col("_units")}


def qualifying(passages: DataFrame, factor: float = DANGEROUS_FACTOR, car: str = "car",
               order: tuple[str, ...] = ("action_time", "id"), speed: str = "real_speed",
               limit: str = "limit_speed", monitor: str = "monitor_id",
               max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Passages above ``factor`` times the limit, numbered per car (``seq``)."""
    fast = _qualifying(passages, factor, car, order, speed, limit, monitor)
    number = lambda rows, groups: groups.running(rows, sums=_numbers())
    return over_groups(fast, [car], list(order), number, max_rows).select(car, *order, monitor, "seq")


def dangerous_drivers(passages: DataFrame, times: int = 3, within: int = 2 * MINUTE,
                      factor: float = DANGEROUS_FACTOR, mode: str = "maximal", car: str = "car",
                      order: tuple[str, ...] = ("action_time", "id"), speed: str = "real_speed",
                      limit: str = "limit_speed", monitor: str = "monitor_id",
                      max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Cars with at least ``times`` qualifying passages in less than ``within`` ms.

    ``maximal``: one row per last passage, with the longest run that ends there.
    ``all``: one row per run; the shorter runs that end at the same passage
    are listed as well.

    The longest run needs no self-join.  Each qualifying passage is placed a
    second time ``within`` ms earlier, as a probe for the left edge of its
    window; the newest passage at or before a probe is the last one too old
    for the run, and running totals give the run's length and mean speed.
    """
    if mode not in ("maximal", "all"):
        raise ValueError("mode must be maximal or all")
    time = order[0]
    place = ["_place", "_probe", *order]

    def runs(rows: DataFrame, groups: Ordered) -> DataFrame:
        row = F.struct(*order)
        rows = groups.neighbours(rows, list(order))
        rows = groups.running(rows, sums=_numbers(), maxima={"_car_first": F.when(F.col("prev").isNull(), row)})
        both = rows.withColumn("_probe", F.explode(F.array(F.lit(0), F.lit(1))))
        both = both.withColumn("_place", F.col(time) - F.col("_probe") * F.lit(within))
        both, edges = groups.reordered(both, place)
        real = F.col("_probe") == 0
        both = edges.running(both, maxima={
            "_old": F.when(real, F.col("seq")),
            "_old_upto": F.when(real, F.col("_upto")),
            "_first": F.when(real, F.col("next"))})
        old = F.coalesce("_old", F.lit(0))
        first = F.when(F.col("_old").isNull(), F.col("_car_first")).otherwise(F.col("_first"))
        found = both.filter(~real).withColumns({"n": F.col("seq") - old, "_start": first})
        return found.filter(F.col("n") >= times).select(
            car, *[F.col("_start")[c].alias(f"first_{c}") for c in order],
            *[F.col(c).alias(f"last_{c}") for c in order], "n",
            mean2(F.col("_upto") - F.coalesce("_old_upto", F.lit(0)), F.col("n")).alias("avg_speed"),
            (old + 1).alias("first_seq"), F.col("seq").alias("last_seq"))

    fast = _qualifying(passages, factor, car, order, speed, limit, monitor)
    longest = over_groups(fast, [car], list(order), runs, max_rows)
    if mode == "maximal":
        return longest
    numbered = qualifying(passages, factor, car, order, speed, limit, monitor, max_rows)
    each = longest.select(
        car, *[f"last_{c}" for c in order], "last_seq",
        F.explode(F.sequence("first_seq", F.col("last_seq") - F.lit(times - 1))).alias("first_seq"))
    starts = numbered.select(car, F.col("seq").alias("first_seq"), *[F.col(c).alias(f"first_{c}") for c in order])
    return each.join(starts.hint(SHUFFLED), [car, "first_seq"]).select(
        car, *[f"first_{c}" for c in order], *[f"last_{c}" for c in order],
        (F.col("last_seq") - F.col("first_seq") + F.lit(1)).alias("n"), "first_seq", "last_seq")


def alert_steps(alerts: DataFrame, numbered: DataFrame, car: str = "car",
                monitor: str = "monitor_id") -> DataFrame:
    """One row per alert and passage (``step`` from 1), for alerts of any length.

    ``numbered`` is the result of ``qualifying`` with the alerts' parameters.
    """
    steps = alerts.withColumn("_seq", F.explode(F.sequence("first_seq", "last_seq")))
    places = numbered.select(car, F.col("seq").alias("_seq"), monitor)
    return steps.join(places.hint(SHUFFLED), [car, "_seq"]).withColumn(
        "step", F.col("_seq") - F.col("first_seq") + F.lit(1)).drop("_seq")


def dangerous_lines(alerts: DataFrame, numbered: DataFrame, car: str = "car",
                    monitor: str = "monitor_id") -> DataFrame:
    """Alerts with their checkpoints in driving order and the warning text.

    The text names every passage of its run, so one row is as long as the run;
    ``alert_steps`` has the same content in rows.
    """
    keys = [car, "first_seq", "last_seq"]
    listed = alert_steps(alerts.select(*keys), numbered, car, monitor).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("step", monitor))).alias("_steps"))
    listed = listed.select(*keys, F.transform("_steps", lambda s: s[monitor]).alias("monitors"))
    return alerts.hint(SHUFFLED).join(listed, keys).withColumn("msg", messages.dangerous_line(F.col("monitors")))
