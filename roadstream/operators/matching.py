"""Violations against police actions: interval join and one-to-one matching."""

from pyspark.sql import Column, DataFrame, functions as F

from roadstream.functions import messages
from roadstream.functions.timing import SECOND
from roadstream.operators.ordered import GROUP_ROWS, Ordered, over_groups
from roadstream.operators.sequence import numbered_runs
from roadstream.operators.windows import with_event_time

MATCHED = "matched"
NO_POLICE_ACTION = "no_police_action"
NO_VIOLATION = "no_violation"


def _celled(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
            low: int, high: int) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a time cell, and the condition of being near.

    The time is cut into cells as wide as the interval.  A left row has one
    cell, a right row those of the left rows it can be near to (at most two),
    so a pair meets in exactly one cell and a frequent key is spread over time.
    """
    width = F.lit(high - low + 1)

    def cell(time: Column) -> Column:
        return F.floor(time / width).cast("bigint")

    first, last = cell(F.col(right_time) - F.lit(high)), cell(F.col(right_time) - F.lit(low))
    left = left.withColumn("_cell", cell(F.col(left_time))).alias("l")
    right = right.withColumn("_cell", F.explode(F.sequence(first, last))).alias("r")
    distance = F.col(f"r.{right_time}") - F.col(f"l.{left_time}")
    near = ((F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l._cell") == F.col("r._cell"))
            & distance.between(low, high))
    return left, right, near


def _within(left_at: str, right_at: str, low: int, high: int) -> Column:
    """The interval as a condition on event times, which bounds a stream's state."""
    return (F.expr(f"{right_at} >= {left_at} + INTERVAL '{low / 1000}' SECOND")
            & F.expr(f"{right_at} <= {left_at} + INTERVAL '{high / 1000}' SECOND"))


def interval_join(left: DataFrame, right: DataFrame, low: int = -5 * SECOND, high: int = 5 * SECOND,
                  key: str = "car", left_time: str = "create_time", right_time: str = "action_time",
                  delay: int = 2 * SECOND) -> DataFrame:
    """All pairs of equal ``key`` with ``right_time`` in ``left_time + [low, high]``.

    On tables AQE splits cells that are still skewed; streams use both
    watermarks.
    """
    values = [F.col(f"r.{c}") for c in right.columns if c != key]
    streaming = left.isStreaming or right.isStreaming
    if streaming:
        left = with_event_time(left, left_time, delay, "_left_at")
        right = with_event_time(right, right_time, delay, "_right_at")
    left, right, near = _celled(left, right, key, left_time, right_time, low, high)
    if streaming:
        near = near & _within("_left_at", "_right_at", low, high)
    return left.join(right, near).select("l.*", *values).drop("_cell", "_left_at")


def handled_lines(pairs: DataFrame) -> DataFrame:
    """Text line per pair of ``interval_join``."""
    return pairs.withColumn("line", messages.handled_line(
        F.col("car"), F.col("police_id"), F.col("action_status"), F.col("action_time")))


def match_with_timeout(violations: DataFrame, police: DataFrame, timeout: int = 5 * SECOND,
                       tie: str = "id", max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Pairs a violation with the police action next to it in its car's history.

    Either may come first, at most ``timeout`` ms apart, and each row belongs
    to one pair at most.  ``outcome`` tells pairs from rows left alone.  A
    lone row is ``superseded`` when the next row of the same kind follows
    within ``timeout``.
    """
    sides = violations.select(
        "car", F.col("create_time").alias("_time"), F.lit("V").alias("_kind"), F.col(tie).alias("_tie"),
        F.col("msg"), F.lit(None).cast("string").alias("police_id"), F.lit(None).cast("string").alias("action_status"))
    sides = sides.unionByName(police.select(
        "car", F.col("action_time").alias("_time"), F.lit("P").alias("_kind"), F.col(tie).alias("_tie"),
        F.lit(None).cast("string").alias("msg"), "police_id", "action_status"))
    order = ["_time", "_kind", "_tie"]

    def outcomes(rows: DataFrame, groups: Ordered) -> DataFrame:
        same = F.col("_kind") == F.col("prev._kind")
        late = F.col("_time") - F.col("prev._time") > timeout
        numbered = numbered_runs(rows, groups, [*order, "msg", "police_id", "action_status"], same | late)
        soon = F.col("next._time") - F.col("_time") <= timeout
        alone = F.col("next").isNull() | (F.col("next._kind") == F.col("_kind")) | ~soon
        paired = F.col("position") % 2 == 0
        outcome = (F.when(paired, MATCHED).when(F.col("_kind") == "V", NO_POLICE_ACTION).otherwise(NO_VIOLATION))

        def of(kind: str, name: str) -> Column:
            return F.when(F.col("_kind") == kind, F.col(name)).when(paired, F.col(f"prev.{name}"))

        return numbered.filter(paired | alone).select(
            "car", outcome.alias("outcome"),
            of("V", "_tie").alias("violation_id"), of("V", "_time").alias("create_time"), of("V", "msg").alias("msg"),
            of("P", "_tie").alias("action_id"), of("P", "_time").alias("action_time"),
            of("P", "police_id").alias("police_id"), of("P", "action_status").alias("action_status"),
            F.coalesce(~paired & (F.col("next._kind") == F.col("_kind")) & soon, F.lit(False)).alias("superseded"))

    return over_groups(sides, ["car"], order, outcomes, max_rows)


def match_outer(violations: DataFrame, police: DataFrame, timeout: int = 5 * SECOND,
                delay: int = 2 * SECOND) -> DataFrame:
    """Relational variant: full outer join within ``timeout``, for tables and streams.

    It is many-to-many: a row counts as alone only when no row of the other
    side is near.  ``match_with_timeout`` is one-to-one.
    """
    violations = violations.select("car", "msg", "create_time")
    police = police.select("police_id", "car", "action_status", "action_time")
    columns = ["car", "outcome", "create_time", "msg", "action_time", "police_id", "action_status"]
    if violations.isStreaming or police.isStreaming:
        left = with_event_time(violations, "create_time", delay, "_v_at").alias("v")
        right = with_event_time(police, "action_time", delay, "_p_at").alias("p")
        near = (F.col("v.car") == F.col("p.car")) & _within("_v_at", "_p_at", -timeout, timeout)
        outcome = (F.when(F.col("p.car").isNull(), NO_POLICE_ACTION).when(F.col("v.car").isNull(), NO_VIOLATION)
                   .otherwise(MATCHED))
        joined = left.join(right, near, "full_outer")
        return joined.select(F.coalesce("v.car", "p.car").alias("car"), outcome.alias("outcome"), *columns[2:])

    def alone(side: DataFrame, other: DataFrame, time: str, other_time: str) -> DataFrame:
        left, right, near = _celled(side, other, "car", time, other_time, -timeout, timeout)
        return left.join(right, near, "left_anti").drop("_cell")

    parts = [interval_join(violations, police, -timeout, timeout).withColumn("outcome", F.lit(MATCHED)),
             alone(violations, police, "create_time", "action_time").withColumn("outcome", F.lit(NO_POLICE_ACTION)),
             alone(police, violations, "action_time", "create_time").withColumn("outcome", F.lit(NO_VIOLATION))]
    matched, *rest = parts
    for part in rest:
        matched = matched.unionByName(part, allowMissingColumns=True)
    return matched.select(*columns)


def matched_lines(outcomes: DataFrame) -> DataFrame:
    """Text line of each pair; the label of the report for rows left alone."""
    line = (F.when(F.col("outcome") == MATCHED, messages.matched_line(
        F.col("car"), F.col("create_time"), F.col("police_id"), F.col("action_status"), F.col("action_time")))
        .when(F.col("outcome") == NO_VIOLATION, F.lit(messages.NO_VIOLATION_LABEL))
        .otherwise(F.lit(messages.NO_POLICE_LABEL)))
    return outcomes.withColumn("line", line)
