"""Lookups against small reference tables, speed limits and projections."""

from pyspark.sql import Column, DataFrame, functions as F

from roadstream.operators.sizing import BROADCAST_ROWS, for_lookup

# Speeding thresholds and the limit of checkpoints without one.
ALERT_FACTOR = 1.1
DANGEROUS_FACTOR = 1.2
DEFAULT_LIMIT = 60


def to_track(passages: DataFrame) -> DataFrame:
    """Passage to track: no camera, car first."""
    return passages.select("car", "action_time", "monitor_id", "road_id", "area_id", "speed")


def overspeed_predicate(factor: float = ALERT_FACTOR, limit="limit_speed", speed="real_speed") -> Column:
    """Strictly more than ``factor`` times the limit, in DOUBLE arithmetic."""
    limit = F.col(limit) if isinstance(limit, str) else limit
    speed = F.col(speed) if isinstance(speed, str) else speed
    return limit * F.lit(float(factor)) < speed


def has_limit(monitors: DataFrame) -> DataFrame:
    """Checkpoints that have a speed limit; the filter reaches the scan."""
    return monitors.filter(F.col("speed_limit") > 0)


def _limits(monitors: DataFrame) -> DataFrame:
    return has_limit(monitors).select(
        F.col("monitor_id"), F.col("speed_limit").alias("limit_speed"))


def overspeed_alerts(passages: DataFrame, monitors: DataFrame, factor: float = ALERT_FACTOR,
                     broadcast_rows: int = BROADCAST_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Passages above ``factor`` times the limit of their checkpoint."""
    joined = passages.join(for_lookup(_limits(monitors), broadcast_rows), "monitor_id")
    return joined.filter(overspeed_predicate(factor, speed="speed")).select(
        "car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
        "limit_speed", "action_time", *keep)


def with_default_limit(passages: DataFrame, monitors: DataFrame, default: int = DEFAULT_LIMIT,
                       broadcast_rows: int = BROADCAST_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every passage with the limit of its checkpoint, or ``default`` without one."""
    joined = passages.join(for_lookup(_limits(monitors), broadcast_rows), "monitor_id", "left")
    return joined.select(
        "car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
        F.coalesce("limit_speed", F.lit(default)).cast("int").alias("limit_speed"),
        "action_time", *keep)


def in_violation_list(passages: DataFrame, listed: DataFrame,
                      broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Passages whose car is listed.  A semi join needs no distinct list."""
    return passages.join(for_lookup(listed.select("car"), broadcast_rows), "car", "left_semi")


def violation_tracks(passages: DataFrame, listed: DataFrame,
                     broadcast_rows: int = BROADCAST_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    found = in_violation_list(passages, listed, broadcast_rows)
    return found.select(*to_track(found).columns, *keep)


def upsert_dimension(changes: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Latest row per key.  Partial aggregation runs before the shuffle."""
    values = [c for c in changes.columns if c not in keys]
    latest = F.max_by(F.struct(*values), F.struct(*version)).alias("_latest")
    return changes.groupBy(*keys).agg(latest).select(*keys, "_latest.*")
