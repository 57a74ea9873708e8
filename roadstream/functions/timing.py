"""Epoch-millisecond arithmetic."""

from pyspark.sql import Column, functions as F

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

LONG_MAX = (1 << 63) - 1


def to_ms(ts) -> Column:
    """Timestamp (with or without zone) to epoch milliseconds, truncating."""
    return F.unix_millis(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def to_timestamp(ms) -> Column:
    """Epoch milliseconds to the TIMESTAMP that watermarks need."""
    return F.timestamp_millis(ms)


def window_start(ms, width: int) -> Column:
    """Start of the epoch-aligned tumbling window ``[start, start + width)``."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return ms - F.pmod(ms, F.lit(width))


def gap_seconds(a: Column, b: Column) -> Column:
    """Absolute distance in whole seconds, rounded down."""
    return F.floor(F.abs(a - b) / F.lit(1000)).cast("bigint")


def local_day(ms) -> Column:
    """Calendar day of an instant in the session time zone."""
    return F.to_date(F.timestamp_millis(ms))


def newest_first_key(car, ms) -> Column:
    """``car_(LONG_MAX - t)``: sorts one car's rows newest first."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.concat(car, F.lit("_"), (F.lit(LONG_MAX).cast("decimal(20,0)") - ms.cast("decimal(20,0)")).cast("string"))
