"""Exact averages.

Speeds are summed as fixed-point integers.  Integer sums do not depend on the
order in which partial aggregates meet, so a re-run stage gives the same
digits, and half-up rounding of the mean is exact.  A speed counts with
``SPEED_DIGITS`` decimals, the digits after them are rounded; below
``SPEED_LIMIT``, which the parser sees to, nine billion speeds always fit a sum.
"""

from pyspark.sql import Column, functions as F

SPEED_DIGITS = 4
SPEED_LIMIT = 100_000.0
_UNIT = 10 ** SPEED_DIGITS


def speed_units(speed) -> Column:
    speed = F.col(speed) if isinstance(speed, str) else speed
    return F.round(speed * F.lit(float(_UNIT))).cast("bigint")


def mean2(units: Column, n: Column) -> Column:
    """Mean of ``n`` speeds summed as ``units``, rounded half-up to 2 decimals."""
    per_cent = F.lit(_UNIT // 100)
    half_up = F.call_function(
        "div", F.abs(units) * F.lit(2) + n * per_cent, n * per_cent * F.lit(2))
    return F.signum(units) * half_up / F.lit(100.0)

