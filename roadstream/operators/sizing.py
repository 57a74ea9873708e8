"""Size checks in front of broadcasts."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure rows and bytes of ``df`` (one distributed aggregation)."""
    width = F.lit(8 * len(df.columns))
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def for_lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast when it measures small enough.

    Beyond the bound it is returned unmarked: the join then shuffles, and AQE
    splits the partitions of hot keys.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
