"""Fixed-size batches of rows."""

from pyspark.sql import DataFrame, functions as F

from roadstream.operators.ordered import GROUP_ROWS, Ordered, over_groups

BATCH_ROWS = 10


def count_batches(rows: DataFrame, order: list[str], size: int = BATCH_ROWS, keep_partial: bool = True,
                  max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Numbers rows in ``order`` and adds ``batch_id`` (from 0) per ``size`` rows.

    More than ``max_rows`` rows are numbered in chunks, so no task sorts the
    whole table.  Without ``keep_partial`` the last batch is left out unless
    it is full.
    """
    def number(rows: DataFrame, groups: Ordered) -> DataFrame:
        return groups.running(rows, sums={"_at": F.lit(1).cast("bigint")})

    numbered = over_groups(rows, [], order, number, max_rows)
    if not keep_partial:
        numbered = numbered.filter(F.col("_at") <= rows.count() // size * size)
    return numbered.withColumn("batch_id", F.call_function("div", F.col("_at") - F.lit(1), F.lit(size))).drop("_at")
