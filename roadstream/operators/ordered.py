"""Neighbours and running totals inside ordered groups of any size.

A window function sorts a whole group in one task.  That is the best plan for
groups that fit, and impossible for a group that holds a large part of all
rows.  ``over_groups`` therefore measures the groups first (a count per key,
combined before its shuffle):

* groups of up to ``max_rows`` rows go through plain window functions;
* larger ones are cut by range partitioning on (keys, order) into chunks of
  about ``max_rows`` rows.  The chunk number is frozen by writing the rows to
  the shared folder.  Windows then run per chunk, and what crosses a chunk
  edge (one row or one total per chunk) is carried over by a small join.

Both ways give the same rows.  ``order`` has to be unique inside a group, as
for any reproducible ``row_number``.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstream.shared import freeze

GROUP_ROWS = 2_000_000
RANGE_ROWS = 200_000
LISTED_GROUPS = 1_000
CHUNK = "_chunk"
# The keys as one struct: structs of nulls are equal, so a group with a null
# key is a group like any other, in joins as well.
GROUP = "_group"


@dataclass(frozen=True)
class Ordered:
    """Rows grouped by ``keys`` and sorted by ``order``, perhaps in chunks."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunks: int = 0
    max_rows: int = GROUP_ROWS

    @property
    def chunked(self) -> bool:
        return self.chunks > 0

    def reordered(self, df: DataFrame, order: list[str]) -> tuple[DataFrame, "Ordered"]:
        """The same groups in another order; chunked rows are cut anew."""
        if not self.chunked:
            return df, Ordered(self.keys, tuple(order))
        return cut(df.drop(CHUNK), order, self.chunks, self.max_rows), Ordered(self.keys, tuple(order), self.chunks, self.max_rows)

    def settled(self, df: DataFrame) -> DataFrame:
        """Chunked rows written once, for results that several branches read."""
        return freeze(df, "settled") if self.chunked else df

    @property
    def group(self) -> list[str]:
        return [CHUNK, GROUP] if self.chunked else list(self.keys)

    def window(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def _chunks(self):
        """Order of the chunks of a group; at most one row per chunk."""
        return Window.partitionBy(GROUP).orderBy(CHUNK)

    def _attach(self, df: DataFrame, carried: DataFrame, names: list[str]) -> DataFrame:
        return df.join(carried.select(*self.group, *names), self.group, "left")

    def neighbours(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """Adds structs ``prev`` and ``next`` with ``columns`` of the adjacent rows."""
        row = F.struct(*columns)
        w = self.window()
        df = df.withColumns({"prev": F.lag(row).over(w), "next": F.lead(row).over(w)})
        if not self.chunked:
            return df
        at = F.struct(*self.order)
        edges = df.groupBy(*self.group).agg(
            F.min_by(row, at).alias("_first"), F.max_by(row, at).alias("_last"))
        edges = edges.withColumns({"_before": F.lag("_last").over(self._chunks()),
                                   "_after": F.lead("_first").over(self._chunks())})
        return (self._attach(df, edges, ["_before", "_after"])
                .withColumns({"prev": F.coalesce("prev", "_before"), "next": F.coalesce("next", "_after")})
                .drop("_before", "_after"))

    def running(self, df: DataFrame, sums: dict[str, Column] | None = None,
                maxima: dict[str, Column] | None = None) -> DataFrame:
        """Adds running sums and maxima up to and including each row."""
        sums, maxima = sums or {}, maxima or {}
        upto = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {n: F.sum(c).over(upto) for n, c in sums.items()}
        local |= {n: F.max(c).over(upto) for n, c in maxima.items()}
        out = df.withColumns(local)
        if not self.chunked:
            return out
        totals = df.groupBy(*self.group).agg(
            *[F.sum(c).alias(f"_c_{n}") for n, c in sums.items()],
            *[F.max(c).alias(f"_c_{n}") for n, c in maxima.items()])
        earlier = self._chunks().rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.withColumns(
            {f"_c_{n}": F.sum(f"_c_{n}").over(earlier) for n in sums}
            | {f"_c_{n}": F.max(f"_c_{n}").over(earlier) for n in maxima})
        carried = [f"_c_{n}" for n in (*sums, *maxima)]
        out = self._attach(out, totals, carried)
        return out.withColumns(
            {n: F.coalesce(f"_c_{n}", F.lit(0)) + F.coalesce(n, F.lit(0)) for n in sums}
            | {n: F.greatest(f"_c_{n}", n) for n in maxima}).drop(*carried)


def large_groups(df: DataFrame, keys: tuple[str, ...], max_rows: int) -> tuple[DataFrame | None, int]:
    """Keys of groups above ``max_rows`` and their row total, or ``(None, 0)``.

    Up to ``LISTED_GROUPS`` of them come with the measuring job itself.  More,
    at most ``rows / max_rows``, are written, so that the joins that follow see
    the true size of the list and pick broadcast or shuffle by it.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows)
    if not keys:
        row = counts.first()
        return (None, 0) if row is None else (counts, row["_rows"])
    large = counts.select(F.struct(*keys).alias(GROUP), "_rows")
    largest = large.orderBy(F.desc("_rows")).limit(LISTED_GROUPS + 1).collect()
    if not largest:
        return None, 0
    if len(largest) > LISTED_GROUPS:
        large = freeze(large, "large-groups")
        return large.select(GROUP), large.agg(F.sum("_rows")).first()[0]
    listed = df.sparkSession.createDataFrame(largest, large.schema)
    return listed.select(GROUP), sum(row["_rows"] for row in largest)


def cut(df: DataFrame, order: list[str], chunks: int, max_rows: int) -> DataFrame:
    """Cut into pieces of about ``max_rows`` rows, ``chunks`` of them at least, and freeze their numbers.

    Spark samples rows for every range in the driver, so short chunks share a
    range of ``RANGE_ROWS`` rows and are counted off in its sorted rows.
    """
    if max_rows >= RANGE_ROWS:
        ranged = df.repartitionByRange(chunks, GROUP, *order)
        return freeze(ranged.withColumn(CHUNK, F.spark_partition_id().cast("bigint")), "chunks")
    ranges = -(-chunks * max_rows // RANGE_ROWS)
    ranged = df.repartitionByRange(ranges, GROUP, *order).sortWithinPartitions(GROUP, *order)
    # The upper bits number the range and the lower 33 its rows.
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    first = F.shiftleft(F.shiftright("_at", 33), 33)
    piece = F.call_function("div", F.col("_at") - first, F.lit(max_rows))
    return freeze(ranged.withColumn(CHUNK, first + piece).drop("_at"), "chunks")


def over_groups(df: DataFrame, keys: list[str], order: list[str],
                body: Callable[[DataFrame, Ordered], DataFrame],
                max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Apply ``body`` to the ordered groups of ``df``.

    ``max_rows=None`` skips the measuring for callers who know their groups.
    """
    keys = tuple(keys)
    plain = Ordered(keys, tuple(order))
    if max_rows is None:
        return body(df, plain)
    large, rows = large_groups(df, keys, max_rows)
    if large is None:
        return body(df, plain)
    chunked = Ordered(keys, tuple(order), chunks=-(-rows // max_rows) + 1, max_rows=max_rows)
    if not keys:
        pieces = cut(df.withColumn(GROUP, F.struct(F.lit(0))), order, chunked.chunks, max_rows)
        return body(pieces, chunked).drop(CHUNK, GROUP)
    grouped = df.withColumn(GROUP, F.struct(*keys))
    rest = grouped.join(large, GROUP, "left_anti").drop(GROUP)
    pieces = cut(grouped.join(large, GROUP, "left_semi"), order, chunked.chunks, max_rows)
    return body(rest, plain).unionByName(body(pieces, chunked).drop(CHUNK, GROUP))
