"""Exact top-k inner products by tiles of queries and shards.

Vectors become whole numbers, floor(scale * x).  Queries are dealt into tiles and all rows into shards; every pair of
a tile and a shard is one task's matrix product, of which only each query's best k are selected.  Partial lists
are merged in two levels, so that no query's lists meet in one place at once.

Vectors that are null or hold null or non-finite components (also once scaled) take no part, nor do rows without a key.  Vectors of
different lengths are not compared; empty ones score 0 among themselves.  A key that repeats is one query (its row
with the smallest vector), and none of its rows is its own candidate.  Equal rows are candidates of their own.
Products run in 64-bit floats while every partial sum is exact there, in Python's whole numbers beyond; a score that
no long holds is given as the nearest long, and scores beyond 10^37 rank as equal.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstream.llm.texts import small_batches
from roadstream.shared import freeze

TILE_ROWS = 8192
SHARD_ROWS = 8192
WHOLE = 1 << 53
LONG = (1 << 63) - 1
HIGHEST = 10**37


def usable(vectors: DataFrame, key: str, vector: str, scale: float = 1.0) -> DataFrame:
    """(vec_id, vector, dim) of the rows that take part."""
    rows = vectors.select(vectors[key].cast("long").alias("vec_id"), vectors[vector].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        "vec_id", "vector", F.size("vector").alias("dim"))


def _packed(rows: DataFrame, scale: float) -> DataFrame:
    """Components as whole numbers, in the bytes of 64-bit floats (they hold the product's floor exactly)."""
    small_batches(rows.sparkSession)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
            ends = np.cumsum(np.diff(np.asarray(column.offsets)))
            starts = np.concatenate([[0], ends[:-1]]).astype(int)
            body = pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), body, batch.column(2)], ["vec_id", "body", "dim"])

    return rows.mapInArrow(run, "vec_id long, body binary, dim int")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in whole numbers, as 64-bit integers, or as Python's where those do not hold them."""
    reach = np.abs(left).max(initial=0.0) * np.abs(right).max(initial=0.0) * max(1, left.shape[1])
    if reach < WHOLE:
        return (left @ right.T).astype(np.int64)
    exact = [np.array([[int(x) for x in row] for row in side], dtype=object).reshape(side.shape) for side in (left, right)]
    return exact[0] @ exact[1].T if left.shape[1] else np.zeros((len(left), len(right)), dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row of scores, (ids, scores) of the k best without ``own``; ties to smaller ids.  ``ids`` ascend."""
    found = []
    for row, query in zip(scores, own):
        keep = ids != query
        row, names = row[keep], ids[keep]
        if len(row) > k:
            if row.dtype != object:
                least = np.partition(row, len(row) - k)[len(row) - k]
                near = np.flatnonzero(row >= least)
                row, names = row[near], names[near]
        order = np.argsort(-row, kind="stable")[:k]
        found.append((names[order], row[order]))
    return found


def _cell(k: int):
    def run(key, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(shard):
            shard = shard.sort_values("row_id", kind="stable")
            width = int(key[-1])
            ids = shard["row_id"].to_numpy()
            right = np.frombuffer(b"".join(shard["row_body"]), dtype=np.float64).reshape(len(shard), width)
            for at in range(0, len(queries), 512):
                part = queries.iloc[at:at + 512]
                left = np.frombuffer(b"".join(part["body"]), dtype=np.float64).reshape(len(part), width)
                own = part["vec_id"].to_numpy()
                for query, (names, scores) in zip(own, best(products(left, right), ids, own, k)):
                    out += [(int(query), int(x), str(max(-HIGHEST, min(HIGHEST, int(s))))) for x, s in zip(names, scores)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding",
          tile: int = TILE_ROWS, shard: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): per query its k best rows.

    queries: a condition on ``vec_id`` that tells queries.  tile, shard: rows of a tile and of a shard.
    """
    rows = freeze(_packed(usable(vectors, key, vector, scale), scale), "vectors")
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(queries, 1))).first()
    shards, tiles = max(1, -(-total // shard)), max(1, -(-asked // tile))
    # Each tile meets each shard once: a shard is sent to every tile, which are few, and a tile to every shard.
    right = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards))).withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.col("vec_id").alias("row_id"), F.col("body").alias("row_body"), "shard", "tile", F.col("dim").alias("width"))
    left = rows.filter(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "body")).alias("row"))
    left = left.select("vec_id", "row.body", "row.dim", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(tiles)).cast("int").alias("tile"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    cell = ["shard", "tile", "dim"]
    partial = left.groupBy(cell).cogroup(right.groupBy("shard", "tile", "width")).applyInPandas(_cell(k), "query_id long, vec_id long, score string")
    partial = partial.select("query_id", "vec_id", F.col("score").cast("decimal(38,0)").alias("score"))
    order = [F.col("score").desc(), F.col("vec_id")]

    def merge(lists: DataFrame, *by: str) -> DataFrame:
        ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.filter(F.col("rank") <= k)

    if shards > 16:
        partial = merge(partial.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(16))), "query_id", "part").drop("rank", "part")
    limit = F.lit(LONG).cast("decimal(38,0)")
    return merge(partial, "query_id").select(
        "query_id", "rank", "vec_id", F.greatest(F.least("score", limit), -limit).cast("long").alias("score"))
