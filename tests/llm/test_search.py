"""Exact top-k against all products."""

import random

import pytest
from pyspark.sql import functions as F

from roadstream.llm import topk
from roadstream.shared import ship_package

SCHEMA = "vec_id long, embedding array<float>, label int, score string, shard long, dim int"


@pytest.fixture(scope="module")
def table(spark):
    ship_package(spark)
    return lambda rows: spark.createDataFrame([(k, v, 1, "s", 5, 6) for k, v in rows], SCHEMA).repartition(3)


def brute(rows, every, k):
    import math

    usable = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted(usable):
        if i % every == 0 and (i not in queries or (len(v), v) < (len(queries[i]), queries[i])):
            queries[i] = v
    out = []
    for q, v in queries.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("tile, shard", [(8192, 8192), (7, 30), (1, 9)])
def test_top_k(table, tile, shard):
    pick = random.Random(4)
    rows = [(i, [round(pick.uniform(-1, 1), 1) for _ in range(4)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)]  # equal vectors: ties
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * 4), (403, [float("inf")] * 4), (None, [1.0] * 4),
             (450, [1.0, 2.0]), (451, [2.0, 2.0]), (500, []), (501, []), (550, [0.5] * 4), (551, [9.0] * 4), (551, [9.0] * 4)]
    got = topk.top_k(table(rows), F.col("vec_id") % 50 == 0, 5, tile=tile, shard=shard)
    rounded = [(i, None if v is None else [x if x is None else float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(rounded, 50, 5)


def test_large_numbers_and_few_rows(spark):
    ship_package(spark)
    rows = spark.createDataFrame([(0, [2.0**45, 1.0]), (1, [2.0**20, 3.0]), (2, [1e300, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(rows, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert got == [(0, 1, 2, topk.LONG), (0, 2, 1, topk.LONG)]
    small = rows.filter("vec_id < 2").withColumn("embedding", F.transform("embedding", lambda x: x / 2.0**20))
    whole = [(2**33, 0), (256, 0)]
    assert topk.top_k(small, F.col("vec_id") == 0).first().score == whole[0][0] * whole[1][0]


def test_empty_table(table):
    assert topk.top_k(table([]), F.col("vec_id") % 50 == 0).collect() == []
