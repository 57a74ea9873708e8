"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from roadstream.plans import catalog
from roadstream.shared import freeze, release, shared_folder

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(contract.queries())


def test_entry(spark):
    top = contract.entry(spark)
    assert top.columns == ["start_time", "end_time", "area_id", "avg_speed", "car_count", "rank"]
    assert top.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    want = duck.sql(contract.oracle_sql()[name])
    assert sorted(want.columns) == columns
    places = [want.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[p] for p in places)) for r in want.fetchall())
    assert got


def test_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert freeze(spark.range(5), "x").count() == 5
    release(spark)
    assert shared_folder(spark) != folder
