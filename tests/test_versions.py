"""Appended and compacted tables, kept snapshots, and files that grow."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from roadstream.sinks.versions import VersionedTable
from roadstream.sources import dimensions
from roadstream.sources.tail import growing_lines
from roadstream.streaming import runner
from tests.conftest import rows

SCHEMA = StructType([StructField("k", StringType()), StructField("v", LongType())])


@pytest.fixture
def table(spark, tmp_path):
    def make(merge=None):
        return VersionedTable(spark, str(tmp_path / "table"), SCHEMA, merge)
    return make


@pytest.fixture
def some(spark):
    return lambda values: spark.createDataFrame(values, SCHEMA).coalesce(1)


def data_folders(path):
    return [x for x in path.iterdir() if x.name.startswith("data-")]


def test_many_batches_leave_few_folders(table, some, tmp_path):
    appended = table()
    assert rows(appended.read()) == []
    for batch in range(25):
        assert appended.append(some([("x", batch)]), batch)
        assert len(appended.folders()) <= 5
    for batch in (0, 13, 24):
        assert not appended.append(some([("again", batch)]), batch)
    assert rows(appended.read()) == [("x", n) for n in range(25)] or sorted(r[1] for r in rows(appended.read())) == list(range(25))
    assert [(x["low"], x["high"]) for x in appended.folders()] == [(0, 15), (16, 23), (24, 24)]
    assert len(data_folders(tmp_path / "table")) <= 5 and len(appended.versions()) == 2


def test_a_reader_keeps_its_version(table, some):
    """What was resolved before a compaction can be read after it, as it was."""
    newest = lambda df: df.groupBy("k").agg(F.max("v").alias("v"))
    upserted = table(newest)
    upserted.append(some([("a", 1), ("b", 1)]), 0)
    upserted.append(some([("a", 2)]), 1)
    upserted.append(some([("c", 5)]), 2)
    before = upserted.read()
    upserted.compact()
    assert rows(before) == rows(upserted.read()) == [("a", 2), ("b", 1), ("c", 5)]
    assert len(upserted.folders()) == 1
    upserted.append(some([("b", 9)]), 3)
    assert rows(upserted.read()) == [("a", 2), ("b", 9), ("c", 5)]
    old = upserted.versions()[0]
    assert rows(upserted.read(old)) == [("a", 2), ("b", 1), ("c", 5)]


def test_a_write_that_was_not_published_does_not_count(table, some, tmp_path):
    appended = table()
    appended.append(some([("a", 1)]), 0)
    appended._write(some([("lost", 1)]), 1, 1)  # the writer died here
    assert rows(appended.read()) == [("a", 1)]
    appended.append(some([("b", 2)]), 1)
    assert rows(appended.read()) == [("a", 1), ("b", 2)]
    assert not any("lost" in str(r) for r in rows(appended.read()))
    appended.append(some([("c", 2)]), 2)
    assert len(data_folders(tmp_path / "table")) <= 3


def test_refreshes_leave_two_folders(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(dimensions, "new_path", lambda spark, name: kept.append(str(tmp_path / f"{name}-{len(kept)}")) or kept[-1])
    table = dimensions.Refreshed(lambda: spark.range(len(kept) + 1), refresh_seconds=0)
    last = None
    for n in range(12):
        current = table()
        assert current.count() == n + 1 and (last is None or last.count() == n)
        last = current
    assert len(list(tmp_path.iterdir())) == 2


def test_changes_are_upserted(spark):
    log = [[("m1", 50, 1), ("m2", 60, 1)], [("m1", 80, 2)], [], [("m3", 30, 4), ("m1", 70, 3)]]
    asked = []

    def changes(since):
        asked.append(since)
        return spark.createDataFrame(log[len(asked) - 1], "monitor_id string, speed_limit int, version long")

    table = dimensions.Upserted(changes, ["monitor_id"], refresh_seconds=0)
    assert [rows(table(), "monitor_id", "speed_limit") for _ in log] == [
        [("m1", 50), ("m2", 60)], [("m1", 80), ("m2", 60)], [("m1", 80), ("m2", 60)], [("m1", 70), ("m2", 60), ("m3", 30)]]
    assert asked == [None, 1, 2, 2]


def test_growing_and_rotated_files(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "c")
    folder.mkdir()

    def drain():
        runner.to_parquet(growing_lines(spark, str(folder), split=7), out, checkpoint).awaitTermination()
        return [v for v, in rows(spark.read.schema("value string").parquet(out))]

    log = folder / "a.log"
    log.write_text("one\ntwo\nthr")
    (folder / "other.txt").write_text("no\n")
    assert drain() == ["one", "two"]
    with log.open("a") as file:
        file.write("ee\nfour, a longer line than a range\n")
    assert drain() == ["four, a longer line than a range", "one", "three", "two"]
    # Rotation: the old file gets its last lines under a new name, a new one starts.
    log.rename(folder / "a.log.1")
    with (folder / "a.log.1").open("a") as file:
        file.write("five\n")
    log.write_text("six\n\nsieben ü\n")
    assert drain() == ["", "five", "four, a longer line than a range", "one", "sieben ü", "six", "three", "two"]
    assert len(drain()) == 8
