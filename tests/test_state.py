"""Typed state, totals over micro-batches and chained counts of streams."""

import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from roadstream.functions.timing import MINUTE, SECOND
from roadstream.operators import batching, distinct, matching, sequence
from roadstream.plans import catalog, inputs, jobs
from roadstream.sources.parse import parse_passages, parse_police_actions, parse_violations
from roadstream.streaming import runner, stateful, totals
from tests.conftest import rows
from tests.test_streams import FAR, drain, feed, numbered, random_log, static, two_sides  # noqa: F401

PAIR = ["car", "first_id", "second_id", "first_monitor", "second_monitor", "msg", "action_time"]


@pytest.fixture
def run_rows(monkeypatch):
    """Runs of a few rows; the other stream tests have runs of usual size."""
    monkeypatch.setattr(stateful, "RUN_ROWS", 7)


def busy_log(seed, n=600, files=10, late=6000):
    """Half of all passages are of one plate, out of order by up to ``late`` ms."""
    pick = random.Random(seed)
    log = []
    for i in range(n):
        t = 1_592_722_000_000 + i * 300
        car = "busy" if pick.random() < 0.5 else f"car{pick.randrange(40)}"
        log.append((t + pick.randrange(late), f"{i};{t},m{pick.randrange(9)},c,{car},50.0,r,a{pick.randrange(2)}"))
    texts = [line for _, line in sorted(log)]
    step = -(-n // files)
    return [texts[at:at + step] for at in range(0, n, step)] + [["999999;" + FAR]]


def test_busy_plate_in_ten_files(spark, feed, drain, run_rows):
    log = busy_log(1)
    found = drain(stateful.cloned_plates(numbered(feed(log), parse_passages), 2, delay=8 * SECOND))
    want = sequence.cloned_plates(static(spark, log), 2)
    assert rows(found.filter("car <> 'end'"), *PAIR) == rows(want, *PAIR)
    assert want.filter("car = 'busy'").count() > 50


def test_cars_share_the_state_of_few_buckets(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "BUCKETS", 4, raising=False)
    log = [[line.replace("busy", f"one{n % 90}") for n, line in enumerate(part)] for part in busy_log(3)[:-1]]
    path = str(tmp_path / "rows")
    query = runner.to_parquet(stateful.cloned_plates(numbered(feed(log), parse_passages), 60, delay=8 * SECOND), path, path + "-checkpoint")
    query.awaitTermination()
    want = sequence.cloned_plates(static(spark, [*log, []]), 60).filter(f"action_time < {1_592_722_000_000 + 600 * 300 - 20_000}")
    found = spark.read.parquet(path)
    assert rows(found.join(want, PAIR, "left_semi"), *PAIR) == rows(want, *PAIR) and want.count() > 50
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 40


class Kept(dict):
    """State of one kind in memory; ``calls`` has what was read, by key, and what was written."""

    def __init__(self, calls):
        self.calls = calls

    def get(self):
        return self.getValue(None)

    def update(self, value):
        self.updateValue(None, value)

    def clear(self):
        self.removeKey(None)

    def getValue(self, key):
        self.calls.append(("read", key))
        return dict.get(self, key)

    def updateValue(self, key, value):
        self.calls.append(("written", value))
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


def test_rows_are_kept_as_one_value_and_read_when_reached(run_rows):
    calls = {name: [] for name in ("memory", "runs", "open")}
    kept = {name: Kept(calls[name]) for name in calls}
    handle = SimpleNamespace(getValueState=lambda name, *_: kept[name], getMapState=lambda name, *_: kept[name],
                             registerTimer=lambda at: None)
    taken, read = [], []

    def step(memory, row, out):
        taken.append(row)
        read.append(sum(kind == "read" for kind, _ in calls["runs"]))
        out.append(row)
        return [row]

    long, text = LongType(), StringType()
    inside = StructType([StructField(n, t) for n, t in [("t", long), ("key_hash", long), ("id", long), ("m", text), ("key", text)]])
    output = StructType([StructField(n, t) for n, t in [("key", text), ("t", long), ("id", long), ("m", text)]])
    processor = stateful._Sequence(inside, 3, output, step, lambda memory, now, out: (memory, None), None)
    processor.init(handle)
    blocks = [pd.DataFrame([(n, n % 5, n, None if n % 4 else "m", f"car{n % 5}") for n in range(first, 120, 3)],
                           columns=inside.names) for first in range(3)]
    at = lambda time: SimpleNamespace(getCurrentWatermarkInMs=lambda: time)
    assert not list(processor.handleInputRows((0,), iter(blocks), at(-1)))
    runs = len(kept["runs"])
    assert runs == 18 and not taken
    found = [frame for time in (60, 200) for frame in processor.handleExpiredTimer((0,), at(time), None)]
    assert [row[0] for row in taken] == list(range(120)) and read[0] <= 3 < runs
    assert pd.concat(found)["m"].tolist() == [None if n % 4 else "m" for n in range(120)]
    assert not kept["runs"]
    assert all(isinstance(value[0], bytes) for name in ("memory", "runs") for kind, value in calls[name] if kind == "written")


@pytest.mark.parametrize("files", [1, 4])
def test_parts_of_several_files_are_a_micro_batch_each(spark, tmp_path, monkeypatch, files):
    """Also where rows are too few for the files of a part."""
    monkeypatch.setattr(inputs, "files", lambda *_: files, raising=False)
    monkeypatch.setattr(catalog, "new_path", lambda spark, name: str(tmp_path / name))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts").limit(9)
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    stream, batches = catalog._in_files(spark, str(tmp_path), 3), []
    read = lambda batch, _: batches.append(sorted(r.id for r in batch.collect()))
    runner.to_batches(stream, read, str(tmp_path / "checkpoint")).awaitTermination()
    ids = [r.event_id for r in events.orderBy("event_id").collect()]
    assert batches == [ids[:3], ids[3:6], ids[6:]]
    assert len(list((tmp_path / "files").glob("part-*"))) == 3 * files


def test_busy_plate_in_order_of_arrival(spark, feed, drain, run_rows):
    log = [[f"{n * 10_000 + m};{line.partition(';')[2]}" for m, line in enumerate(part)] for n, part in enumerate(busy_log(2)[:-1])]
    want = sequence.cloned_plates_arrival(static(spark, [*log, []]), 2)
    assert want.filter("car = 'busy'").count() > 50
    stream = stateful.cloned_plates(numbered(feed(log), parse_passages), 2, arrival=True)
    assert rows(drain(stream), *PAIR) == rows(want, *PAIR)


def test_state_lists_and_values(spark, feed, drain, run_rows):
    """One-to-one matches wait for the watermark over several files."""
    v, p = two_sides(feed, 11)
    flat = lambda b: spark.createDataFrame([(t,) for part in b[:-1] for t in part], "value string")
    want = matching.match_with_timeout(numbered(flat(v), parse_violations), numbered(flat(p), parse_police_actions))
    found = drain(stateful.match_with_timeout(numbered(feed(v, "v"), parse_violations), numbered(feed(p, "p"), parse_police_actions),
                                              delay=200 * SECOND))
    assert rows(found.filter("car <> 'end'"), *want.columns) == rows(want)


def test_first_passages(spark, feed, drain):
    log = random_log(12)
    found = drain(stateful.first_passages(numbered(feed(log), parse_passages), MINUTE)).filter("car <> 'end'")
    want = distinct.running_distinct(static(spark, log), MINUTE)
    assert found.count() == want.count() and found.select("id").distinct().count() == want.count()
    firsts = found.filter("new").groupBy("area_id", "start_time").count()
    assert rows(firsts) == rows(distinct.distinct_cars_tumbling(static(spark, log), MINUTE).select("area_id", "start_time", "cars"))


@pytest.fixture
def stored(spark, tmp_path):
    """(write, read) of a folder per micro-batch."""
    path = str(tmp_path / "rows")
    return (lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/batch={batch}")), lambda: spark.read.parquet(path).drop("batch")


def test_running_distinct(spark, feed, stored, tmp_path, max_rows=20):
    log, (write, read) = random_log(13, n=120), stored
    totals.running_distinct(numbered(feed(log), parse_passages), 2 * MINUTE, write, str(tmp_path / "totals"), str(tmp_path / "c"),
                            max_rows=max_rows).awaitTermination()
    want = distinct.running_distinct(static(spark, log), 2 * MINUTE)
    assert rows(read().filter("car <> 'end'"), *want.columns) == rows(want)
    assert len([x for x in (tmp_path / "totals").iterdir() if x.name.startswith("batch-")]) <= 2


def test_totals_of_a_repeated_batch(spark, tmp_path):
    """A batch that runs again starts from the totals before it and replaces its own."""
    kept = totals.Totals(spark, str(tmp_path / "totals"))
    seen = {}

    def run(number, values):
        df = spark.createDataFrame([(k, n) for n, k in enumerate(values)], "k string, n long")
        totals.add_totals(df, number, kept, ["k"], ["n"], "upto", F.lit(1), lambda out, batch: seen.update({batch: rows(out, "k", "upto")}))

    run(0, ["a", "a", None])
    run(1, ["a", "b"])
    first = seen.pop(1)
    run(1, ["a", "b"])
    run(2, ["b", None])
    assert first == seen[1] == [("a", 3), ("b", 1)]
    assert seen[0] == [("a", 1), ("a", 2), (None, 1)] and seen[2] == [("b", 2), (None, 2)]
    run(3, [])
    run(4, ["a"])
    assert seen[3] == [] and seen[4] == [("a", 4)]


def test_numbers_go_on_over_files(spark, feed, stored, tmp_path):
    write, read = stored
    log = [[f"{n};{1_592_722_000_000 + n},m,c,x,1.0,r,a" for n in range(at, at + 13)] for at in range(0, 52, 13)]
    totals.count_batches(numbered(feed(log), parse_passages), ["action_time", "id"], write, str(tmp_path / "t"), str(tmp_path / "c"), 5,
                         max_rows=4).awaitTermination()
    want = batching.count_batches(static(spark, [*log, []]), ["action_time", "id"], 5)
    assert rows(read(), "id", "batch_id") == rows(want, "id", "batch_id")


def test_bloom_count(spark, feed, drain):
    log = random_log(14, n=120)
    few = {"bits": 16, "hash": "md5"}
    found = drain(distinct.distinct_cars_bloom(numbered(feed(log), parse_passages), MINUTE, **few)).filter("start_time < 2000000000000")
    want = distinct.distinct_cars_bloom(static(spark, log), MINUTE, **few)
    exact = distinct.distinct_cars_tumbling(static(spark, log), MINUTE).withColumnRenamed("cars", "exact")
    assert rows(found) == rows(want)
    both = found.join(exact, ["area_id", "start_time", "end_time"])
    assert both.filter("cars > exact").count() == 0 and both.count() == found.count()
    # Without numbers of arrival; in many bits cars hardly meet.
    lines = [[x.partition(";")[2] for x in part] for part in log]
    counted = drain(jobs.area_distinct_bloom(feed(lines, "plain"), MINUTE), "lines").filter("start_time < 2000000000000")
    assert rows(counted.select("area_id", "start_time", "end_time", "cars")) == rows(exact)
