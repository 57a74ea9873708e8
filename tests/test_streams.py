"""Streams fed file by file, one micro-batch each, against batch results."""

import os
import random

import pytest
from pyspark.sql import functions as F

from roadstream.functions.timing import MINUTE, SECOND
from roadstream.operators import distinct, enrich, matching, sequence, windows
from roadstream.plans import jobs
from roadstream.schemas import MONITOR, VIOLATION_LIST
from roadstream.sinks import tables
from roadstream.sources import dimensions, lines as sources
from roadstream.sources.parse import parse_passages, parse_police_actions, parse_violations
from roadstream.streaming import runner, stateful
from tests.conftest import AVERAGE_LOG, LISTED, MONITORS, SPEEDING_LOG, rows


@pytest.fixture
def feed(spark, tmp_path):
    """feed(batches) -> stream of lines, one batch per file; ``id`` is the last field."""
    def make(batches, name="in"):
        folder = tmp_path / name
        folder.mkdir()
        for at, batch in enumerate(batches):
            file = folder / f"{at:04d}.log"
            file.write_text("\n".join(batch) + "\n")
            os.utime(file, (1_000_000 + at, 1_000_000 + at))
        return sources.file_lines(spark, str(folder), streaming=True, max_files_per_trigger=1)
    return make


@pytest.fixture
def drain(spark, tmp_path):
    def run(stream, name="out"):
        path = str(tmp_path / name)
        runner.to_parquet(stream, path, path + "-checkpoint").awaitTermination()
        return spark.read.schema(stream.schema).parquet(path)
    return run


def numbered(stream, parse):
    """``value`` is "id;line"."""
    return parse(stream.select(F.substring_index("value", ";", 1).cast("bigint").alias("id"),
                               F.substring_index("value", ";", -1).alias("value")))


FAR = "4592722028000,end,1,end,1.0,30,83"


def test_late_row_is_dropped_from_closed_windows_only(feed, drain):
    log = [["1592722148000,0001,1,x,1.0,30,83"], ["1592722149000,x,1,x,1.0,30,83"],
           ["1592722095000,0001,1,x,1.0,30,83"], ["1592725000000,z,1,x,1.0,30,83"], [FAR]]
    got = drain(jobs.average_speed(feed(log))).filter("monitor_id = '0001'")
    assert rows(got, "end_time", "car_count") == [
        (1592722200000, 2), (1592722260000, 2), (1592722320000, 2), (1592722380000, 2), (1592722440000, 1)]


def random_log(seed, n=240, late=4000):
    """Passages in slightly shuffled order, in micro-batches, with a far last row."""
    r = random.Random(seed)
    log = []
    for i in range(n):
        t = 1_592_722_000_000 + i * 1500
        log.append((t + r.randrange(late), f"{i};{{}},m{r.randrange(4)},c,car{r.randrange(5)},{r.randrange(1, 2000) / 10},r,a{r.randrange(2)}", t))
    texts = [line.format(t) for _, line, t in sorted(log)]
    return [texts[at:at + 30] for at in range(0, n, 30)] + [["999999;" + FAR]]


def static(spark, batches):
    flat = [line for batch in batches[:-1] for line in batch]
    return numbered(spark.createDataFrame([(t,) for t in flat], "value string"), parse_passages)


def same(stream_rows, batch_rows, columns, key="car"):
    assert rows(stream_rows.filter(F.col(key) != "end"), *columns) == rows(batch_rows, *columns)
    assert batch_rows.count() > 5


def test_average_speed(spark, feed, drain):
    log = random_log(1)
    speeds = windows.avg_speed_sliding(numbered(feed(log), parse_passages))
    batch = windows.avg_speed_sliding(static(spark, log))
    same(drain(speeds), batch, batch.columns, "monitor_id")


def test_top_congested(spark, feed, drain):
    log = random_log(2)
    top = windows.top_n_stream(numbered(feed(log), parse_passages), 2)
    batch = windows.top_n_monitors(windows.avg_speed_sliding(static(spark, log)), 2)
    same(drain(top), batch, batch.columns, "monitor_id")


def test_distinct_cars(spark, feed, drain):
    log = random_log(3)
    batch = distinct.distinct_cars_tumbling(static(spark, log), MINUTE)
    got = drain(distinct.distinct_cars_tumbling(numbered(feed(log), parse_passages), MINUTE))
    assert rows(got.filter("start_time < 2000000000000")) == rows(batch)


def test_running_approximate_count(spark, feed, tmp_path):
    """Update mode gives a new count whenever a window changes."""
    log = random_log(4)
    seen = []
    counts = distinct.distinct_cars_approx(numbered(feed(log), parse_passages), MINUTE)
    runner.to_batches(counts, lambda batch, i: seen.extend(batch.collect()), str(tmp_path / "c"), "update").awaitTermination()
    last = {}
    for row in seen:
        assert row["cars"] >= last.get((row["area_id"], row["start_time"]), 0)
        last[row["area_id"], row["start_time"]] = row["cars"]
    exact = distinct.distinct_cars_tumbling(static(spark, log), MINUTE)
    assert all(last[a, s] == n for a, s, n in rows(exact, "area_id", "start_time", "cars"))


def test_cloned_plates(spark, feed, drain):
    log = random_log(5)
    stream = stateful.cloned_plates(numbered(feed(log), parse_passages), 4, delay=5 * SECOND)
    batch = sequence.cloned_plates(static(spark, log), 4)
    same(drain(stream), batch, batch.columns)


def test_cloned_plates_in_order_of_arrival(feed, drain):
    log = [f"{i};{line}" for i, line in enumerate(SPEEDING_LOG[2:])]
    stream = stateful.cloned_plates(numbered(feed([log]), parse_passages), arrival=True)
    assert rows(drain(stream), "first_monitor", "second_monitor") == [("m1", "m2"), ("m4", "m3")]


def test_late_rows_of_cloned_plates(spark, feed, drain):
    """A car's row comes after other cars have moved the time on."""
    def line(id_, second, car):
        return f"{id_};{1700000000000 + second * 1000},m{id_},c,{car},50.0,r,a"

    batches = [[line(0, 30, "p")], [line(1, 38, "q")], [line(2, 35, "p")], [line(3, 38, "q2")], ["4;" + FAR]]
    for arrival in (False, True):
        stream = stateful.cloned_plates(numbered(feed(batches, f"late-{arrival}"), parse_passages), arrival=arrival)
        assert rows(drain(stream, f"out-{arrival}"), "car", "first_id", "second_id") == [("p", 0, 2)]


def test_dangerous_drivers(spark, feed, drain, make):
    log = random_log(6)
    for mode in ("maximal", "all"):
        limited = enrich.with_default_limit(numbered(feed(log, "in-" + mode), parse_passages), make.monitors(), keep=("id",))
        stream = stateful.dangerous_drivers(limited, within=30_000, mode=mode)
        batch = sequence.dangerous_drivers(
            enrich.with_default_limit(static(spark, log), make.monitors(), keep=("id",)), within=30_000, mode=mode)
        same(drain(stream, "out-" + mode), batch, ["car", "first_id", "last_id", "n"])


def test_dangerous_drivers_lists_checkpoints(feed, drain, make):
    log = [f"{i};{line}" for i, line in enumerate(AVERAGE_LOG)]
    stream = jobs.dangerous_drivers(feed([log, ["9;" + FAR]]).select(
        F.substring_index("value", ";", 1).cast("bigint").alias("id"), F.substring_index("value", ";", -1).alias("value")),
        make.monitors())
    got = drain(stream)
    assert rows(got, "n", "monitors") == [
        (3, ["0001", "0001", "0008"]), (4, ["0001", "0001", "0008", "0009"])]
    assert got.filter("n = 3").first()["msg"] == (
        "该车辆涉嫌危险驾驶,第1个经过卡口是:0001 -->第2个经过卡口是:0001 -->第3个经过卡口是:0008 -->")


def test_live_average_speed_and_top_lines(spark, feed, tmp_path, drain, make):
    log = [AVERAGE_LOG, [FAR]]
    out = str(tmp_path / "speeds")
    jobs.live_average_speed(feed(log), out, str(tmp_path / "c")).awaitTermination()
    batch = jobs.average_speed(make.lines(AVERAGE_LOG))
    assert rows(tables.read_average_speed(spark, out).drop("batch")) == rows(batch.select("start_time", "end_time", "monitor_id", "avg_speed", "car_count"))
    lines = drain(jobs.top_congested_lines(feed(log, "again")))
    assert rows(lines) == rows(jobs.top_congested_lines(make.lines(AVERAGE_LOG)))


def two_sides(feed, seed):
    r = random.Random(seed)
    sides = {"v": [], "p": []}
    for i in range(160):
        t, car, side = 1_592_722_000_000 + i * 1000, f"car{r.randrange(4)}", r.choice("vp")
        sides[side].append(f"{i};{car},speeding,{t}" if side == "v" else f"{i};J{i},{car},done,{t}")
    cut = lambda log: [log[at:at + 20] for at in range(0, len(log), 20)]
    v = cut(sides["v"]) + [["9000;end,speeding,4592722028000"]]
    p = cut(sides["p"]) + [["9001;J1,end,done,4592722028000"]]
    return v, p


def test_match_with_timeout(spark, feed, drain):
    v, p = two_sides(feed, 7)
    flat = lambda b: spark.createDataFrame([(t,) for part in b[:-1] for t in part], "value string")
    batch = matching.match_with_timeout(numbered(flat(v), parse_violations), numbered(flat(p), parse_police_actions))
    # Files of the two sides do not cover the same times, so allow for the lag.
    stream = stateful.match_with_timeout(numbered(feed(v, "v"), parse_violations), numbered(feed(p, "p"), parse_police_actions),
                                         delay=200 * SECOND)
    same(drain(stream), batch, batch.columns)


def test_interval_join_and_outer_match(spark, feed, drain):
    v, p = two_sides(feed, 8)
    flat = lambda b: spark.createDataFrame([(t,) for part in b[:-1] for t in part], "value string")
    args = [numbered(flat(v), parse_violations), numbered(flat(p), parse_police_actions)]
    batch = matching.interval_join(args[0].drop("id"), args[1].drop("id"))
    stream = matching.interval_join(numbered(feed(v, "v"), parse_violations).drop("id"),
                                    numbered(feed(p, "p"), parse_police_actions).drop("id"), delay=200 * SECOND)
    same(drain(stream), batch, batch.columns)
    outer = matching.match_outer(numbered(feed(v, "v2"), parse_violations), numbered(feed(p, "p2"), parse_police_actions),
                                 delay=200 * SECOND)
    found = drain(outer, "outer").filter("car != 'end'")
    want = matching.match_outer(*args)
    assert rows(found) == rows(want)
    assert {o for o, in rows(want.select("outcome").distinct())} == {"matched", "no_violation", "no_police_action"}


def test_speed_limits_are_read_again(spark, feed, tmp_path):
    table = str(tmp_path / "monitors")
    spark.createDataFrame(MONITORS[:1], MONITOR).write.parquet(table)
    load = dimensions.parquet_loader(spark, MONITOR, table)
    calls = []

    def loader():
        calls.append(1)
        if len(calls) == 2:
            spark.createDataFrame(MONITORS[1:], MONITOR).write.mode("append").parquet(table)
        return load()

    out = str(tmp_path / "alerts")
    log = feed([SPEEDING_LOG[2:3], SPEEDING_LOG[2:3], SPEEDING_LOG[3:]])
    jobs.live_overspeed(log, loader, out, str(tmp_path / "c"), refresh_seconds=0).awaitTermination()
    assert rows(tables.read_speeding(spark, out), "batch", "monitor_id") == [
        (1, "m1"), (2, "m2"), (2, "m2")]


def test_refresh_interval(spark):
    reads = []
    def load():
        reads.append(1)
        return spark.range(len(reads))

    table = dimensions.Refreshed(load, refresh_seconds=1000)
    assert [table().count() for _ in range(3)] == [1, 1, 1] and len(reads) == 1
    always = dimensions.Refreshed(load, refresh_seconds=0)
    assert [always().count(), always().count()] == [2, 3]


def test_live_tracks_and_live_clones(spark, feed, tmp_path):
    listed = lambda: spark.createDataFrame([*LISTED, ("RED-7", "x", None)], VIOLATION_LIST)
    out = str(tmp_path / "tracks")
    jobs.live_violation_tracks(feed([SPEEDING_LOG[:5], SPEEDING_LOG[5:]]), listed, out, str(tmp_path / "c")).awaitTermination()
    assert tables.track_table(spark, out).read().count() == 5
    log = [f"{i};{line}" for i, line in enumerate(SPEEDING_LOG)]
    lines = feed([log, ["99;" + FAR]], "again").select(
        F.substring_index("value", ";", 1).cast("bigint").alias("id"), F.substring_index("value", ";", -1).alias("value"))
    stored = str(tmp_path / "violations")
    jobs.live_cloned_plates(lines, stored, str(tmp_path / "c2")).awaitTermination()
    assert rows(spark.read.parquet(stored), "car", "create_time") == [("BLUE-1", 1700000007000), ("RED-7", 1700000034000)]


def test_outcomes_go_to_their_own_writers(spark, make):
    got = {}
    write = lambda name: lambda rows_, batch: got.setdefault(name, rows_.count())
    each = runner.split_outcomes({"matched": write("matched"), "no_violation": write("alone")})
    each(spark.createDataFrame([("matched",), ("no_violation",), ("no_violation",)], "outcome string"), 0)
    assert got == {"matched": 1, "alone": 2}


def test_console_sink(feed, make, capsys, tmp_path):
    runner.print_rows(feed([SPEEDING_LOG]), "log", checkpoint=str(tmp_path / "c")).awaitTermination()
    runner.print_rows(make.lines(SPEEDING_LOG), "table")
    assert "table" in capsys.readouterr().out


def test_tailed_folder_takes_log_files_only(spark, tmp_path, drain):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("1\n2\n")
    (tmp_path / "in" / "a.txt").write_text("3\n")
    assert rows(drain(sources.tail_folder(spark, str(tmp_path / "in")))) == [("1",), ("2",)]
    numbers = sources.file_lines(spark, str(tmp_path / "in"), glob="*log", arrival_id=True)
    assert [v for v, _ in sorted(rows(numbers), key=lambda r: r[1])] == ["1", "2"]


def test_line_numbers_follow_file_time(spark, tmp_path):
    for at, (name, n) in enumerate((("b.log", 1), ("a.log", 400), ("c.log", 3))):
        file = tmp_path / name
        file.write_text("".join(f"{name}{i}\n" for i in range(n)))
        os.utime(file, (1_000_000 + at, 1_000_000 + at))
    numbers = sources.file_lines(spark, str(tmp_path), glob="*log", arrival_id=True)
    want = [f"{name}{i}" for name, n in (("b.log", 1), ("a.log", 400), ("c.log", 3)) for i in range(n)]
    assert sorted((i, v) for v, i in rows(numbers)) == list(enumerate(want))


def test_topic_rows_have_unique_places(spark):
    topic = spark.createDataFrame([(p, o) for p in (0, 1, 300) for o in (0, 1, 1 << 43)], "partition int, offset bigint")
    places = topic.select(sources.place(F.col("partition"), F.col("offset")), "partition", "offset").orderBy("id").collect()
    assert [tuple(r)[1:] for r in places] == sorted((r["partition"], r["offset"]) for r in places)
    assert len({r["id"] for r in places}) == 9
    with pytest.raises(ValueError):
        sources.file_lines(spark, "/", streaming=True, arrival_id=True)


def test_topic_options():
    assert sources.kafka_source_options("node:9092", "passages", "speeding", max_offsets_per_trigger=5) == {
        "kafka.bootstrap.servers": "node:9092", "subscribe": "passages", "startingOffsets": "earliest",
        "kafka.group.id": "speeding", "maxOffsetsPerTrigger": "5"}
    assert sources.kafka_sink_options("node:9092", "passages") == {"kafka.bootstrap.servers": "node:9092", "topic": "passages"}
    assert dimensions.jdbc_options("jdbc:x", "t", user="u", password="p", fetchsize="10") == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "10", "user": "u", "password": "p"}
