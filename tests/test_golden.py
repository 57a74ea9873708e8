"""Known inputs with known results, one or more per operator."""

import pytest
from pyspark.sql import functions as F

from roadstream.functions.timing import HOUR, MINUTE
from roadstream.operators import batching, distinct, enrich, sequence, windows
from roadstream.plans import jobs
from roadstream.schemas import PASSAGE, VIOLATION
from roadstream.sinks import tables
from roadstream.sources import parse
from tests.conftest import AVERAGE_LOG, SPEEDING_LOG, rows


def test_average_speed_first_window(make):
    speeds = jobs.average_speed(make.lines(AVERAGE_LOG)).filter("end_time = 1592722080000")
    assert rows(speeds) == [(1592721780000, 1592722080000, "0001", 116.3, 2),
                            (1592721780000, 1592722080000, "0008", 116.3, 1)]


def test_sliding_windows_with_uneven_slide(make):
    passages = make.passages([(i, t, "x", "m", 10.0, "a") for i, t in enumerate([0, 299_999, 420_000])])
    got = rows(windows.avg_speed_sliding(passages, 5 * MINUTE, 2 * MINUTE), "start_time", "car_count")
    want = {}
    for t in [0, 299_999, 420_000]:
        for start in range(-600_000, 600_000, 120_000):
            if start <= t < start + 300_000:
                want[start] = want.get(start, 0) + 1
    assert got == sorted(want.items(), key=repr)


def test_mean_is_rounded_half_up(make):
    passages = make.passages([(0, 0, "x", "m", 10.0, "a"), (1, 1, "x", "m", 10.01, "a"), (2, 2, "x", "n", 1 / 3, "a")])
    got = rows(windows.sum_count(passages, ["monitor_id"]), "monitor_id", "avg_speed", "car_count")
    assert got == [("m", 10.01, 2), ("n", 0.33, 1)]


def test_overspeed(make):
    alerts = jobs.overspeed(make.lines(SPEEDING_LOG), make.monitors())
    assert rows(alerts, "monitor_id", "limit_speed", "action_time", "road_id") == [
        ("m1", 50, 1700000003000, "r1"), ("m1", 50, 1700000030000, "r2"),
        ("m2", 70, 1700000034000, "r2"), ("m2", 70, 1700000034000, "r2")]


def test_overspeed_is_strict_and_double(make):
    passages = make.passages([(0, 0, "x", "m0", 99.0, "a"), (1, 1, "x", "m0", 99.1, "a")])
    assert rows(enrich.overspeed_alerts(passages, make.monitors()), "real_speed") == [(99.1,)]


def test_overspeed_without_broadcast(make):
    passages = make.parsed(SPEEDING_LOG)
    small, large = [enrich.overspeed_alerts(passages, make.monitors(), broadcast_rows=n) for n in (100, 1)]
    assert rows(small) == rows(large)


def test_default_limit(make):
    got = rows(enrich.with_default_limit(make.parsed(SPEEDING_LOG), make.monitors()), "monitor_id", "limit_speed")
    assert got == [("m1", 50), ("m1", 50), ("m2", 70), ("m2", 70), ("m2", 70), ("m3", 120), ("m4", 60), ("m9", 60)]


def test_upsert_keeps_latest(spark):
    changes = spark.createDataFrame([("a", 1, 1), ("b", 5, 1), ("a", 2, 2)], "k string, v int, version int")
    assert rows(enrich.upsert_dimension(changes, ["k"], ["version"]), "k", "v") == [("a", 2), ("b", 5)]


def test_cloned_plates_gap_of_ten_seconds_counts(make):
    log = ["1700000030000,m2,c,RED-7,80.0,r,a", "1700000040000,m3,c,RED-7,80.0,r,a"]
    assert rows(jobs.cloned_plates(make.lines(log)), "first_monitor", "second_monitor", "action_time", "msg") == [
        ("m2", "m3", 1700000040000, "涉嫌套牌车")]


def test_cloned_plates_below_eleven_seconds(make):
    for gap, alerts in ((10_999, 1), (11_000, 0)):
        passages = make.passages([(0, 0, "x", "a", 1.0, "a"), (1, gap, "x", "b", 1.0, "a")])
        assert sequence.cloned_plates(passages).count() == alerts


def test_cloned_plates_event_time_order(make):
    got = rows(jobs.cloned_plates(make.lines(SPEEDING_LOG[2:])), "first_monitor", "second_monitor")
    assert got == [("m1", "m2"), ("m2", "m4")]


def test_cloned_plates_arrival_order(make):
    for max_rows in (None, 2, 100):
        found = sequence.cloned_plates_arrival(make.parsed(SPEEDING_LOG[2:]), max_rows=max_rows)
        assert rows(found, "first_monitor", "second_monitor", "action_time") == [
            ("m1", "m2", 1700000034000), ("m4", "m3", 1700000041000)]
    assert rows(jobs.cloned_plates(make.lines(SPEEDING_LOG[2:]), arrival=True), "first_id", "second_id") == [(0, 1), (2, 3)]


def test_extreme_lines_pass_through_every_job(make):
    odd = ["1700000000000,m1,c,BIG-1,1e20,r,a", "-1,m1,c,RED-7,90.0,r,a", "-1,m1,c,RED-7,-99999.5,r,a"]
    lines = make.lines(odd + SPEEDING_LOG)
    tagged = parse.parse_passages(lines, "TAGGED")
    assert rows(tagged.filter("rejected is not null"), "rejected", "id") == [(odd[0], 0)]
    listed = make.listed([("RED-7", "x", None)])
    for result in (jobs.overspeed(lines, make.monitors()), jobs.average_speed(lines), jobs.top_congested_lines(lines),
                   jobs.area_distinct(lines), jobs.area_distinct_bloom(lines), jobs.area_running_bloom(lines),
                   jobs.cloned_plates(lines), jobs.cloned_plates(lines, arrival=True),
                   jobs.dangerous_drivers(lines, make.monitors()), jobs.violation_tracks(lines, listed)):
        assert result.count() > 0
    key = rows(jobs.violation_tracks(lines, listed).filter("action_time < 0"), "row_key")
    assert key == [("RED-7_9223372036854775808",)]

def test_dangerous_drivers(make):
    numbered = jobs.dangerous_drivers(make.lines(AVERAGE_LOG), make.monitors())
    assert rows(numbered, "n", "monitors", "avg_speed") == [
        (3, ["0001", "0001", "0008"], 116.3), (4, ["0001", "0001", "0008", "0009"], 116.3)]
    every = jobs.dangerous_drivers(make.lines(AVERAGE_LOG), make.monitors(), mode="all")
    assert rows(every, "first_id", "last_id", "n") == [(0, 2, 3), (0, 3, 4), (1, 3, 3)]
    text = every.filter("first_id = 1").first()["msg"]
    assert text == "该车辆涉嫌危险驾驶,第1个经过卡口是:0001 -->第2个经过卡口是:0008 -->第3个经过卡口是:0009 -->"


def test_dangerous_run_must_be_shorter_than_the_limit(make):
    for last, runs in ((119_999, 1), (120_000, 0)):
        passages = make.passages([(i, t, "x", "m", 100.0, "a") for i, t in enumerate([0, 1, last])])
        limited = passages.withColumns({"real_speed": F.col("speed"), "limit_speed": F.lit(60)})
        assert sequence.dangerous_drivers(limited).count() == runs


def test_interval_join_includes_its_ends(make):
    v, p = "RED-7,cloned,1700000028000", "P1,RED-7,done,1700000033000"
    line = jobs.violation_police_join(make.lines([v]), make.lines([p]).drop("id")).first()["line"]
    assert line == "车辆RED-7,已经有交警出警了，警号为:P1,出警的状态是：done,出警的时间:1700000033000"
    for time, pairs in ((1700000033001, 0), (1700000023000, 1), (1700000022999, 0)):
        late = make.lines([f"P1,RED-7,done,{time}"]).drop("id")
        assert jobs.violation_police_join(make.lines([v]), late).count() == pairs


def test_match_with_timeout(make):
    actions = ["P1,RED-7,done,1700000033000", "P2,BLUE-1,open,1699999000000"]
    got = jobs.violation_police_match(make.lines(["RED-7,cloned,1700000028000", "GREY-3,cloned,1700000000000"]), make.lines(actions))
    assert rows(got, "car", "outcome", "create_time", "police_id") == [
        ("BLUE-1", "no_violation", None, "P2"), ("GREY-3", "no_police_action", 1700000000000, None),
        ("RED-7", "matched", 1700000028000, "P1")]
    assert got.filter("outcome = 'matched'").first()["line"] == (
        "该违法车辆RED-7，违法时间1700000028000,已经有交警出警了，警号为:P1,出警的状态是：done,出警的时间:1700000033000")


def test_distinct_cars_per_ten_seconds(make):
    got = rows(distinct.distinct_cars_tumbling(make.parsed(SPEEDING_LOG)), "area_id", "start_time", "cars")
    assert got == [("a1", 1700000000000, 1), ("a2", 1700000030000, 1), ("a2", 1700000040000, 1), ("a2", 1700000050000, 1)]


def test_area_line(make):
    line = jobs.area_distinct(make.lines(SPEEDING_LOG[:1])).first()["line"]
    assert line == "区域a1,在窗口其实时间1700000000000,到窗口结束时间1700000010000 ,一共有1 辆车"


def test_top_n_breaks_ties_by_monitor(make):
    passages = make.passages([(i, 0, "x", m, 10.0, "a") for i, m in enumerate("ddccba")])
    top = windows.top_n_monitors(windows.avg_speed_sliding(passages, MINUTE, MINUTE), 3)
    assert rows(top, "rank", "monitor_id", "car_count") == [(1, "c", 2), (2, "d", 2), (3, "a", 1)]
    assert windows.top_n_lines(top, 3).first()["line"] == (
        "在窗口0 ----60000 时间范围内:整个城市最拥堵的前3个卡口是:卡口:c,经过的车辆数量为:2,平均车速为:10.0"
        "卡口:d,经过的车辆数量为:2,平均车速为:10.0卡口:a,经过的车辆数量为:1,平均车速为:10.0\n")


def test_tracks_of_listed_cars(make):
    log = make.lines(SPEEDING_LOG[2:])
    assert jobs.violation_tracks(log, make.listed()).count() == 0
    listed = make.listed([("RED-7", "x", None)] * 2)
    assert enrich.violation_tracks(parse.parse_passages(log), listed).count() == 6
    keyed = jobs.violation_tracks(log, listed)
    keys = [k for k, in rows(keyed, "row_key")]
    assert len(keys) == 5 and "RED-7_9223370336854745807" in keys


def test_count_batches(make):
    passages = make.passages([(i, i, "x", "m", 1.0, "a") for i in range(25)])
    for max_rows in (None, 4, 100):
        batched = batching.count_batches(passages, ["action_time", "id"], 10, max_rows=max_rows)
        assert rows(batched, "batch_id", "id") == sorted([(i // 10, i) for i in range(25)], key=repr)
        full = batching.count_batches(passages, ["action_time", "id"], 10, keep_partial=False, max_rows=max_rows)
        assert full.count() == 20


DIRTY = ["", "time checkpoint camera plate speed road area", "a note, not a record", "1700000028000,m1,c1,RED-7,80.0,r2,",
         "1700000028000,m1,c1,RED-7,fast,r2,a2", " 1700000028000,m1,c1,RED-7,1.0,r2,a2", "99999999999999999999,m1,c1,RED-7,1.0,r2,a2",
         "9223372036854775807,m1,c1,RED-7,1.0,r2,a2", "1700000028000,m1,c1,RED-7,NaN,r2,a2", "1700000028000,m1,c1,RED-7,Infinity,r2,a2",
         "1700000028000,m1,c1,RED-7,1e20,r2,a2"]


def test_dirty_lines_are_kept_apart(make):
    lines = make.lines(SPEEDING_LOG + DIRTY)
    good = parse.parse_passages(lines)
    assert good.count() == len(SPEEDING_LOG)
    assert good.columns == [f.name for f in PASSAGE] + ["id"]
    assert {t for t, in rows(parse.malformed(lines, PASSAGE), "value")} == set(DIRTY)


def test_odd_but_wellformed_lines(make):
    lines = make.lines(["1700000028000,m1,c1,RED-7,80.0,,a2", "1700000028000,1,c,x,1,r,,extra",
                        "1700000028000,m1,c1,RED-7,80.0,r2,a2,more,,"])
    assert rows(parse.parse_passages(lines), "road_id", "area_id") == [("", "a2"), ("r", ""), ("r2", "a2")]
    assert rows(parse.parse_passages(make.lines(SPEEDING_LOG[:1]), "FAILFAST"), "car") == [("BLUE-1",)]


def test_failfast_stops(make):
    with pytest.raises(Exception, match="malformed line"):
        parse.parse_passages(make.lines(DIRTY[:2]), "FAILFAST").collect()
    with pytest.raises(ValueError):
        parse.parse_passages(make.lines([]), "IGNORE")


def test_violation_lines(make):
    lines = make.lines(["RED-7,cloned,1700000028000", "RED-7,cloned"])
    assert rows(parse.parse_violations(lines), *[f.name for f in VIOLATION]) == [("RED-7", "cloned", 1700000028000)]


def test_ingest_time(make):
    seen = windows.with_ingest_time(make.parsed(SPEEDING_LOG)).agg(F.min("action_time")).first()[0]
    assert seen > 1_700_000_000_000


def test_violations_once_per_day(spark, make, tmp_path):
    day = 24 * HOUR
    alerts = spark.createDataFrame(
        [("x", 5, "b"), ("x", 3, "a"), ("x", day, "c"), ("y", day - 1, "d")], "car string, action_time bigint, msg string")
    stored = make.listed([("y", "old", None), ("x", "old", day + 7)])
    assert rows(tables.violations_once_per_day(alerts, stored), "car", "violation", "create_time") == [
        ("x", "a", 3), ("y", "d", day - 1)]
    path = str(tmp_path / "violations")
    for _ in range(2):
        tables.write_violations_once_per_day(alerts, path)
    tables.write_violations_once_per_day(alerts.limit(0), path)
    assert rows(spark.read.parquet(path), "car", "violation") == [("x", "a"), ("x", "c"), ("y", "d")]


def test_tracks_are_upserted(spark, make, tmp_path):
    path, target = str(tmp_path / "tracks"), str(tmp_path / "compact")
    first = enrich.to_track(make.passages([(0, 5, "x", "m", 1.0, "a"), (1, 5, "x", "m", 2.0, "a"), (2, 9, "x", "m", 3.0, "a")]))
    tables.write_tracks(first, path, 0)
    again = enrich.to_track(make.passages([(0, 9, "x", "n", 0.5, "a")]))
    for _ in range(2):
        tables.write_tracks(again, path, 1)
    want = [(5, "m", 2.0), (9, "n", 0.5)]
    assert rows(tables.read_tracks(spark, path), "action_time", "monitor_id", "speed") == want
    tables.compact_tracks(spark, path, "1970-01-01", "1970-01-01", target)
    assert rows(spark.read.parquet(target), "action_time", "monitor_id", "speed") == want


def test_appended_tables(spark, make, tmp_path):
    speeds = jobs.average_speed(make.lines(AVERAGE_LOG))
    path = str(tmp_path / "speeds")
    for _ in range(2):
        tables.write_average_speed(speeds, path)
    assert spark.read.parquet(path).count() == 2 * speeds.count()
    replayed = str(tmp_path / "replayed")
    for batch in (0, 0, 1):
        tables.write_average_speed(speeds, replayed, batch)
    assert spark.read.parquet(replayed).count() == 2 * speeds.count()
