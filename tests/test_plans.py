"""Shapes of the physical plans: shuffles, pushed filters, read columns, no Python."""

import pytest
from roadstream.operators import distinct, enrich, matching, ordered, sequence, sizing, windows
from roadstream.operators.ordered import large_groups
from roadstream.plans import inputs, jobs
from roadstream.schemas import MONITOR
from tests.conftest import MONITORS

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


@pytest.fixture(scope="module")
def passages(spark):
    return inputs.passages(spark, FOLDER)


@pytest.fixture(scope="module")
def monitors(spark):
    return inputs.monitors(spark, FOLDER)


def test_one_shuffle_per_sequence_operator(passages, monitors):
    limited = enrich.with_default_limit(passages, monitors, keep=("id",))
    sides = inputs.as_violations(passages), inputs.as_police_actions(passages)
    for df in (sequence.cloned_plates(passages), sequence.dangerous_drivers(limited),
               matching.match_with_timeout(*sides), distinct.running_distinct(passages)):
        assert shuffles(df) == 1
        assert "SinglePartition" not in plan(df)


def test_aggregations_combine_before_the_shuffle(passages):
    speeds = windows.avg_speed_sliding(passages)
    assert shuffles(speeds) == 2 and "partial_sum" in plan(speeds).split("Exchange hashpartitioning")[-1]
    assert shuffles(distinct.distinct_cars_tumbling(passages)) == 2
    for df in (distinct.distinct_cars_bloom(passages), speeds, distinct.distinct_cars_tumbling(passages)):
        assert "SortAggregate" not in plan(df)


def test_top_n_is_limited_before_the_shuffle(passages):
    top = plan(windows.top_n_monitors(windows.avg_speed_sliding(passages)))
    assert "WindowGroupLimit" in top.split("Exchange hashpartitioning(start_time")[1]


def test_small_tables_are_broadcast_and_large_ones_are_not(passages, monitors):
    small = plan(enrich.overspeed_alerts(passages, monitors))
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small
    assert "ResolvedHint" not in enrich.overspeed_alerts(passages, monitors, broadcast_rows=1)._jdf.queryExecution().analyzed().toString()
    assert sizing.is_small(monitors, max_rows=10)
    assert not sizing.is_small(monitors, max_rows=2)
    assert not sizing.is_small(monitors, max_bytes=10)


def test_filters_and_columns_reach_the_scan(spark, passages, tmp_path):
    spark.createDataFrame(MONITORS, MONITOR).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    text = plan(enrich.overspeed_alerts(passages, stored))
    assert "GreaterThan(speed_limit,0)" in text
    assert "ReadSchema: struct<monitor_id:string,speed_limit:int>" in text
    passages.write.parquet(str(tmp_path / "p"))
    counts = plan(distinct.distinct_cars_tumbling(spark.read.parquet(str(tmp_path / "p"))))
    assert "ReadSchema: struct<action_time:bigint,car:string,area_id:string>" in counts


def test_batch_operators_need_no_python(passages, monitors):
    limited = enrich.with_default_limit(passages, monitors, keep=("id",))
    for df in (sequence.dangerous_drivers(limited, mode="all"), windows.avg_speed_sliding(passages),
               distinct.distinct_cars_bloom(passages)):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_interval_join_spreads_cars_over_cells(passages):
    text = plan(matching.interval_join(inputs.as_violations(passages), inputs.as_police_actions(passages).drop("id")))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "_cell" in text.split("Join [")[1].split("]")[0]


def test_groups_are_measured(passages):
    assert large_groups(passages, ("car",), 10_000) == (None, 0)
    large, rows = large_groups(passages, ("area_id",), 10)
    assert rows == passages.count() and large.count() == passages.select("area_id").distinct().count()
    assert large_groups(passages, (), 10)[1] == passages.count()


def test_runs_are_never_joined_by_broadcast(passages, monitors):
    limited = sequence.fast_passages(enrich.with_default_limit(passages, monitors, keep=("id",)))
    alerts, numbered = sequence.dangerous_drivers(limited), sequence.qualifying(limited)
    for df in (sequence.alert_steps(alerts, numbered), sequence.dangerous_lines(alerts, numbered),
               sequence.dangerous_drivers(limited, mode="all")):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)


def test_dangerous_drivers_job_sends_only_limits_to_every_task(spark, monitors):
    text = plan(jobs.dangerous_drivers(inputs.lines(spark, FOLDER), monitors))
    assert text.count("SortMergeJoin") == 2 and "Broadcast" not in text


def test_windows_are_dealt_out_by_rows(passages, monkeypatch):
    monkeypatch.setattr(windows, "TASK_ROWS", 100, raising=False)
    speeds = windows.avg_speed_sliding(passages)
    assert f"{passages.count() // 100 + 1}), REPARTITION_BY_NUM" in plan(speeds) and shuffles(speeds) == 2


def test_short_chunks_share_ranges(passages):
    grouped = passages.withColumn(ordered.GROUP, ordered.F.struct("area_id"))
    pieces = ordered.cut(grouped, ["action_time", "id"], passages.count() // 10 + 1, 10)
    assert len(pieces.inputFiles()) == 1
    sizes = pieces.groupBy(ordered.CHUNK).count().orderBy(ordered.CHUNK).collect()
    assert [row["count"] for row in sizes[:-1]] == [10] * (len(sizes) - 1) and sizes[-1]["count"] <= 10


def test_panes_beyond_a_task_are_dealt_out_before_they_are_summed(passages, monkeypatch):
    want = sorted(map(tuple, windows.avg_speed_sliding(passages).collect()))
    monkeypatch.setattr(windows, "TASK_ROWS", 60)
    speeds = windows.avg_speed_sliding(passages)
    text = plan(speeds)
    assert "_share" in text and text.count("Exchange hashpartitioning") == 2
    lowest = text.rindex("Exchange hashpartitioning")
    assert "HashAggregate" not in text[lowest:]  # no table of panes beside the rows that are read
    assert sorted(map(tuple, speeds.collect())) == want
