"""The analysis jobs: from lines of text to reports, for tables and streams.

Every function takes line DataFrames (``sources.lines``) and reference tables
and returns a DataFrame.  Where the plan differs, ``isStreaming`` decides.
``live_*`` functions start a query that re-reads its reference table.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from roadstream.functions import messages
from roadstream.functions.timing import MINUTE, SECOND
from roadstream.operators import batching, distinct, enrich, matching, sequence, windows
from roadstream.schemas import AVERAGE_SPEED, OVERSPEED
from roadstream.sinks import tables
from roadstream.sources.dimensions import Loader
from roadstream.sources.lines import to_topic
from roadstream.sources.parse import malformed, parse_passages, parse_police_actions, parse_violations
from roadstream.sources.tail import growing_lines
from roadstream.streaming import runner, stateful, totals


def overspeed(lines: DataFrame, monitors: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    return enrich.overspeed_alerts(parse_passages(lines, mode), monitors)


def live_overspeed(lines: DataFrame, monitors: Loader, path: str, checkpoint: str,
                   refresh_seconds: float = 2.0, **trigger) -> StreamingQuery:
    """Alerts of a stream, appended to a table (``tables.read_speeding``)."""
    return runner.with_table(parse_passages(lines), monitors, enrich.overspeed_alerts,
                             lambda rows, batch: tables.append_batch(rows, OVERSPEED, path, batch),
                             checkpoint, refresh_seconds, **trigger)


def average_speed(lines: DataFrame, size: int = 5 * MINUTE, slide: int = MINUTE, mode: str = "PERMISSIVE") -> DataFrame:
    return windows.avg_speed_sliding(parse_passages(lines, mode), size, slide)


def live_average_speed(lines: DataFrame, path: str, checkpoint: str, size: int = 5 * MINUTE,
                       slide: int = MINUTE, **trigger) -> StreamingQuery:
    """Mean speeds of a stream, appended to a table (``tables.read_average_speed``)."""
    return runner.to_batches(average_speed(lines, size, slide),
                             lambda rows, batch: tables.append_batch(rows, AVERAGE_SPEED, path, batch), checkpoint, **trigger)


def top_congested(lines: DataFrame, n: int = 3, size: int = 5 * MINUTE, slide: int = MINUTE,
                  mode: str = "PERMISSIVE") -> DataFrame:
    passages = parse_passages(lines, mode)
    if passages.isStreaming:
        return windows.top_n_stream(passages, n, size, slide)
    return windows.top_n_monitors(windows.avg_speed_sliding(passages, size, slide), n)


def top_congested_lines(lines: DataFrame, n: int = 3, size: int = 5 * MINUTE, slide: int = MINUTE,
                        mode: str = "PERMISSIVE") -> DataFrame:
    passages = parse_passages(lines, mode)
    if passages.isStreaming:
        return windows.top_n_stream_lines(passages, n, size, slide)
    return windows.top_n_lines(top_congested(lines, n, size, slide, mode), n)


def area_distinct(lines: DataFrame, size: int = 10 * SECOND, mode: str = "PERMISSIVE") -> DataFrame:
    return distinct.area_lines(distinct.distinct_cars_tumbling(parse_passages(lines, mode), size))


def area_distinct_bloom(lines: DataFrame, size: int = 10 * MINUTE, mode: str = "PERMISSIVE") -> DataFrame:
    """Bloom-style count of a table or stream.

    ``id`` tells the order of arrival; a stream without one counts in order of time, then car.
    """
    passages = parse_passages(lines, mode)
    arrival = "id" if "id" in passages.columns or not passages.isStreaming else F.struct("action_time", "car")
    return distinct.area_lines(distinct.distinct_cars_bloom(passages, size, arrival=arrival))


def area_running_bloom(lines: DataFrame, size: int = 10 * MINUTE, mode: str = "PERMISSIVE") -> DataFrame:
    """The bloom-style count after every passage of a table with ``id``."""
    return distinct.area_lines(distinct.running_bloom(parse_passages(lines, mode), size))


def live_running_distinct(lines: DataFrame, write: Callable[[DataFrame, int], None], path: str, checkpoint: str,
                          size: int = 10 * MINUTE, **trigger) -> StreamingQuery:
    """A line per passage of a stream with ``id``: the cars of its area and window so far; totals go to ``path``."""
    return totals.running_distinct(parse_passages(lines), size, lambda rows, batch: write(distinct.area_lines(rows), batch),
                                   path, checkpoint, **trigger)


def cloned_plates(lines: DataFrame, max_gap_seconds: int = 10, arrival: bool = False, delay: int = 5 * SECOND,
                  mode: str = "PERMISSIVE") -> DataFrame:
    """``lines`` carry an ``id``, such as ``file_lines(..., arrival_id=True)`` gives.

    Passages are paired in order of their times; on streams they may come
    ``delay`` ms late.  With ``arrival`` the order of ``id`` counts instead, and
    no passage is too late.
    """
    passages = parse_passages(lines, mode)
    if passages.isStreaming:
        return stateful.cloned_plates(passages, max_gap_seconds, delay, arrival=arrival)
    if arrival:
        return sequence.cloned_plates_arrival(passages, max_gap_seconds)
    return sequence.cloned_plates(passages, max_gap_seconds)


def live_cloned_plates(lines: DataFrame, path: str, checkpoint: str, max_gap_seconds: int = 10, arrival: bool = False,
                       delay: int = 5 * SECOND, **trigger) -> StreamingQuery:
    """Alerts of a stream, inserted once per car and day."""
    return runner.to_batches(cloned_plates(lines, max_gap_seconds, arrival, delay),
                             lambda rows, _: tables.write_violations_once_per_day(rows, path), checkpoint, **trigger)


def live_rejects(lines: DataFrame, schema: StructType, write: Callable[[DataFrame, int], None], checkpoint: str,
                 **trigger) -> StreamingQuery:
    """Hand the lines of a stream that do not fit ``schema`` to ``write``, beside a job that leaves them out."""
    return runner.to_batches(malformed(lines, schema), write, checkpoint, **trigger)


def publish(lines: DataFrame, servers: str, topic: str, checkpoint: str | None = None) -> DataStreamWriter | None:
    """Every line to a topic: a table at once, a stream as a writer to start."""
    return to_topic(lines, servers, topic, checkpoint)


def publish_folder(spark: SparkSession, folder: str, servers: str, topic: str, checkpoint: str,
                   glob: str = "*log*") -> DataStreamWriter:
    """Lines of the log files that appear, grow and are rotated in a folder, to a topic."""
    return publish(growing_lines(spark, folder, glob), servers, topic, checkpoint)


def dangerous_drivers(lines: DataFrame, monitors: DataFrame, mode: str = "maximal", times: int = 3, within: int = 2 * MINUTE,
                      lines_mode: str = "PERMISSIVE") -> DataFrame:
    limited = enrich.with_default_limit(parse_passages(lines, lines_mode), monitors, keep=("id",))
    if limited.isStreaming:
        alerts = stateful.dangerous_drivers(limited, times, within, mode=mode)
        return alerts.withColumn("msg", messages.dangerous_line(F.col("monitors")))
    limited = sequence.fast_passages(limited)
    return sequence.dangerous_lines(sequence.dangerous_drivers(limited, times, within, mode=mode), sequence.qualifying(limited))


def violation_police_join(violation_lines: DataFrame, police_lines: DataFrame, low: int = -5 * SECOND, high: int = 5 * SECOND,
                          mode: str = "PERMISSIVE") -> DataFrame:
    return matching.handled_lines(matching.interval_join(
        parse_violations(violation_lines, mode), parse_police_actions(police_lines, mode), low, high))


def violation_police_match(violation_lines: DataFrame, police_lines: DataFrame,
                           timeout: int = 5 * SECOND, mode: str = "PERMISSIVE") -> DataFrame:
    """``lines`` carry an ``id``.  Filter on ``outcome`` to split the result."""
    violations, police = parse_violations(violation_lines, mode), parse_police_actions(police_lines, mode)
    match = stateful.match_with_timeout if violations.isStreaming else matching.match_with_timeout
    return matching.matched_lines(match(violations, police, timeout))


def live_violation_tracks(lines: DataFrame, listed: Loader, path: str, checkpoint: str,
                          refresh_seconds: float = 2.0, **trigger) -> StreamingQuery:
    """Tracks of listed cars, upserted micro-batch by micro-batch (``tables.track_table``).

    Of rows with one key the last counts: by the ``id`` of the lines (such as
    their place in a topic) within a micro-batch, else by their values.
    """
    order = ("id",) if "id" in lines.columns else ()
    return runner.with_table(parse_passages(lines), listed, lambda rows, cars: enrich.violation_tracks(rows, cars, keep=order),
                             lambda rows, batch: tables.upsert_tracks(rows, path, batch, order),
                             checkpoint, refresh_seconds, **trigger)


def violation_tracks(lines: DataFrame, listed: DataFrame, batch_rows: int = batching.BATCH_ROWS,
                     keep_partial: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """Keyed tracks of listed cars in numbered batches; of rows with one key that with the highest ``id`` counts."""
    order = ("id",) if "id" in lines.columns else ()
    tracks = enrich.violation_tracks(parse_passages(lines, mode), listed, keep=order)
    return batching.count_batches(tables.keyed_tracks(tracks, order), ["action_time", "row_key"], batch_rows, keep_partial)
