"""Per-car sequence operators on streams, with typed keyed state.

Analytic functions do not run on streams, so these keep state with
``transformWithStateInPandas``: what each car's next passages can still meet
(a list), passages that wait for the watermark (a map of sorted runs) and an
index of those runs.  A run is written once, read while the watermark moves
through it and removed; a timer wakes the cars when their next passage is due
or a memory ends.  So a busy car costs its rows, however many micro-batches
they take, and no list holds all of them.  Every access to the state is a
message between Python and Spark, so cars share the state of ``BUCKETS``
hash buckets: a micro-batch costs its rows and some messages per bucket, not
per car.  Rows are kept as Arrow batches, which cross between the two as one
value instead of row by row.  The state survives in the query's checkpoint; RocksDB holds it
(``runner`` starts such queries with it).
"""

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from roadstream.functions.messages import CLONED_PLATE
from roadstream.functions.numeric import SPEED_DIGITS, speed_units
from roadstream.functions.timing import MINUTE, SECOND, window_start
from roadstream.operators.enrich import DANGEROUS_FACTOR, overspeed_predicate
from roadstream.operators.matching import MATCHED, NO_POLICE_ACTION, NO_VIOLATION
from roadstream.operators.windows import with_event_time

#: Rows of a run; one run at a time is in memory for each time the bucket's waiting rows overlap.
RUN_ROWS = 1_000

#: Result rows that are handed on together.
OUT_ROWS = 10_000

#: Groups that keys share their state in; a query has to go on with the number it was started with.
BUCKETS = 1_024

Row = tuple
Step = Callable[[list[Row], Row, list[Row]], list[Row]]
Idle = Callable[[list[Row], int, list[Row]], tuple[list[Row], int | None]]


def _schema(**fields) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


_OPEN = StructType([StructField("runs", ArrayType(_schema(run=LongType, at=IntegerType, next=LongType))),
                    StructField("last", LongType()), StructField("wake", LongType())])


class _Sequence(StatefulProcessor):
    """Takes the rows of a bucket's keys in order of ``columns``, the first being their time, and runs ``step`` over each key's.

    Rows are (time, hash of the key, the other columns, the key); the hash keeps comparisons of rows within their key.
    """

    def __init__(self, rows: StructType, n_columns: int, output: StructType, step: Step, idle: Idle | None,
                 keep_ms: int | None):
        self.rows, self.output = rows, output
        self.key_at = n_columns + 1
        self.step, self.idle, self.keep_ms = step, idle, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrow = to_arrow_schema(self.rows)
        self.memory = handle.getValueState("memory", _schema(rows=BinaryType), self.keep_ms)
        self.runs = handle.getMapState("runs", _schema(run=LongType), _schema(rows=BinaryType))
        self.open = handle.getValueState("open", _OPEN)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        blocks = self._blocks(rows)
        first, second = next(blocks, []), next(blocks, None)
        runs, last, wake = self._index()
        if second is not None:
            # More than a block: written first, so that no list holds a busy car's rows.
            for block in (first, second, *blocks):
                runs, last = self._store(block, runs, last)
            first = []
        yield from self._advance(first, runs, last, wake, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        runs, last, wake = self._index()
        # What was due may have been taken with the micro-batch's rows.
        if wake is not None and wake <= timerValues.getCurrentWatermarkInMs():
            yield from self._advance([], runs, last, wake, timerValues)

    def _blocks(self, frames: Iterator[pd.DataFrame]) -> Iterator[list[Row]]:
        for frame in frames:
            yield sorted(zip(*(frame[c].tolist() for c in self.rows.names)))

    def _index(self) -> tuple[list[Row], int, int | None]:
        found = self.open.get()
        return ([tuple(x) for x in found[0]], found[1], found[2]) if found else ([], 0, None)

    def _packed(self, rows: list[Row]) -> tuple[bytes]:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), self.arrow)]
        return (pa.RecordBatch.from_arrays(columns, schema=self.arrow).serialize().to_pybytes(),)

    def _unpacked(self, found: tuple[bytes]) -> list[Row]:
        batch = pa.ipc.read_record_batch(pa.py_buffer(found[0]), self.arrow)
        return list(zip(*(c.to_pylist() for c in batch.columns)))

    def _store(self, block: list[Row], runs: list[Row], last: int) -> tuple[list[Row], int]:
        runs = list(runs)
        for at in range(0, len(block), RUN_ROWS):
            part = block[at:at + RUN_ROWS]
            last += 1
            self.runs.updateValue((last,), self._packed(part))
            runs.append((last, 0, part[0][0]))
        return runs, last

    def _advance(self, block: list[Row], runs: list[Row], last: int, wake: int | None, timers) -> Iterator[pd.DataFrame]:
        """Take what is due: from ``block``, sorted and not stored yet, and from stored runs."""
        now = timers.getCurrentWatermarkInMs() if self.idle else None
        taken = len(block) if now is None else bisect_left(block, (now + 1,))
        left = [x for x in runs if now is not None and x[2] > now]
        due = sorted((x for x in runs if now is None or x[2] <= now), key=lambda x: x[2])
        out: list[Row] = []
        wanted = wake
        if taken or due or self.idle and wake is not None and wake <= now:
            memory = self._remembered()
            changed = bool(taken or due)
            for rows in self._in_order(block[:taken], due, now, left):
                self._take(rows, memory, out)
                if len(out) >= OUT_ROWS:
                    yield self._frame(out)
                    out = []
            if self.idle:
                wanted, ended = self._rest(memory, now, out)
                changed = changed or ended
            if changed:
                self._remember(memory)
        left, last = self._store(block[taken:], left, last)
        due_at = min([next_time for _, _, next_time in left] + ([] if wanted is None else [wanted]), default=None)
        if due_at is not None and self.idle:
            due_at = max(due_at, now + 1)
            if wake is None or due_at < wake or wake <= now:
                self.handle.registerTimer(due_at)
            else:
                due_at = wake
        if left or due_at is not None:
            if (left, due_at) != (runs, wake):
                self.open.update((left, last, due_at))
        elif runs or wake is not None:
            self.open.clear()
        if out:
            yield self._frame(out)

    def _frame(self, out: list[Row]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=self.output.names, dtype=object)

    def _in_order(self, block: list[Row], due: list[Row], now: int | None, left: list[Row]) -> Iterator[list[Row]]:
        """The due rows in sorted lists, one after the other; a run is read when its first time is reached.

        What of a run is not due yet goes to ``left``; a run that is taken whole is removed.
        """
        begun = [block] if block else []
        for run, at, next_time in due:
            yield from self._before(begun, (next_time,))
            rows = self._unpacked(self.runs.getValue((run,)))
            end = len(rows) if now is None else bisect_left(rows, (now + 1,))
            if end < len(rows):
                left.append((run, end, rows[end][0]))
            else:
                self.runs.removeKey((run,))
            begun.append(rows[at:end])
        yield from self._before(begun, None)

    def _before(self, begun: list[list[Row]], edge: Row | None) -> Iterator[list[Row]]:
        """Takes the rows before ``edge`` out of sorted lists and gives them as one."""
        places = [len(rows) if edge is None else bisect_left(rows, edge) for rows in begun]
        ready = sorted(chain.from_iterable(rows[:at] for rows, at in zip(begun, places)))
        begun[:] = [rows[at:] if at else rows for rows, at in zip(begun, places) if at < len(rows)]
        if ready:
            yield ready

    def _take(self, rows: list[Row], memory: dict[Row, list[Row]], out: list[Row]) -> None:
        """Run ``step`` over the due rows, of all keys in one order."""
        key_at, step, found = self.key_at, self.step, []
        for row in rows:
            key = row[key_at:]
            kept = step(memory.get(key, []), (row[0], *row[2:key_at]), found)
            if kept:
                memory[key] = kept
            else:
                memory.pop(key, None)
            if found:
                out.extend((*key, *x) for x in found)
                found.clear()

    def _rest(self, memory: dict[Row, list[Row]], now: int, out: list[Row]) -> tuple[int | None, bool]:
        """Run ``idle`` for each key: when the next memory ends, and whether one has changed."""
        wanted, changed, found = None, False, []
        for key, before in list(memory.items()):
            kept, end = self.idle(before, now, found)
            if kept is not before:
                changed = True
                if kept:
                    memory[key] = kept
                else:
                    del memory[key]
            if found:
                out.extend((*key, *x) for x in found)
                found.clear()
            if end is not None and (wanted is None or end < wanted):
                wanted = end
        return wanted, changed

    def _remembered(self) -> dict[Row, list[Row]]:
        memory: dict[Row, list[Row]] = {}
        found = self.memory.get()
        for row in self._unpacked(found) if found else []:
            memory.setdefault(row[self.key_at:], []).append((row[0], *row[2:self.key_at]))
        return memory

    def _remember(self, memory: dict[Row, list[Row]]) -> None:
        if memory:
            self.memory.update(self._packed([(row[0], 0, *row[1:], *key) for key, rows in memory.items() for row in rows]))
        else:
            self.memory.clear()


def _stateful(rows: DataFrame, keys: list[str], columns: list[str], output: StructType, step: Step, idle: Idle | None,
              keep_ms: int | None = None) -> DataFrame:
    """Run ``step`` over each key's rows, ``columns[0]`` being their time.

    With ``idle`` rows wait until the watermark reaches them and are taken in
    order of ``columns``; ``idle`` says when memory ends.  Without it they are
    taken at once, in that order within their micro-batch; no watermark leaves
    any out, and what ``step`` returns stays until the key's next row, or until
    the key has seen none for ``keep_ms`` of the wall clock (for queries that
    go on: one with ``available_now`` would wait for the clock for ever).  Keys
    that the clock forgets have their state for themselves.
    """
    # pandas frames of the operator have no names that begin with "_".
    hashed = F.xxhash64(*keys)
    rows = rows.withColumns({"key_hash": hashed, "_bucket": hashed if keep_ms else F.pmod(hashed, F.lit(BUCKETS))})
    inside = [columns[0], "key_hash", *columns[1:], *[f"key_{k}" for k in keys]]
    rows = rows.withColumns({f"key_{k}": F.col(k) for k in keys})
    schema = StructType([StructField(c, rows.schema[c].dataType) for c in inside])
    processor = _Sequence(schema, len(columns), output, step, idle, keep_ms)
    mode = "EventTime" if idle else "None" if keep_ms is None else "ProcessingTime"
    kept = rows.select("_bucket", *inside, *(["event_time"] if idle else []))
    return kept.groupBy("_bucket").transformWithStateInPandas(processor, output, "Append", mode)


def cloned_plates(passages: DataFrame, max_gap_seconds: int = 10, delay: int = 5 * SECOND,
                  order: tuple[str, ...] = ("action_time", "id"), arrival: bool = False,
                  keep_ms: int | None = None) -> DataFrame:
    """Pairs as in the batch operator, of rows that come at most ``delay`` late.

    ``arrival=True`` takes rows as they come (by ``order[1:]`` within a
    micro-batch, so pass an arrival number as ``id``), however late: a row
    older than the waiting one may pair with it but never replaces it.  State
    is then one row per car at most, without expiry, or with ``keep_ms`` until
    the car was not seen for that long.
    """
    columns = ["action_time", "id", "monitor_id"]
    ranked = ["id", "action_time", "monitor_id"] if arrival else columns
    t, i, m = ranked.index("action_time"), ranked.index("id"), ranked.index("monitor_id")

    def step(memory: list[Row], row: Row, out: list[Row]) -> list[Row]:
        if not memory:
            return [row]
        first, = memory
        if abs(row[t] - first[t]) // 1000 > max_gap_seconds:
            return [row] if row[t] > first[t] else memory
        # Both name the later row's checkpoint on equal times.
        early, late = (first, row) if first[t] < row[t] else (row, first if row[t] < first[t] else row)
        out.append((first[i], row[i], early[m], late[m], CLONED_PLATE, late[t]))
        return []

    def idle(memory: list[Row], now: int, out: list[Row]) -> tuple[list[Row], int | None]:
        if not memory:
            return memory, None
        last_chance = memory[0][t] + (max_gap_seconds + 1) * SECOND
        return ([], None) if last_chance <= now else (memory, last_chance)

    rows = _renamed(passages, order)
    if not arrival:
        rows = with_event_time(rows, "action_time", delay)
    output = _schema(car=StringType, first_id=LongType, second_id=LongType, first_monitor=StringType,
                     second_monitor=StringType, msg=StringType, action_time=LongType)
    return _stateful(rows, ["car"], ranked, output, step, None if arrival else idle, keep_ms=keep_ms if arrival else None)


def _renamed(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    return rows.withColumnsRenamed({order[0]: "action_time", order[1]: "id"})


def dangerous_drivers(passages: DataFrame, times: int = 3, within: int = 2 * MINUTE,
                      factor: float = DANGEROUS_FACTOR, mode: str = "maximal", delay: int = 5 * SECOND) -> DataFrame:
    """Runs of qualifying passages; the result lists the run's checkpoints in ``monitors``.

    Input as from ``with_default_limit`` plus ``id``.  Rows that do not
    qualify still move the watermark.
    """
    if mode not in ("maximal", "all"):
        raise ValueError("mode must be maximal or all")

    def step(window: list[Row], row: Row, out: list[Row]) -> list[Row]:
        window = [r for r in window if row[0] - r[0] < within] + [row]
        starts = range(len(window) - times + 1) if mode == "all" else range(min(1, len(window) - times + 1))
        for at in starts:
            run = window[at:]
            out.append((run[0][0], run[0][1], row[0], row[1], len(run),
                        _mean2(sum(r[3] for r in run), len(run)), "\x1f".join(r[2] for r in run)))
        return window

    def idle(window: list[Row], now: int, out: list[Row]) -> tuple[list[Row], int | None]:
        if window and window[0][0] + within <= now:
            window = [r for r in window if r[0] + within > now]
        return window, (window[-1][0] + within if window else None)

    # Naming the event time keeps the filter above the watermark, which has to
    # see every row.
    fast = F.when(F.col("event_time").isNotNull(), overspeed_predicate(factor))
    rows = with_event_time(passages, "action_time", delay).filter(fast)
    rows = rows.select("car", "action_time", "id", "monitor_id", speed_units("real_speed").alias("units"), "event_time")
    output = _schema(car=StringType, first_action_time=LongType, first_id=LongType, last_action_time=LongType,
                     last_id=LongType, n=LongType, avg_speed=DoubleType, monitors=StringType)
    found = _stateful(rows, ["car"], ["action_time", "id", "monitor_id", "units"], output, step, idle)
    return found.withColumn("monitors", F.split("monitors", "\x1f"))


def _mean2(units: int, n: int) -> float:
    per_cent = 10 ** (SPEED_DIGITS - 2)
    return (2 * units + n * per_cent) // (2 * n * per_cent) / 100


def match_with_timeout(violations: DataFrame, police: DataFrame, timeout: int = 5 * SECOND,
                       delay: int = 2 * SECOND, tie: str = "id") -> DataFrame:
    """One-to-one matching as in the batch operator, in event-time order."""
    none = F.lit(None).cast("string")
    sides = with_event_time(violations, "create_time", delay).select(
        "car", F.col("create_time").alias("time"), F.lit("V").alias("kind"), F.col(tie).alias("tie"),
        "msg", none.alias("police_id"), none.alias("action_status"), "event_time")
    sides = sides.unionByName(with_event_time(police, "action_time", delay).select(
        "car", F.col("action_time").alias("time"), F.lit("P").alias("kind"), F.col(tie).alias("tie"),
        none.alias("msg"), "police_id", "action_status", "event_time"))

    def alone(row: Row, superseded: bool) -> Row:
        if row[1] == "V":
            return (NO_POLICE_ACTION, row[2], row[0], row[3], None, None, None, None, superseded)
        return (NO_VIOLATION, None, None, None, row[2], row[0], row[4], row[5], superseded)

    def step(memory: list[Row], row: Row, out: list[Row]) -> list[Row]:
        if not memory:
            return [row]
        pending, = memory
        near = row[0] - pending[0] <= timeout
        if near and row[1] != pending[1]:
            v, p = (row, pending) if row[1] == "V" else (pending, row)
            out.append((MATCHED, v[2], v[0], v[3], p[2], p[0], p[4], p[5], False))
            return []
        out.append(alone(pending, near))
        return [row]

    def idle(memory: list[Row], now: int, out: list[Row]) -> tuple[list[Row], int | None]:
        if not memory:
            return memory, None
        pending, = memory
        if pending[0] + timeout <= now:
            out.append(alone(pending, False))
            return [], None
        return memory, pending[0] + timeout

    output = _schema(car=StringType, outcome=StringType, violation_id=LongType, create_time=LongType,
                     msg=StringType, action_id=LongType, action_time=LongType, police_id=StringType,
                     action_status=StringType, superseded=BooleanType)
    columns = ["time", "kind", "tie", "msg", "police_id", "action_status"]
    return _stateful(sides, ["car"], columns, output, step, idle)


def first_passages(passages: DataFrame, size: int, order: tuple[str, ...] = ("action_time", "id"),
                   area: str = "area_id", car: str = "car", delay: int = 5 * SECOND) -> DataFrame:
    """Every passage once the watermark has reached it, with ``new``: whether it is its car's first in area and window.

    State per area and car: the windows of ``size`` ms that it was seen in and that are still open.
    """
    rows = with_event_time(_renamed(passages, order), "action_time", delay).select(
        F.col(area).alias("area_id"), F.col(car).alias("car"), "action_time", "id",
        window_start("action_time", size).alias("start_time"), "event_time")

    def step(seen: list[Row], row: Row, out: list[Row]) -> list[Row]:
        known = any(x[2] == row[2] for x in seen)
        out.append((*row, not known))
        return seen if known else [*seen, row]

    def idle(seen: list[Row], now: int, out: list[Row]) -> tuple[list[Row], int | None]:
        if any(x[2] + size <= now for x in seen):
            seen = [x for x in seen if x[2] + size > now]
        return seen, max((x[2] + size for x in seen), default=None)

    output = _schema(area_id=StringType, car=StringType, action_time=LongType, id=LongType, start_time=LongType, new=BooleanType)
    found = _stateful(rows, ["area_id", "car"], ["action_time", "id", "start_time"], output, step, idle)
    return found.withColumnsRenamed({"action_time": order[0], "id": order[1]})
