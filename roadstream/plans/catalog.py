"""Queries over the driver's tables, each with an equivalent DuckDB SQL text.

Fixed values: the wording of report lines in the SQL texts, as in ``functions.messages``.

``query`` registers a function (spark, folder) -> DataFrame under its own
name.  The SQL is written against whole tables and independently of the Spark
plan: self-joins and plain window functions instead of panes, probes or
pre-aggregation.
"""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstream.functions.hashing import bit_offsets
from roadstream.functions.timing import DAY, HOUR, newest_first_key, window_start
from roadstream.operators import batching, distinct, enrich, matching, sequence, windows
from roadstream.plans import inputs, jobs
from roadstream.schemas import OVERSPEED as OVERSPEED_ROWS
from roadstream.shared import freeze, new_path
from roadstream.sinks import tables
from roadstream.sources import parse
from roadstream.sources.lines import file_lines
from roadstream.streaming import runner, stateful, totals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

P = """p as (select event_id id, epoch_us(ts) // 1000 action_time, regexp_extract(props, '([0-9]+)', 1) monitor_id,
  'cam' || regexp_extract(props, '([0-9]+)', 1) camera_id, cast(user_id as varchar) car, value speed,
  'road' || regexp_extract(props, '([0-9]+)', 1) road_id, event_type area_id from events)"""
M = """m as (select cast(s_suppkey as varchar) monitor_id, cast(s_nationkey as varchar) road_id,
  cast(floor(s_acctbal / 100) as integer) speed_limit from supplier)"""
V = """v as (select id, car, monitor_id msg, action_time create_time from p where area_id = 'error')"""
A = """a as (select id, camera_id police_id, car, road_id action_status, action_time from p where area_id = 'signup')"""
LISTED = "listed as (select cast(c_custkey as varchar) car from customer where c_acctbal < 0)"
CENTS = "cast(round({0} * 100) as bigint)"
MEAN = "(cast(sum({0}) as bigint) * 2 + count(*)) // (2 * count(*)) / 100.0::double"


# Group size from which the ``*_hot`` queries cut groups into chunks.
HOT_ROWS = 1500


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


# --- lines to records -------------------------------------------------------

@query(with_(P) + """select action_time, monitor_id, camera_id, car, speed, road_id, area_id, id from p""")
def parse_passages(spark, folder):
    return parse.parse_passages(inputs.log_lines(spark, folder))


@query(with_(P) + """select action_time, monitor_id, camera_id, car, speed, road_id, area_id, id, null::bigint n_rejected from p
union all select null, null, null, null, null, null, null, doc_id, length(text) from documents""")
def parse_with_rejects(spark, folder):
    """One pass: records and rejected lines."""
    tagged = parse.parse_passages(inputs.log_lines(spark, folder), "TAGGED")
    return tagged.withColumn("n_rejected", F.char_length("rejected").cast("bigint")).drop("rejected")


@query(with_("""t as (select doc_id id, text, string_split(rtrim(text, ','), ',') f from documents)""") + """
select id, cast(length(text) as bigint) n_chars from t
where not coalesce(len(f) >= 7 and regexp_full_match(f[1], '[+-]?[0-9]+')
  and try_cast(f[1] as bigint) is not null and try_cast(f[5] as double) is not null, false)""")
def malformed_lines(spark, folder):
    bad = parse.malformed(inputs.log_lines(spark, folder), parse.PASSAGE)
    return bad.select("id", F.char_length("value").cast("bigint").alias("n_chars"))


@query(with_(P, V) + "select car, msg, create_time, id from v")
def parse_violations(spark, folder):
    v = inputs.as_violations(inputs.passages(spark, folder))
    lines = v.select(F.concat_ws(",", "car", "msg", F.col("create_time").cast("string")).alias("value"), "id")
    return parse.parse_violations(lines)


@query(with_(P, A) + "select police_id, car, action_status, action_time, id from a")
def parse_police_actions(spark, folder):
    a = inputs.as_police_actions(inputs.passages(spark, folder))
    lines = a.select(F.concat_ws(",", "police_id", "car", "action_status",
                                 F.col("action_time").cast("string")).alias("value"), "id")
    return parse.parse_police_actions(lines)


# --- lookups and projections ------------------------------------------------

@query(with_(P) + "select car, action_time, monitor_id, road_id, area_id, speed from p")
def to_track(spark, folder):
    return enrich.to_track(inputs.passages(spark, folder))


@query(with_(M) + "select monitor_id, road_id, speed_limit from m where speed_limit > 0")
def has_limit(spark, folder):
    return enrich.has_limit(inputs.monitors(spark, folder)).select("monitor_id", "road_id", "speed_limit")


OVERSPEED = with_(P, M) + """select p.car, p.monitor_id, p.road_id, p.speed real_speed, m.speed_limit limit_speed,
  p.action_time{1} from p join m on p.monitor_id = m.monitor_id
where m.speed_limit > 0 and m.speed_limit * {0}::double < p.speed"""


@query(OVERSPEED.format("1.1", ", p.id"))
def overspeed_alerts(spark, folder):
    return enrich.overspeed_alerts(inputs.passages(spark, folder), inputs.monitors(spark, folder), keep=("id",))


@query(OVERSPEED.format("1.2", ", p.id"))
def overspeed_dangerous(spark, folder):
    return enrich.overspeed_alerts(inputs.passages(spark, folder), inputs.monitors(spark, folder),
                                   enrich.DANGEROUS_FACTOR, keep=("id",))


LIMITED = """limited as (select p.car, p.monitor_id, p.road_id, p.speed real_speed,
  coalesce(m.speed_limit, 60) limit_speed, p.action_time, p.id
  from p left join m on p.monitor_id = m.monitor_id and m.speed_limit > 0)"""


@query(with_(P, M, LIMITED) + "select * from limited")
def default_limit(spark, folder):
    return enrich.with_default_limit(inputs.passages(spark, folder), inputs.monitors(spark, folder), keep=("id",))


TRACKS = with_(P, LISTED) + """select p.car, p.action_time, p.monitor_id, p.road_id, p.area_id, p.speed
from p where p.car in (select car from listed)"""


@query(TRACKS)
def violation_tracks(spark, folder):
    return enrich.violation_tracks(inputs.passages(spark, folder), inputs.violation_list(spark, folder))


@query(with_(P) + """select car, id, car || '_' || (9223372036854775807 - action_time)::varchar row_key from p""")
def track_keys(spark, folder):
    return inputs.passages(spark, folder).select(
        "car", "id", newest_first_key(F.col("car"), "action_time").alias("row_key"))


@query(with_(P) + """select car, max_by(monitor_id, id) monitor_id, max_by(speed, id) speed, max(id) id
from p group by car""")
def upsert_dimension(spark, folder):
    changes = inputs.passages(spark, folder).select("car", "monitor_id", "speed", "id")
    return enrich.upsert_dimension(changes, ["car"], ["id"])


# --- windows ----------------------------------------------------------------

@query(with_("q as (select cast(l_suppkey as varchar) monitor_id, cast(round(l_quantity * 100) as bigint) c from lineitem)")
       + f"""select monitor_id, cast(sum(c) as bigint) * 100 speed_units, count(*) car_count,
  {MEAN.format('c')} avg_speed from q group by monitor_id""")
def sum_count(spark, folder):
    return windows.sum_count(inputs.shipments(spark, folder), ["monitor_id"])


SLIDING = """w as (select {key}, action_time - action_time % {slide} - k * {slide} start_time, speed
  from p, (select unnest(range({n})) k)),
s as (select start_time, start_time + {size} end_time, {key}, {mean} avg_speed, count(*) car_count
  from w group by start_time, {key})"""
RANKED = """r as (select *, row_number() over (partition by start_time order by car_count desc, {key}) "rank" from s)"""
HOURLY = SLIDING.format(key="area_id", slide=HOUR, size=5 * HOUR, n=5, mean=MEAN.format(CENTS.format("speed")))
BY_MONITOR = SLIDING.format(key="monitor_id", slide=DAY, size=3 * DAY, n=3, mean=MEAN.format(CENTS.format("speed")))
SHIPPED = """p as (select epoch_us(l_shipdate) // 1000 action_time, cast(l_suppkey as varchar) monitor_id,
  l_quantity speed from lineitem)"""
WEEKLY = SLIDING.format(key="monitor_id", slide=DAY, size=5 * DAY, n=5, mean=MEAN.format(CENTS.format("speed")))


def _hourly(rows):
    return windows.avg_speed_sliding(rows, 5 * HOUR, HOUR, key="area_id")


@query(with_(P, HOURLY) + "select * from s")
def avg_speed_sliding(spark, folder):
    return _hourly(inputs.passages(spark, folder))


@query(with_(SHIPPED, WEEKLY) + "select * from s")
def avg_speed_dense(spark, folder):
    return windows.avg_speed_sliding(inputs.shipments(spark, folder), 5 * DAY, DAY)


@query(with_(P, HOURLY, RANKED.format(key="area_id")) + """select * from r where "rank" <= 3""")
def top_n_monitors(spark, folder):
    return windows.top_n_monitors(_hourly(inputs.passages(spark, folder)), 3, "area_id")


@query(with_(SHIPPED, WEEKLY, RANKED.format(key="monitor_id")) + """select * from r where "rank" <= 3""")
def top_n_dense(spark, folder):
    return windows.top_n_monitors(windows.avg_speed_sliding(inputs.shipments(spark, folder), 5 * DAY, DAY))


TOP_LINES = with_(P, BY_MONITOR, RANKED.format(key="monitor_id")) + """select start_time, end_time,
  '在窗口' || start_time || ' ----' || end_time || ' 时间范围内:整个城市最拥堵的前3个卡口是:' ||
  string_agg('卡口:' || monitor_id || ',经过的车辆数量为:' || car_count || ',平均车速为:' || avg_speed, '' order by "rank")
  || chr(10) line from r where "rank" <= 3 {0} group by start_time, end_time"""


@query(TOP_LINES.format(""))
def top_n_lines(spark, folder):
    speeds = windows.avg_speed_sliding(inputs.passages(spark, folder), 3 * DAY, DAY)
    return windows.top_n_lines(windows.top_n_monitors(speeds), 3)


# --- distinct cars ----------------------------------------------------------

CARS = """c as (select area_id, action_time - action_time % {0} start_time, action_time - action_time % {0} + {0} end_time,
  count(distinct car) cars from p group by all)"""


@query(with_(P, CARS.format(DAY)) + "select * from c")
def distinct_cars_tumbling(spark, folder):
    return distinct.distinct_cars_tumbling(inputs.passages(spark, folder), DAY)


@query(with_("p as (select epoch_us(l_shipdate) // 1000 action_time, l_partkey car, l_returnflag area_id from lineitem)",
             CARS.format(DAY)) + "select * from c")
def distinct_cars_dense(spark, folder):
    return distinct.distinct_cars_tumbling(inputs.shipments(spark, folder), DAY)


AREA_LINES = with_(P, CARS.format(HOUR)) + """select *, '区域' || area_id || ',在窗口其实时间' || start_time || ',到窗口结束时间'
  || end_time || ' ,一共有' || cars || ' 辆车' line from c"""


@query(AREA_LINES)
def area_lines(spark, folder):
    return distinct.area_lines(distinct.distinct_cars_tumbling(inputs.passages(spark, folder), HOUR))


@query(with_(P) + f"""select area_id, start_time, start_time + {DAY} end_time, count(distinct first_id) cars from (
  select area_id, start_time, o, min(id) first_id from (
    select area_id, id, action_time - action_time % {DAY} start_time, unnest([
      ('0x' || substr(md5(car), 1, 8))::bigint % 256, ('0x' || substr(md5(car), 9, 8))::bigint % 256]) o from p)
  group by all) group by area_id, start_time""")
def distinct_cars_bloom(spark, folder):
    return distinct.distinct_cars_bloom(inputs.passages(spark, folder), DAY, bits=256, hash="md5")


@query(with_(P) + f"""select area_id, start_time, start_time + {DAY} end_time,
  true exact_or_just_below, count(distinct car) exact
from (select *, action_time - action_time % {DAY} start_time from p) group by area_id, start_time""")
def distinct_cars_bloom_large(spark, folder):
    """With the full number of bits: never above the exact count, and at most 1 % below."""
    passages = inputs.passages(spark, folder)
    bloom = distinct.distinct_cars_bloom(passages, DAY)
    exact = distinct.distinct_cars_tumbling(passages, DAY).withColumnRenamed("cars", "exact")
    return bloom.join(exact, ["area_id", "start_time", "end_time"]).select(
        "area_id", "start_time", "end_time", 
        F.col("cars").between(F.floor(F.col("exact") * 0.99), F.col("exact")).alias("exact_or_just_below"), "exact")


NEAR = with_("p as (select epoch_us(l_shipdate) // 1000 action_time, l_partkey car, l_returnflag area_id from lineitem)",
             CARS.format(90 * DAY)) + "select area_id, start_time, end_time, cars exact, true near from c"


def _near(spark, folder, estimates, share):
    exact = distinct.distinct_cars_tumbling(inputs.shipments(spark, folder), 90 * DAY)
    joined = estimates.withColumnRenamed("cars", "estimate").join(exact, ["area_id", "start_time", "end_time"])
    near = F.abs(F.col("estimate") - F.col("cars")) <= F.greatest(F.lit(1), F.col("cars") * F.lit(share))
    return joined.select("area_id", "start_time", "end_time", F.col("cars").alias("exact"), near.alias("near"))


@query(NEAR)
def distinct_cars_sketch(spark, folder):
    """Daily sketches merged into quarters: within 4 % of the exact count."""
    daily = distinct.car_sketches(inputs.shipments(spark, folder), DAY)
    return _near(spark, folder, distinct.distinct_cars_sketch(daily, 90 * DAY), 0.04)


@query(NEAR)
def distinct_cars_approx(spark, folder):
    return _near(spark, folder, distinct.distinct_cars_approx(inputs.shipments(spark, folder), 90 * DAY), 0.04)


RUNNING = with_(P, f"""f as (select *, action_time - action_time % {DAY} start_time,
  row_number() over (partition by area_id, action_time - action_time % {DAY}, car order by action_time, id) = 1 new from p)"""
                ) + f"""select area_id, start_time, start_time + {DAY} end_time, car, action_time, id,
  cast(sum(new::bigint) over (partition by area_id, start_time order by action_time, id) as bigint) cars from f"""


@query(RUNNING)
def running_distinct(spark, folder):
    return distinct.running_distinct(inputs.passages(spark, folder), DAY)


@query(RUNNING.replace(str(DAY), str(90 * DAY)))
def running_distinct_hot(spark, folder):
    """One window for all rows: five groups, all cut into chunks."""
    return distinct.running_distinct(inputs.passages(spark, folder), 90 * DAY, max_rows=HOT_ROWS)


@query(with_(P, f"w as (select *, action_time - action_time % {DAY} start_time from p)",
             """f as (select distinct area_id, start_time, first_id from (select area_id, start_time, o, min(id) first_id from (
  select area_id, id, start_time, unnest([('0x' || substr(md5(car), 1, 8))::bigint % 256,
    ('0x' || substr(md5(car), 9, 8))::bigint % 256]) o from w) group by all))""") + f"""
select w.area_id, w.start_time, w.start_time + {DAY} end_time, w.car, w.action_time, w.id,
  cast(count(f.first_id) over (partition by w.area_id, w.start_time order by w.id) as bigint) cars
from w left join f on f.area_id = w.area_id and f.start_time = w.start_time and f.first_id = w.id""")
def running_bloom(spark, folder):
    return distinct.running_bloom(inputs.passages(spark, folder), DAY, bits=256, hash="md5")


@query("""select distinct cast(user_id as varchar) car, ('0x' || substr(md5(user_id::varchar), 1, 8))::bigint % 4194304 first_bit,
  ('0x' || substr(md5(user_id::varchar), 9, 8))::bigint % 4194304 second_bit from events""")
def bloom_positions(spark, folder):
    cars = inputs.passages(spark, folder).select("car").distinct()
    offsets = bit_offsets("car", distinct.BLOOM_BITS, "md5")
    return cars.select("car", offsets[0].alias("first_bit"), offsets[1].alias("second_bit"))


# --- sequences --------------------------------------------------------------

def _few_cars(spark, folder):
    return inputs.passages(spark, folder).withColumn("car", F.col("area_id"))


CLONED = with_(P, """g as (select *, (action_time - lag(action_time) over (partition by car order by action_time, id)) // 1000 gap from p)""",
               """i as (select *, sum(case when gap is null or gap > 3600 then 1 else 0 end) over
  (partition by car order by action_time, id) isl from g)""",
               """r as (select *, row_number() over (partition by car, isl order by action_time, id) rn,
  lag(id) over (partition by car order by action_time, id) first_id,
  lag(monitor_id) over (partition by car order by action_time, id) first_monitor from i)""",
               """pairs as (select car, first_id, id second_id, first_monitor, monitor_id second_monitor,
  '涉嫌套牌车' msg, action_time from r where rn % 2 = 0)""")


@query(CLONED + "select * from pairs")
def cloned_plates(spark, folder):
    return sequence.cloned_plates(inputs.passages(spark, folder), 3600)


@query(CLONED.replace("cast(user_id as varchar) car", "event_type car") + "select * from pairs")
def cloned_plates_hot(spark, folder):
    """Five cars hold all rows, so all are cut into chunks."""
    return sequence.cloned_plates(_few_cars(spark, folder), 3600, max_rows=HOT_ROWS)


ARRIVAL = """with recursive """ + P.replace("event_id id", "event_id % 7 * 100000000 + event_id id") + """,
a as (select car, id, action_time t, monitor_id m, row_number() over (partition by car order by id) n from p),
s as (select car, n, id, t, m, null::bigint pid, null::bigint pt, null::varchar pm, null::bigint qid, null::bigint qt, null::varchar qm
  from a where n = 1
  union all select a.car, a.n,
    case when s.id is null or (far and a.t > s.t) then a.id when far then s.id end,
    case when s.id is null or (far and a.t > s.t) then a.t when far then s.t end,
    case when s.id is null or (far and a.t > s.t) then a.m when far then s.m end,
    case when not far then s.id end, case when not far then s.t end, case when not far then s.m end,
    case when not far then a.id end, case when not far then a.t end, case when not far then a.m end
  from (select s.*, a.id aid, abs(a.t - s.t) // 1000 > 3600 far from s join a on a.car = s.car and a.n = s.n + 1) s
  join a on a.car = s.car and a.n = s.n + 1)
select car, pid first_id, qid second_id, case when pt < qt then pm else qm end first_monitor,
  case when pt > qt then pm else qm end second_monitor, '涉嫌套牌车' msg, greatest(pt, qt) action_time from s where pid is not null"""


def _arrival_number(id_):
    """An order of arrival that is not that of the times."""
    return id_ % 7 * 100000000 + id_


@query(ARRIVAL)
def cloned_plates_arrival(spark, folder):
    passages = inputs.passages(spark, folder).withColumn("id", _arrival_number(F.col("id")))
    return sequence.cloned_plates_arrival(passages, 3600)


@query(ARRIVAL.replace("cast(user_id as varchar) car", "event_type car"))
def cloned_plates_arrival_hot(spark, folder):
    """Five cars hold all rows, so all are cut into chunks."""
    passages = _few_cars(spark, folder).withColumn("id", _arrival_number(F.col("id")))
    return sequence.cloned_plates_arrival(passages, 3600, max_rows=HOT_ROWS)


FAST = with_(P, M, LIMITED, """fast as (select car, action_time, id, monitor_id, cast(round(real_speed * 100) as bigint) c,
  row_number() over (partition by car order by action_time, id) seq
  from limited where limit_speed * 1.2::double < real_speed)""", f"""runs as (
  select b.car, min(a.seq) first_seq, b.seq last_seq, count(*) n, {MEAN.format('a.c')} avg_speed
  from fast b join fast a on a.car = b.car and a.seq <= b.seq and b.action_time - a.action_time < {7 * DAY}
  group by b.car, b.seq having count(*) >= 3)""")


def _limited(spark, folder, streaming=False):
    return enrich.with_default_limit(inputs.passages(spark, folder, streaming), inputs.monitors(spark, folder), keep=("id",))


MAXIMAL = FAST + """select r.car, a.action_time first_action_time, a.id first_id, b.action_time last_action_time, b.id last_id,
  r.n, r.avg_speed{0} from runs r join fast a on a.car = r.car and a.seq = r.first_seq
  join fast b on b.car = r.car and b.seq = r.last_seq"""


@query(MAXIMAL.format(", r.first_seq, r.last_seq"))
def dangerous_drivers(spark, folder):
    return sequence.dangerous_drivers(_limited(spark, folder), 3, 7 * DAY)


@query(MAXIMAL.replace("cast(user_id as varchar) car", "event_type car").replace(str(7 * DAY), str(3 * HOUR))
       .format(", r.first_seq, r.last_seq"))
def dangerous_drivers_hot(spark, folder):
    """Five cars hold all rows, so all are cut into chunks."""
    limited = enrich.with_default_limit(_few_cars(spark, folder), inputs.monitors(spark, folder), keep=("id",))
    return sequence.dangerous_drivers(limited, 3, 3 * HOUR, max_rows=HOT_ROWS // 3)


@query(FAST + f"""select a.car, a.action_time first_action_time, a.id first_id, b.action_time last_action_time, b.id last_id,
  b.seq - a.seq + 1 n, a.seq first_seq, b.seq last_seq
from fast a join fast b on a.car = b.car and b.seq - a.seq >= 2 and b.action_time - a.action_time < {7 * DAY}""")
def dangerous_drivers_all(spark, folder):
    return sequence.dangerous_drivers(sequence.fast_passages(_limited(spark, folder)), 3, 7 * DAY, mode="all")


@query(FAST + """select r.car, r.last_seq, s.seq - r.first_seq + 1 step, s.monitor_id
from runs r join fast s on s.car = r.car and s.seq between r.first_seq and r.last_seq""")
def dangerous_driver_steps(spark, folder):
    limited = sequence.fast_passages(_limited(spark, folder))
    alerts = sequence.dangerous_drivers(limited, 3, 7 * DAY)
    return sequence.alert_steps(alerts, sequence.qualifying(limited)).select("car", "last_seq", "step", "monitor_id")


DANGEROUS_LINES = FAST + """select r.car, r.last_seq, '该车辆涉嫌危险驾驶,' || string_agg(
  '第' || (s.seq - r.first_seq + 1) || '个经过卡口是:' || s.monitor_id || ' -->', '' order by s.seq) msg
from runs r join fast s on s.car = r.car and s.seq between r.first_seq and r.last_seq group by r.car, r.last_seq"""


@query(DANGEROUS_LINES)
def dangerous_driver_lines(spark, folder):
    limited = sequence.fast_passages(_limited(spark, folder))
    alerts = sequence.dangerous_drivers(limited, 3, 7 * DAY)
    return sequence.dangerous_lines(alerts, sequence.qualifying(limited)).select("car", "last_seq", "msg")


# --- violations and police actions ------------------------------------------

def _sides(spark, folder, streaming=False):
    passages = inputs.passages(spark, folder, streaming)
    return inputs.as_violations(passages), inputs.as_police_actions(passages)


JOINED = with_(P, V, A, f"""j as (select v.car, v.msg, v.create_time, a.police_id, a.action_status, a.action_time
  from v join a on v.car = a.car and a.action_time between v.create_time - {6 * HOUR} and v.create_time + {6 * HOUR})""")


def _joined(spark, folder, streaming=False):
    violations, police = _sides(spark, folder, streaming)
    return matching.interval_join(violations.drop("id"), police.drop("id"), -6 * HOUR, 6 * HOUR)


@query(JOINED + "select * from j")
def interval_join(spark, folder):
    return _joined(spark, folder)


HANDLED_LINES = JOINED + """select *, '车辆' || car || ',已经有交警出警了，警号为:' || police_id || ',出警的状态是：' || action_status
  || ',出警的时间:' || action_time line from j"""


@query(HANDLED_LINES)
def interval_join_lines(spark, folder):
    return matching.handled_lines(_joined(spark, folder))


MATCH = with_(P, V, A, """u as (select car, id, create_time t, 'V' kind, msg, null police_id, null action_status from v
  union all select car, id, action_time, 'P', null, police_id, action_status from a)""",
              """g as (select *, lag(kind) over w pk, lag(t) over w pt, lag(id) over w pid, lag(msg) over w pmsg,
  lag(police_id) over w ppid, lag(action_status) over w pstat, lead(kind) over w nk, lead(t) over w nt
  from u window w as (partition by car order by t, kind, id))""",
              f"""i as (select *, sum(case when pk is null or pk = kind or t - pt > {6 * HOUR} then 1 else 0 end) over
  (partition by car order by t, kind, id) isl from g)""",
              """r as (select *, row_number() over (partition by car, isl order by t, kind, id) rn,
  count(*) over (partition by car, isl) c from i)""",
              f"""o as (select car, case when rn % 2 = 0 then 'matched' when kind = 'V' then 'no_police_action' else 'no_violation' end outcome,
  case when kind = 'V' then id when rn % 2 = 0 then pid end violation_id,
  case when kind = 'V' then t when rn % 2 = 0 then pt end create_time,
  case when kind = 'V' then msg when rn % 2 = 0 then pmsg end msg,
  case when kind = 'P' then id when rn % 2 = 0 then pid end action_id,
  case when kind = 'P' then t when rn % 2 = 0 then pt end action_time,
  case when kind = 'P' then police_id when rn % 2 = 0 then ppid end police_id,
  case when kind = 'P' then action_status when rn % 2 = 0 then pstat end action_status,
  coalesce(rn % 2 = 1 and nk = kind and nt - t <= {6 * HOUR}, false) superseded, rn, t, nt
  from r where rn % 2 = 0 or rn = c)""")
OUTCOME = "car, outcome, violation_id, create_time, msg, action_id, action_time, police_id, action_status, superseded"


@query(MATCH + f"select {OUTCOME} from o")
def match_with_timeout(spark, folder):
    return matching.match_with_timeout(*_sides(spark, folder), timeout=6 * HOUR)


@query(MATCH.replace("cast(user_id as varchar) car", "'same' car") + f"select {OUTCOME} from o")
def match_with_timeout_hot(spark, folder):
    """One car holds all rows."""
    violations, police = [side.withColumn("car", F.lit("same")) for side in _sides(spark, folder)]
    return matching.match_with_timeout(violations, police, timeout=6 * HOUR, max_rows=HOT_ROWS)


MATCH_LINES = MATCH + """select car, violation_id, action_id, case outcome when 'matched' then
  '该违法车辆' || car || '，违法时间' || create_time || ',已经有交警出警了，警号为:' || police_id || ',出警的状态是：'
  || action_status || ',出警的时间:' || action_time
  when 'no_violation' then '没有对应的违法车辆信息' else '该违法车辆在5分钟内没有交警出警' end line from o"""


@query(MATCH_LINES)
def match_lines(spark, folder):
    outcomes = matching.match_with_timeout(*_sides(spark, folder), timeout=6 * HOUR)
    return matching.matched_lines(outcomes).select("car", "violation_id", "action_id", "line")


OUTER = with_(P, V, A) + f"""select coalesce(v.car, a.car) car, case when a.car is null then 'no_police_action'
  when v.car is null then 'no_violation' else 'matched' end outcome, create_time, msg, action_time, police_id, action_status
from v full join a on v.car = a.car and a.action_time >= v.create_time - {6 * HOUR} and a.action_time <= v.create_time + {6 * HOUR}"""


@query(OUTER)
def match_outer(spark, folder):
    return matching.match_outer(*_sides(spark, folder), timeout=6 * HOUR)


# --- batches and stored tables ----------------------------------------------

BATCHES = with_(P) + """select *, (row_number() over (order by action_time, id) - 1) // 10 batch_id from p"""


@query(BATCHES)
def count_batches(spark, folder):
    return batching.count_batches(inputs.passages(spark, folder), ["action_time", "id"], 10)


@query(BATCHES)
def count_batches_hot(spark, folder):
    """Numbered in chunks, as every large table is."""
    return batching.count_batches(inputs.passages(spark, folder), ["action_time", "id"], 10, max_rows=HOT_ROWS)


@query(with_(P, LISTED) + """select car, action_time, monitor_id, batch_id from (
  select *, (row_number() over (order by action_time, id) - 1) // 10 batch_id, count(*) over () n
  from p where car in (select car from listed)) where batch_id < n // 10""")
def full_batches(spark, folder):
    listed = enrich.in_violation_list(inputs.passages(spark, folder), inputs.violation_list(spark, folder))
    return batching.count_batches(listed, ["action_time", "id"], 10, keep_partial=False).select(
        "car", "action_time", "monitor_id", "batch_id")


FIRST_OF_DAY = with_(P, """d as (select car, area_id violation, action_time create_time,
  cast(make_timestamp(action_time * 1000) as date) "day",
  row_number() over (partition by car, action_time // 86400000 order by action_time, id) rn from p)""",
                     """known as (select distinct car, cast(make_timestamp(action_time * 1000) as date) "day"
  from p where area_id = 'error')""")


@query(FIRST_OF_DAY + """select car, violation, create_time, "day" from d where rn = 1""")
def violation_once_per_day(spark, folder):
    return tables.first_of_day(inputs.passages(spark, folder), msg="area_id")


@query(FIRST_OF_DAY + """select car, violation, create_time, "day" from d where rn = 1
  and not exists (select 1 from known k where k.car = d.car and k."day" = d."day")""")
def violation_insert(spark, folder):
    passages = inputs.passages(spark, folder)
    return tables.violations_once_per_day(passages, inputs.as_violations(passages), msg="area_id")


@query(FIRST_OF_DAY + """select car, violation, create_time, "day" from d where rn = 1""")
def stored_violations(spark, folder):
    """Inserted twice; the second call adds nothing."""
    path = new_path(spark, "violations")
    for _ in range(2):
        tables.write_violations_once_per_day(inputs.passages(spark, folder), path, msg="area_id")
    return spark.read.parquet(path).select("car", "violation", "create_time", "day")


@query(OVERSPEED.format("1.1", ""))
def stored_speeding(spark, folder):
    """Batch 0 is written twice, as a replay does."""
    path = new_path(spark, "speeding")
    alerts = enrich.overspeed_alerts(inputs.passages(spark, folder), inputs.monitors(spark, folder))
    for _ in range(2):
        tables.write_speeding(alerts, path, batch_id=0)
    return spark.read.parquet(path).drop("batch")


@query(with_(P, HOURLY) + "select * exclude (area_id), area_id monitor_id from s")
def stored_average_speed(spark, folder):
    path = new_path(spark, "average-speed")
    tables.write_average_speed(_hourly(inputs.passages(spark, folder)).withColumnRenamed("area_id", "monitor_id"), path)
    return spark.read.parquet(path)


@query(with_(P, LISTED) + """select car || '_' || (9223372036854775807 - action_time)::varchar row_key, car, action_time, monitor_id,
  case when speed > 20 then 'again' else road_id end road_id, area_id, speed,
  cast(make_timestamp(action_time * 1000) as date) "day" from p where car in (select car from listed)""")
def stored_tracks(spark, folder):
    """All tracks, then the faster ones again with another road: the later version counts."""
    path = new_path(spark, "tracks")
    tracks = enrich.violation_tracks(inputs.passages(spark, folder), inputs.violation_list(spark, folder))
    tables.write_tracks(tracks, path, version=0)
    tables.write_tracks(tracks.filter("speed > 20").withColumn("road_id", F.lit("again")), path, version=1)
    return tables.read_tracks(spark, path)


@query(with_(P, LISTED) + f"""select car || '_' || (9223372036854775807 - t)::varchar row_key, car, t action_time, max_by(monitor_id, id) monitor_id,
  max_by(road_id, id) road_id, max_by(area_id, id) area_id, max_by(speed, id) speed, cast(make_timestamp(t * 1000) as date) "day"
from (select *, action_time - action_time % {DAY} t from p where car in (select car from listed)) group by car, t""")
def stored_tracks_last_write(spark, folder):
    """Rows of one key in one batch: the last one counts, not the largest."""
    path = new_path(spark, "tracks")
    passages = inputs.passages(spark, folder).withColumn("action_time", window_start("action_time", DAY))
    tracks = enrich.violation_tracks(passages, inputs.violation_list(spark, folder), keep=("id",))
    tables.write_tracks(tracks, path, version=0, order=("id",))
    return tables.read_tracks(spark, path)


@query(with_(P, LISTED) + """select car || '_' || (9223372036854775807 - action_time)::varchar row_key, car, action_time, monitor_id,
  case when id % 3 = 0 then 'third' when speed > 20 then 'again' else road_id end road_id, area_id, speed,
  cast(make_timestamp(action_time * 1000) as date) "day" from p where car in (select car from listed)""")
def compacted_tracks(spark, folder):
    """Three upserts in a table that merges its folders, the last of them written twice, then compacted in place."""
    table = tables.track_table(spark, new_path(spark, "tracks"))
    tracks = enrich.violation_tracks(inputs.passages(spark, folder), inputs.violation_list(spark, folder), keep=("id",))
    tables.upsert_tracks(tracks, table.path, 0)
    tables.upsert_tracks(tracks.filter("speed > 20").withColumn("road_id", F.lit("again")), table.path, 1)
    for _ in range(2):
        tables.upsert_tracks(tracks.filter("id % 3 = 0").withColumn("road_id", F.lit("third")), table.path, 2)
    table.compact()
    return table.read().drop("version")


@query(OVERSPEED.format("1.1", "").replace("select p.car", "select p.id % 9 batch, p.car"))
def appended_speeding(spark, folder):
    """Nine micro-batches in a table that merges its folders; every one is written again and adds nothing."""
    path = new_path(spark, "speeding")
    alerts = enrich.overspeed_alerts(inputs.passages(spark, folder), inputs.monitors(spark, folder), keep=("id",))
    for batch in [*range(9), 4, 8]:
        tables.append_batch(alerts.filter(F.col("id") % 9 == batch), OVERSPEED_ROWS, path, batch)
    return tables.read_speeding(spark, path)


# --- jobs: from lines to reports ----------------------------------------------

def _job_lines(spark, folder):
    violations, police = _sides(spark, folder)
    return (violations.select(F.concat_ws(",", "car", "msg", F.col("create_time").cast("string")).alias("value"), "id"),
            police.select(F.concat_ws(",", "police_id", "car", "action_status", F.col("action_time").cast("string")).alias("value"), "id"))


@query(OVERSPEED.format("1.1", ""))
def job_overspeed(spark, folder):
    return jobs.overspeed(inputs.log_lines(spark, folder), inputs.monitors(spark, folder))


@query(with_(P, BY_MONITOR) + "select * from s")
def job_average_speed(spark, folder):
    return jobs.average_speed(inputs.log_lines(spark, folder), 3 * DAY, DAY)


@query(TOP_LINES.format(""))
def job_top_congested(spark, folder):
    return jobs.top_congested_lines(inputs.log_lines(spark, folder), 3, 3 * DAY, DAY)


@query(AREA_LINES)
def job_area_distinct(spark, folder):
    return jobs.area_distinct(inputs.log_lines(spark, folder), HOUR)


@query(AREA_LINES)
def job_area_distinct_bloom(spark, folder):
    """Small windows in many bits: no two cars meet."""
    return jobs.area_distinct_bloom(inputs.log_lines(spark, folder), HOUR)


@query(CLONED + "select * from pairs")
def job_cloned_plates(spark, folder):
    return jobs.cloned_plates(inputs.log_lines(spark, folder), 3600)


@query(ARRIVAL)
def job_cloned_plates_arrival(spark, folder):
    lines = inputs.lines(spark, folder).withColumn("id", _arrival_number(F.col("id")))
    return jobs.cloned_plates(lines, 3600, arrival=True)


@query(DANGEROUS_LINES)
def job_dangerous_drivers(spark, folder):
    alerts = jobs.dangerous_drivers(inputs.log_lines(spark, folder), inputs.monitors(spark, folder), within=7 * DAY)
    return alerts.select("car", "last_seq", "msg")


@query(HANDLED_LINES)
def job_violation_police_join(spark, folder):
    violations, police = _job_lines(spark, folder)
    return jobs.violation_police_join(violations.drop("id"), police.drop("id"), -6 * HOUR, 6 * HOUR)


@query(MATCH_LINES)
def job_violation_police_match(spark, folder):
    return jobs.violation_police_match(*_job_lines(spark, folder), timeout=6 * HOUR).select("car", "violation_id", "action_id", "line")


@query(with_(P, LISTED, """k as (select car || '_' || (9223372036854775807 - action_time)::varchar row_key, car, action_time,
  max_by(monitor_id, id) monitor_id, max_by(road_id, id) road_id, max_by(area_id, id) area_id, max_by(speed, id) speed
  from p where car in (select car from listed) group by car, action_time)""") + """
select *, (row_number() over (order by action_time, row_key) - 1) // 10 batch_id from k""")
def job_violation_tracks(spark, folder):
    return jobs.violation_tracks(inputs.log_lines(spark, folder), inputs.violation_list(spark, folder), 10)


# --- streams ----------------------------------------------------------------
# A stream over the same files ends with its watermark at (newest time - delay).
# Windows that end later, and rows the watermark has not reached, stay open.

CLOSED = "end_time <= (select max(action_time) from p) - 5000"


def _drain(spark, folder, stream):
    path = new_path(spark, "stream")
    with runner.state_partitions(spark, inputs.partitions(spark, folder, "events", spark.sparkContext.defaultParallelism)):
        query = runner.to_parquet(stream, f"{path}/rows", f"{path}/checkpoint")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query(OVERSPEED.format("1.1", ""))
def stream_overspeed(spark, folder):
    path = new_path(spark, "stream")
    runner.with_table(
        inputs.passages(spark, folder, True), lambda: inputs.monitors(spark, folder), enrich.overspeed_alerts,
        lambda rows, batch: tables.write_speeding(rows, f"{path}/rows", batch), f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


@query(with_(P, HOURLY) + f"select * from s where {CLOSED}")
def stream_avg_speed(spark, folder):
    return _drain(spark, folder, _hourly(inputs.passages(spark, folder, True)))


@query(with_(P, HOURLY, RANKED.format(key="area_id")) + f"""select * from r where "rank" <= 3 and {CLOSED}""")
def stream_top_n(spark, folder):
    return _drain(spark, folder, windows.top_n_stream(inputs.passages(spark, folder, True), 3, 5 * HOUR, HOUR, "area_id"))


@query(TOP_LINES.format(f"and {CLOSED}"))
def stream_top_n_lines(spark, folder):
    return _drain(spark, folder, windows.top_n_stream_lines(inputs.passages(spark, folder, True), 3, 3 * DAY, DAY))


@query(with_(P, CARS.format(DAY)) + f"select * from c where {CLOSED}")
def stream_distinct_cars(spark, folder):
    return _drain(spark, folder, distinct.distinct_cars_tumbling(inputs.passages(spark, folder, True), DAY))


@query(with_(P, CARS.format(DAY)) + f"""select area_id, start_time, end_time, cars exact, true near from c where {CLOSED}""")
def stream_distinct_cars_approx(spark, folder):
    estimates = _drain(spark, folder, distinct.distinct_cars_approx(inputs.passages(spark, folder, True), DAY))
    exact = distinct.distinct_cars_tumbling(inputs.passages(spark, folder), DAY).withColumnRenamed("cars", "exact")
    return estimates.join(exact, ["area_id", "start_time", "end_time"]).select(
        "area_id", "start_time", "end_time", "exact",
        (F.abs(F.col("cars") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * F.lit(0.04))).alias("near"))


@query(with_(P) + f"""select * from (select area_id, start_time, start_time + {DAY} end_time, count(distinct first_id) cars from (
  select area_id, start_time, o, min(id) first_id from (
    select area_id, id, action_time - action_time % {DAY} start_time, unnest([
      ('0x' || substr(md5(car), 1, 8))::bigint % 256, ('0x' || substr(md5(car), 9, 8))::bigint % 256]) o from p)
  group by all) group by area_id, start_time) where {CLOSED}""")
def stream_distinct_cars_bloom(spark, folder):
    return _drain(spark, folder, distinct.distinct_cars_bloom(inputs.passages(spark, folder, True), DAY, bits=256, hash="md5"))


def _batches(spark, folder, start):
    """Run ``start(write, path)`` to its end and read what was written."""
    path = new_path(spark, "stream")
    write = lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    with runner.state_partitions(spark, inputs.partitions(spark, folder, "events")):
        query = start(write, path)
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("batch")


def _in_files(spark, folder, n, at=None):
    """``events`` as a stream of ``n`` files, or of ``n`` sets of files if large, by time or by ``at`` (microseconds)."""
    path, rows = new_path(spark, "files"), inputs.table(spark, folder, "events")
    files = inputs.files(spark, folder, "events", n)
    at = F.unix_micros(F.col("ts").cast("timestamp")) if at is None else at
    edges = rows.select(F.percentile_approx(at, [x / n for x in range(1, n)])).first()[0]
    written = spark.read.schema(rows.schema)
    for part, (low, high) in enumerate(zip([None, *edges], [*edges, None]), 1):
        some = rows.filter((F.lit(True) if low is None else at > low) & (F.lit(True) if high is None else at <= high))
        (some.coalesce(1) if files == 1 else some.repartition(files)).write.mode("append").parquet(path)
        # Few rows can leave a task without a file; with empty ones a micro-batch still ends where its part ends.
        for _ in range(part * files - len(written.parquet(path).inputFiles())):
            some.limit(0).write.mode("append").parquet(path)
    return inputs.as_passages(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path))


@query(RUNNING + " where action_time < (select max(action_time) from p) - 5000")
def stream_running_distinct(spark, folder):
    """In four files: the totals go on from file to file."""
    stream = _in_files(spark, folder, 4)
    return _batches(spark, folder, lambda write, path: totals.running_distinct(
        stream, DAY, write, f"{path}/totals", f"{path}/checkpoint"))


@query(with_(P) + """select *, (row_number() over (order by action_time, id) - 1) // 10 batch_id from p""")
def stream_count_batches(spark, folder):
    """In three files by time: numbers go on from file to file."""
    stream = _in_files(spark, folder, 3)
    return _batches(spark, folder, lambda write, path: totals.count_batches(
        stream, ["action_time", "id"], write, f"{path}/totals", f"{path}/checkpoint", max_rows=HOT_ROWS))


@query(CLONED + "select * from pairs where action_time < (select max(action_time) from p) - 5000")
def stream_cloned_plates(spark, folder):
    return _drain(spark, folder, stateful.cloned_plates(inputs.passages(spark, folder, True), 3600))


@query(CLONED + f"select * from pairs where action_time < (select max(action_time) from p) - {6 * HOUR}")
def stream_cloned_plates_late(spark, folder):
    """Six files in turn, in which passages come up to six hours late."""
    late = F.unix_micros(F.col("ts").cast("timestamp")) + 1000 * F.pmod(F.xxhash64("event_id"), F.lit(6 * HOUR))
    return _drain(spark, folder, stateful.cloned_plates(_in_files(spark, folder, 6, late), 3600, delay=6 * HOUR))


@query(ARRIVAL)
def stream_cloned_plates_arrival(spark, folder):
    passages = inputs.passages(spark, folder, True).withColumn("id", _arrival_number(F.col("id")))
    return _drain(spark, folder, stateful.cloned_plates(passages, 3600, arrival=True))


@query(MAXIMAL.format("") + " where b.action_time < (select max(action_time) from p) - 5000")
def stream_dangerous_drivers(spark, folder):
    alerts = stateful.dangerous_drivers(_limited(spark, folder, True), 3, 7 * DAY)
    return _drain(spark, folder, alerts).drop("monitors")


@query(JOINED + "select * from j")
def stream_interval_join(spark, folder):
    return _drain(spark, folder, _joined(spark, folder, True))


@query(MATCH + f"""select {OUTCOME} from o, (select least((select max(create_time) from v), (select max(action_time) from a)) - 2000 mark)
where case when outcome = 'matched' then t < mark else t + {6 * HOUR} < mark or coalesce(nt < mark, false) end""")
def stream_match(spark, folder):
    return _drain(spark, folder, stateful.match_with_timeout(*_sides(spark, folder, True), timeout=6 * HOUR))


@query(OUTER)
def stream_match_outer(spark, folder):
    """A last file with rows of a later year moves both watermarks past all others."""
    path, events = new_path(spark, "closed"), inputs.table(spark, folder, "events")
    events.write.parquet(path)
    later = events.select(F.max("ts").alias("ts")).withColumn("event_type", F.explode(F.array(F.lit("error"), F.lit("signup"))))
    later = later.select((F.col("ts") + F.expr("interval 400 days")).alias("ts"), "event_type", F.lit(-1).cast("bigint").alias("user_id"),
                         F.lit(-1).cast("bigint").alias("event_id"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    later.select(events.columns).coalesce(1).write.mode("append").parquet(path)
    stream = inputs.as_passages(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path))
    sides = inputs.as_violations(stream), inputs.as_police_actions(stream)
    return _drain(spark, folder, matching.match_outer(*sides, timeout=6 * HOUR)).filter("car <> '-1'")


@query(MATCH + f"""select {OUTCOME} from o, (select least((select max(create_time) from v), (select max(action_time) from a)) - 2000 mark)
where case when outcome = 'matched' then t < mark else t + {6 * HOUR} < mark or coalesce(nt < mark, false) end""")
def stream_match_split(spark, folder):
    """Each outcome through a writer of its own."""
    path = new_path(spark, "split")
    names = (matching.MATCHED, matching.NO_POLICE_ACTION, matching.NO_VIOLATION)
    write = lambda name: lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
    stream = stateful.match_with_timeout(*_sides(spark, folder, True), timeout=6 * HOUR)
    with runner.state_partitions(spark, inputs.partitions(spark, folder, "events")):
        query = runner.to_batches(stream, runner.split_outcomes({name: write(name) for name in names}), f"{path}/checkpoint")
    query.awaitTermination()
    parts = [spark.read.schema(stream.schema).parquet(f"{path}/{name}/batch=*").filter(F.col("outcome") == name) for name in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _written_lines(spark, folder):
    """The wire lines as text files."""
    path = new_path(spark, "lines")
    inputs.lines(spark, folder).repartitionByRange(6, "id").select("value").write.text(path)
    return path


@query(with_(P) + """select action_time, monitor_id, camera_id, car, speed, road_id, area_id, 1::bigint uses, true known from p""")
def numbered_file_lines(spark, folder):
    """Lines of several files: their numbers are 0 to n - 1, each used once."""
    rows = parse.parse_passages(file_lines(spark, _written_lines(spark, folder), arrival_id=True))
    uses = rows.groupBy("id").agg(F.count(F.lit(1)).alias("uses"))
    return rows.join(uses, "id").withColumn("known", F.col("id").between(0, rows.count() - 1)).drop("id")


@query(with_(P, LISTED, """k as (select car, action_time, max(struct_pack(a := monitor_id, b := road_id, c := area_id, d := speed)) x
  from p where car in (select car from listed) group by car, action_time)""") + """
select car || '_' || (9223372036854775807 - action_time)::varchar row_key, car, action_time, x.a monitor_id, x.b road_id, x.c area_id,
  x.d speed, cast(make_timestamp(action_time * 1000) as date) "day" from k""")
def job_live_violation_tracks(spark, folder):
    """From a stream of files of lines to the compacted table."""
    path = new_path(spark, "live")
    lines = file_lines(spark, _written_lines(spark, folder), streaming=True, glob="part-*", max_files_per_trigger=1)
    jobs.live_violation_tracks(lines, lambda: inputs.violation_list(spark, folder), f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return tables.track_table(spark, f"{path}/rows").read().drop("version")


@query(with_(P) + "select id, car, true now from p")
def ingest_time(spark, folder):
    """The wall clock in place of the records' times."""
    before = int(time.time() * 1000)
    rows = windows.with_ingest_time(inputs.passages(spark, folder))
    return rows.select("id", "car", F.col("action_time").between(before - 60_000, F.lit(before + HOUR)).alias("now"))


@query(TRACKS)
def stream_violation_tracks(spark, folder):
    path = new_path(spark, "stream")
    runner.with_table(
        inputs.passages(spark, folder, True), lambda: inputs.violation_list(spark, folder), enrich.violation_tracks,
        lambda rows, batch: tables.write_tracks(rows, f"{path}/rows", batch), f"{path}/checkpoint").awaitTermination()
    return tables.read_tracks(spark, f"{path}/rows").drop("row_key", "day")
