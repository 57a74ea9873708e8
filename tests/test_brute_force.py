"""Set-based operators against plain state machines on random input.

One car holds most rows and times repeat often.  Every operator runs with
whole groups and with groups cut into small chunks.
"""

import random

import pytest
from pyspark.sql import functions as F

from roadstream.functions.hashing import bit_offsets
from roadstream.operators import distinct, matching, sequence
from roadstream.operators.ordered import Ordered, over_groups
from tests.conftest import rows

SPLITS = [None, 1_000_000, 37]


def history(seed, n=700, span=400_000, cars=6):
    r = random.Random(seed)
    out = []
    for i in range(n):
        car = "hot" if r.random() < 0.6 else f"car{r.randrange(cars)}"
        out.append((i, r.randrange(span // 500) * 500, car, f"m{r.randrange(5)}", r.randrange(1, 2000) / 10, f"a{r.randrange(2)}"))
    return out


def by_car(passages):
    groups = {}
    for row in sorted(passages, key=lambda p: (p[1], p[0])):
        groups.setdefault(row[2], []).append(row)
    return groups


def walk_clones(passages):
    out = []
    for car, group in by_car(passages).items():
        first = None
        for row in group:
            if first is None:
                first = row
            elif abs(row[1] - first[1]) // 1000 <= 2:
                out.append((car, first[0], row[0], first[3] if row[1] > first[1] else row[3], row[3]))
                first = None
            else:
                first = row
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_rows", SPLITS)
def test_cloned_plates(make, max_rows):
    passages = history(1)
    got = sequence.cloned_plates(make.passages(passages), 2, max_rows=max_rows)
    assert rows(got, "car", "first_id", "second_id", "first_monitor", "second_monitor") == walk_clones(passages)


def walk_runs(passages, within):
    maximal, every = [], []
    for car, group in by_car(passages).items():
        window = []
        for row in (g for g in group if 60 * 1.2 < g[4]):
            window = [w for w in window if row[1] - w[1] < within] + [row]
            for at in range(len(window) - 2):
                run = window[at:]
                every.append((car, run[0][0], row[0], len(run)))
                if at == 0:
                    tenths = sum(round(w[4] * 10) for w in run)
                    cents = (2 * tenths * 10 + len(run)) // (2 * len(run))
                    maximal.append((car, run[0][0], row[0], len(run), cents / 100))
    return sorted(maximal, key=repr), sorted(every, key=repr)


@pytest.mark.parametrize("max_rows", SPLITS)
def test_dangerous_drivers(make, max_rows):
    passages = history(2)
    limited = make.passages(passages).withColumns({"real_speed": F.col("speed"), "limit_speed": F.lit(60)})
    maximal, every = walk_runs(passages, 6000)
    got = sequence.dangerous_drivers(limited, within=6000, max_rows=max_rows)
    assert rows(got, "car", "first_id", "last_id", "n", "avg_speed") == maximal
    got = sequence.dangerous_drivers(limited, within=6000, mode="all", max_rows=max_rows)
    assert rows(got, "car", "first_id", "last_id", "n") == every


def walk_matches(passages, timeout):
    events = {}
    for i, t, car, _, _, area in passages:
        events.setdefault(car, []).append((t, "V" if area == "a0" else "P", i))
    out = []

    def alone(car, e, superseded):
        out.append((car, "no_police_action", e[2], None, superseded) if e[1] == "V"
                   else (car, "no_violation", None, e[2], superseded))

    for car, group in events.items():
        pending = None
        for e in sorted(group):
            if pending is None:
                pending = e
            elif e[1] != pending[1] and e[0] - pending[0] <= timeout:
                v, p = (e, pending) if e[1] == "V" else (pending, e)
                out.append((car, "matched", v[2], p[2], False))
                pending = None
            else:
                alone(car, pending, e[1] == pending[1] and e[0] - pending[0] <= timeout)
                pending = e
        if pending:
            alone(car, pending, False)
    return sorted(out, key=repr)


def sides(df):
    v = df.filter("area_id = 'a0'").select("id", "car", F.lit("x").alias("msg"), F.col("action_time").alias("create_time"))
    p = df.filter("area_id = 'a1'").select("id", F.lit("p").alias("police_id"), "car", F.lit("s").alias("action_status"), "action_time")
    return v, p


@pytest.mark.parametrize("max_rows", SPLITS)
def test_match_with_timeout(make, max_rows):
    passages = history(3)
    got = matching.match_with_timeout(*sides(make.passages(passages)), timeout=1500, max_rows=max_rows)
    assert rows(got, "car", "outcome", "violation_id", "action_id", "superseded") == walk_matches(passages, 1500)


def test_interval_join(make):
    passages = history(4, n=300)
    v, p = sides(make.passages(passages))
    for low, high in ((-5000, 5000), (-1000, 4000), (500, 700), (0, 0)):
        got = matching.interval_join(v.withColumnRenamed("id", "v"), p.withColumnRenamed("id", "p"), low, high)
        want = sorted([(a[0], b[0]) for a in passages for b in passages if a[5] == "a0" and b[5] == "a1"
                       and a[2] == b[2] and low <= b[1] - a[1] <= high], key=repr)
        assert rows(got, "v", "p") == want


@pytest.mark.parametrize("max_rows", SPLITS)
def test_running_distinct(make, max_rows):
    passages = history(5)
    want, seen = [], {}
    for i, t, car, _, _, area in sorted(passages, key=lambda p: (p[1], p[0])):
        cars = seen.setdefault((area, t // 100_000), set())
        cars.add(car)
        want.append((i, len(cars)))
    got = distinct.running_distinct(make.passages(passages), 100_000, max_rows=max_rows)
    assert rows(got, "id", "cars") == sorted(want, key=repr)


@pytest.mark.parametrize("hash", ["md5", "xxhash64"])
def test_bloom_counts_like_a_filter(make, hash):
    passages = [(i, t, f"{car}{i % 23}", m, s, a) for i, t, car, m, s, a in history(6)]
    df = make.passages(passages)
    offsets = dict(rows(df.select("car", bit_offsets("car", 64, hash).alias("o")).distinct()))
    assert all(0 <= o < 64 for pair in offsets.values() for o in pair)
    filters, counts, exact = {}, {}, {}
    for i, t, car, _, _, area in sorted(passages):
        key = (area, t // 100_000 * 100_000)
        bits = filters.setdefault(key, set())
        exact.setdefault(key, set()).add(car)
        counts[key] = counts.get(key, 0) + (not set(offsets[car]) <= bits)
        bits |= set(offsets[car])
    so_far, seen = [], {}
    for i, t, car, _, _, area in sorted(passages):
        key = (area, t // 100_000)
        bits, n = seen.get(key, (set(), 0))
        n += not set(offsets[car]) <= bits
        seen[key] = (bits | set(offsets[car]), n)
        so_far.append((i, n))
    for max_rows in SPLITS:
        got = distinct.running_bloom(df, 100_000, bits=64, hash=hash, max_rows=max_rows)
        assert rows(got, "id", "cars") == sorted(so_far, key=repr)
    got = distinct.distinct_cars_bloom(df, 100_000, bits=64, hash=hash)
    assert rows(got, "area_id", "start_time", "cars") == sorted([(*k, n) for k, n in counts.items()], key=repr)
    assert all(counts[k] <= len(exact[k]) for k in counts)
    assert any(counts[k] < len(exact[k]) for k in counts)


def test_unknown_hash():
    with pytest.raises(ValueError):
        bit_offsets("car", 64, "crc")


def test_null_keys_stay_one_group(make):
    passages = make.passages([(i, i, None, "m", 1.0, "a") for i in range(40)] + [(99, 1, "x", "m", 1.0, "a")])
    for max_rows in SPLITS[1:]:
        got = over_groups(passages.select("car", "action_time", "id"), ["car"], ["action_time", "id"],
                          lambda r, g: g.running(r, sums={"n": F.lit(1)}), max_rows)
        assert rows(got, "id", "n") == sorted([(i, i + 1) for i in range(40)] + [(99, 1)], key=repr)


def test_group_without_keys_in_chunks(make):
    passages = make.passages(history(7))
    def body(r, g: Ordered):
        r = g.neighbours(r, ["id"])
        return g.running(r, sums={"n": F.lit(1), "t": F.col("speed")}, maxima={"top": F.col("speed")})
    whole, cut = [over_groups(passages, [], ["action_time", "id"], body, n) for n in (None, 50)]
    columns = ["id", "prev", "next", "n", F.round("t", 3), "top"]
    assert rows(whole.select(*columns)) == rows(cut.select(*columns))
