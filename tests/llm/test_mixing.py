"""Mixing, against the rules it has to keep and plain loops."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadstream.llm import mixing
from roadstream.shared import ship_package
from tests.llm.conftest import FOLDER, words


@pytest.fixture(scope="session")
def table(spark):
    def make(rows, parts=3):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return df.withColumns({"size": F.lit("x"), "number": F.lit(1), "target": F.lit(0.5), "copies": F.lit(None).cast("int")}).repartition(parts)
    return make


def water(sizes, cycle=3, most=3):
    """Targets by sharing the excess again and again."""
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {x: n % cycle + 1 for n, x in enumerate(names)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[x] for x in full)
        heavy = sum(weight[x] for x in names if x not in full)
        target = {x: most * sizes[x] if x in full else rest * weight[x] / heavy for x in names}
        above = {x for x in names if x not in full and target[x] > most * sizes[x] + 1e-9}
        if not above:
            return target
        full |= above


def check(rows, got):
    size = lambda text: len(re.findall("[^\x20\x09-\x0D]+", text or ""))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    target = water(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    assert sorted(repr((r.doc_id, r["size"])) for r in got) == sorted(repr((k, size(t))) for k, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    want = defaultdict(int)
    for x, n in sizes.items():
        want[n, round(target[x], 6)] += int(target[x] + 0.5)
    assert {x: n for x, n in taken.items()} == dict(want)


def test_mixture(table):
    rows = [(k, " ".join(words(k, k % 37)), f"s{k % 5}") for k in range(300)]
    rows += [(k, " ".join(words(k, 20)), None) for k in range(400, 410)] + [(900, "only one", "tiny")]
    # A source with a third of all rows, one key many times, nulls, blanks, a long text, equal rows.
    rows += [(7, "a b\tc", "big")] * 2500 + [(None, None, "s1"), (None, "x\x0by", None), (5, " \n", "blank"), (6, "w " * 30000, "s2"), (6, "w " * 30000, "s2")]
    check(rows, mixing.taken(table(rows)).collect())


def test_layout_does_not_matter(table):
    rows = [(k % 50, " ".join(words(k, k % 11)), f"s{k % 3}") for k in range(200)]
    first = sorted(mixing.taken(table(rows)).collect())
    assert first == sorted(mixing.taken(table(rows[::-1], 7)).collect())
    assert first != sorted(mixing.taken(table(rows), seed=1).collect())


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")], [(1, "one", "a")]])
def test_little(table, rows):
    check(rows, mixing.taken(table(rows)).collect())


def test_schedule(spark):
    """Every slot once; each prefix holds the sources by weight; pieces of a slot are one block's words, none above 3 times."""
    ship_package(spark)
    made = mixing.mixture(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    slots = sorted((r.k, r.number, r["rank"]) for r in made.slots.collect())
    sources = {r.number: r for r in made.sources.collect()}
    assert len({k for k, _, _ in slots}) == len(slots) == sum(r.slots for r in sources.values())
    seen = Counter()
    for n, (_, number, rank) in enumerate(slots, 1):
        assert rank == seen[number]
        seen[number] += 1
        if n % 500 == 0:
            for x, r in sources.items():
                assert abs(seen[x] - n * r.slots / len(slots)) < 16
    pieces = mixing.mix(made).collect()
    per_slot = Counter()
    for r in pieces:
        per_slot[r.k] += r["last"] - r["first"]
    whole = [n for n in per_slot.values()]
    assert max(whole) - min(sorted(whole)[len(sources):]) <= max(r.short for r in sources.values()) - min(r.short for r in sources.values()) + 1
    assert sum(per_slot.values()) == sum(r.quota for r in sources.values())


def test_reversed_bits(spark):
    rows = spark.range(64).select("id", mixing.reversed_bits(F.col("id"), 6).alias("back")).collect()
    assert all(r.back == int(f"{r.id:06b}"[::-1], 2) for r in rows)


def test_plan_is_native(spark):
    df = mixing.taken(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
