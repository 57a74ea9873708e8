"""Conversation repair against a row-by-row dynamic program, and the parts of its grammar."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from roadstream.llm import grammar, repair
from roadstream.shared import ship_package
from tests.llm.conftest import FOLDER

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def show(value):
    return " " if value is None else str(value)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def after(state):
    return "a" if state == "u" else "u"


NAMES = {"u": "user", "a": "assistant"}


def close(best):
    for _ in range(3):
        for state, (cost, audit, lines) in list(best.items()):
            put(best, after(state), (cost + 2, audit + "I", (*lines, f"{NAMES[after(state)]}:")))
    return best


def put(best, state, way):
    if state not in best or way[:2] < best[state][:2]:
        best[state] = way


def solve(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        new: dict = {}
        for state, (cost, audit, lines) in close(best).items():
            put(new, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            put(new, after(state), (cost + 2, audit + "R", (*lines, f"{NAMES[after(state)]}:{text}")))
            if role[:1] == after(state) or role[:1] == "s" and not state:
                put(new, role[0], (cost, audit + "K", (*lines, f"{role}:{text}")))
        best = new
    cost, audit, lines = min((way for state, way in close(best).items() if state in ("", "a")), key=lambda x: x[:2])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows, ids):
    convs = {x: [] for x in ids}
    for conv, *row in rows:
        convs[conv].append(row)
    return {conv: solve(x) for conv, x in convs.items()}


@pytest.fixture(scope="session")
def table(spark):
    ship_package(spark)

    def make(rows, parts=3):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        return df.withColumns({"at": F.lit("x"), "n": F.lit(9), "conv": F.lit(1), "piece": F.lit(2), "kind": F.lit(3)}).repartition(parts)
    return make


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def odd_rows(seed, convs, most):
    pick = random.Random(seed)
    texts = ["Fine.", "Well!", "So?", "cut off", "", " \t", "Fine.", "Long " * 50 + ".", None, "é.", "a\x1c.", ".\x0b", "Other."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "System", "umpire", "arbiter"]
    return [(conv, pick.choice([turn, turn, turn, None, turn + 2]), pick.choice(roles[:pick.choice([5, 11])]), pick.choice(texts))
            for conv in [None, *range(convs)] for turn in range(pick.randint(1, most))]


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_conversations(table, seed):
    rows = odd_rows(seed, 60, 14)
    df = table(rows)
    assert got(repair.repair(repair.damage(df), df)) == expected(damaged(rows), {r[0] for r in rows})


def test_long_conversation_in_pieces(table):
    """Pieces of 5 rows, chunks of 40 rows: levels of products, and one row over a thousand times."""
    rows = odd_rows(3, 8, 30) + [(50, t, "user" if t % 2 else "assistant", f"{t % 90}.") for t in range(700)] + [(51, 3, "user", "Again.")] * 1000
    df = table(rows)
    ids = {r[0] for r in rows}
    filled = [(c, t, show(r), show(x)) for c, t, r, x in rows]
    assert got(repair.repair(df, df, piece=5, max_rows=40)) == expected(filled, ids)


def test_given_table(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(repair.repair(repair.damage(df), df)) == expected(damaged(rows), {r[0] for r in rows})


def test_empty_and_dropped(table):
    assert got(repair.repair(repair.damage(table([])), table([]))) == {}
    gone = next((c, 0, "user", "Hi.") for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = table([gone])
    assert got(repair.repair(repair.damage(df), df)) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_rules_do_not_change_products():
    pick = random.Random(5)
    bodies = [[pick.randrange(grammar.TERMINALS) for _ in range(pick.randint(0, 40))] for _ in range(80)]
    plain = [grammar.cheapest(grammar.product([grammar.terminal(x) for x in body])) for body in bodies]
    rules, short = [], [list(x) for x in bodies]
    for _ in range(4):
        counts = grammar.Counter()
        for body in short:
            counts.update(grammar.pairs(body))
        chosen = grammar.choose([(*pair, n) for pair, n in counts.items()], 5)
        numbers = {pair: grammar.TERMINALS + len(rules) + n for n, pair in enumerate(chosen)}
        rules += chosen
        short = [grammar.replace(x, numbers) for x in short]
    assert rules and sum(map(len, short)) < sum(map(len, bodies))
    made = grammar.evaluate(rules)
    assert [grammar.cheapest(grammar.product([made[x] for x in body])) for body in short] == plain


def test_ropes_compare_as_texts():
    pick = random.Random(6)
    for _ in range(400):
        texts = ["".join(pick.choices("DIKR", weights=[1, 1, 9, 1], k=pick.randint(0, 90))) for _ in range(2)]
        if pick.random() < 0.5:
            texts[1] = texts[0][:60] + texts[1]
        ropes = []
        for text in texts:
            rope = grammar.Rope()
            while text:
                n = pick.randint(1, 25)
                rope, text = rope + grammar.Rope(text[:n]), text[n:]
            ropes.append(rope)
        assert [str(x) for x in ropes] == texts and (ropes[0] < ropes[1]) == (texts[0] < texts[1])
