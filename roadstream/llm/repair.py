"""Repair of conversation structure by dynamic programming over compressed role and fault sequences.

A conversation's rows, by turn (nulls first; ties by role and text), become a sequence of symbols of role and fault.
Different sequences are compressed together by Re-Pair: each round counts neighbours over all sequences with partial sums
and makes the ``RULES`` most frequent independent pairs symbols of their own.  One min-plus matrix per symbol, with the
ASCII-least audit as a rope, is evaluated bottom up and serves all conversations.  What no rule covers is multiplied out,
so the number of rounds does not matter to the result.  Equal sequences are solved once.  Sequences are cut into pieces
of ``PIECE`` rows, whose matrices are multiplied level by level, 64 at a time, so a conversation of any length spreads.

Faults, the first that holds: blank (nothing but blanks, tabs, line ends, vertical tabs and form feeds), duplicate (role
and text stand earlier in the conversation), truncated (the last other character is none of ``.!?``).  Edits: Keep 0,
Rerole to user or assistant 2, Delete 3 (blank and duplicate rows have to go), Insert an empty user or assistant row 2; a
truncated row that stays adds 1.  The role initials that remain are none, or user and assistant in turn after an optional
system row.  Of the cheapest audits the ASCII-least counts; it says which role each row gets.

Null roles and texts are one space.  Equal rows are counted before they are ordered, so any number of them is one row.
Rows without turn come first and stand in no gap.  A null conversation id is an id.  Every id gives one row, also one
without rows (zeros, an empty audit, the hash of nothing).  An empty table gives no rows.  Other columns are not read.
The repaired rows of one conversation are hashed in order by one task, row after row, as the digest asks for.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstream.llm import grammar
from roadstream.llm.texts import small_batches
from roadstream.operators.ordered import CHUNK, GROUP, GROUP_ROWS, over_groups
from roadstream.operators.sizing import for_lookup
from roadstream.shared import freeze

#: Characters that make a text blank, and those that end one.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
PIECE = 4096
RULES, ROUNDS = 256, 8
LEVEL = 64


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: 0 drops, 1 empties the text, 2 removes its ends, 3 repeats, 4 makes a user row."""
    shown = [F.coalesce(conversations[x].cast("string"), F.lit(" ")) for x in ("conv_id", "turn", "role", "text")]
    rows = conversations.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"),
                                (F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20).alias("kind")).filter("kind > 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered_rows(rows: DataFrame, max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Different rows in order: conv, at (place from 0), n (equal rows), turn, role, text, blank, again, truncated, illegal."""
    shown = [F.coalesce(rows[x].cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")]
    rows = rows.select(F.struct("conv_id").alias("conv"), "turn", *shown)
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("initial", F.substring("role", 1, 1))
    order = ["turn", "role", "text"]

    def place(rows, groups):
        if not groups.chunked:
            rows = rows.repartition("conv")  # one exchange serves all windows
        seen = Window.partitionBy(*groups.group, "role", "text").orderBy("turn")
        rows = rows.withColumn("again", F.row_number().over(seen) > 1)
        if groups.chunked:
            # A text's first row in a later chunk stands again too; one row per chunk takes part in this.
            firsts = rows.filter(~F.col("again")).withColumn("_least", F.min(CHUNK).over(Window.partitionBy(GROUP, "role", "text")))
            firsts = firsts.withColumn("again", F.col(CHUNK) > F.col("_least")).drop("_least")
            rows = groups.settled(rows.filter("again").unionByName(firsts))
        rows = groups.neighbours(rows, ["initial"])
        return groups.running(rows, sums={"upto": F.col("n")})

    rows = over_groups(rows, ["conv"], order, place, max_rows)
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    met = F.concat(F.col("prev.initial"), F.col("initial"))
    blank = F.translate("text", BLANKS, "") == ""
    return rows.select(
        "conv", (F.col("upto") - F.col("n")).alias("at"), "n", "turn", "role", "text", blank.alias("blank"),
        (~blank & F.col("again")).alias("again"), (~blank & ~F.col("again") & ~last.isin(*ENDS)).alias("truncated"),
        (F.col("n") - 1 + F.when(F.col("prev").isNotNull() & ~met.isin("su", "ua", "au"), 1).otherwise(0)).alias("illegal"))


def _symbol() -> Column:
    role = F.substring("role", 1, 1)
    kind = F.lit(grammar.OTHER)
    for initial, number in grammar.ROLES.items():
        kind = F.when(role == initial, number).otherwise(kind)
    kind = F.when(F.col("blank") | F.col("again"), grammar.DELETE).when(F.col("truncated"), kind + grammar.OTHER).otherwise(kind)
    return kind.cast("string")


def sequences(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv, piece, sequence): one digit per row, ``piece`` rows at a time."""
    last = F.col("at") + F.col("n") - 1
    number = lambda x: F.call_function("div", x, F.lit(piece))
    rows = rows.select("conv", "at", "n", _symbol().alias("symbol"), F.explode(F.sequence(number(F.col("at")), number(last))).alias("piece"))
    first = F.greatest("at", F.col("piece") * piece)
    end = F.least(F.col("at") + F.col("n"), (F.col("piece") + 1) * piece)
    # All but the first of equal rows are duplicates.
    owns = first == F.col("at")
    digits = F.concat(F.when(owns, F.col("symbol")).otherwise(""), F.repeat(
        F.lit(str(grammar.DELETE)), (end - first - F.when(owns, 1).otherwise(0)).cast("int")))
    parts = rows.select("conv", "piece", first.alias("first"), digits.alias("digits"))
    parts = parts.groupBy("conv", "piece").agg(F.sort_array(F.collect_list(F.struct("first", "digits"))).alias("parts"))
    return parts.select("conv", "piece", F.array_join("parts.digits", "").alias("sequence"))


def learn_rules(different: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> tuple[list[tuple[int, int]], DataFrame]:
    """Re-Pair rules of all sequences and the sequences (sequence, body) in their symbols."""
    spark = different.sparkSession
    found: list[tuple[int, int]] = []
    bodies = different.select("sequence", F.transform(F.split("sequence", ""), lambda x: x.cast("int")).alias("body"))
    bodies = freeze(bodies.withColumn("body", F.filter("body", lambda x: x.isNotNull())), "bodies")

    def count(batches):
        total = grammar.Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                total.update(grammar.pairs(body))
        left, right = ([pair[side] for pair in total] for side in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(total.values(), pa.int64())],
                                         ["left", "right", "n"])

    for _ in range(rounds):
        counts = bodies.select("body").mapInArrow(count, "left int, right int, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))
        top = counts.filter("n > 1").orderBy(F.desc("n"), "left", "right").limit(4 * rules).collect()
        chosen = grammar.choose([tuple(x) for x in top], rules)
        if not chosen:
            break
        numbers = {pair: grammar.TERMINALS + len(found) + x for x, pair in enumerate(chosen)}
        found += chosen

        def shorten(batches, numbers=numbers):
            for batch in batches:
                body = [grammar.replace(x, numbers) for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(body, pa.list_(pa.int32()))], ["sequence", "body"])

        bodies = freeze(bodies.mapInArrow(shorten, "sequence string, body array<int>"), "bodies")
    return found, bodies


_MATRIX = "costs array<long>, audits array<string>"


def _columns(matrices) -> list[pa.Array]:
    costs, audits = zip(*map(grammar.packed, matrices)) if matrices else ((), ())
    return [pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]


def solve(pieces: DataFrame) -> DataFrame:
    """(conv, cost, audit) of each conversation, from its ``pieces``."""
    spark = pieces.sparkSession
    rules, bodies = learn_rules(pieces.select("sequence").distinct())
    sent = spark.sparkContext.broadcast(grammar.evaluate(rules))
    conv = pieces.schema["conv"].dataType.simpleString()

    def matrix(batches):
        for batch in batches:
            made = [grammar.product([sent.value[x] for x in body]) for body in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(made)], ["sequence", "costs", "audits"])

    def merge(batches):
        for batch in batches:
            made = [grammar.product([grammar.unpacked(x["costs"], x["audits"]) for x in parts]) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *_columns(made)], ["conv", "piece", "costs", "audits"])

    def finish(batches):
        for batch in batches:
            found = [grammar.cheapest(grammar.unpacked(*x)) for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())],
                                             [batch.schema.names[0], "cost", "audit"])

    solved = freeze(bodies.mapInArrow(matrix, f"sequence string, {_MATRIX}"), "matrices")
    several = pieces.filter("piece > 0").select("conv").distinct()
    alone = pieces.join(several, "conv", "left_anti").select("conv", "sequence")
    short = solved.join(alone.select("sequence").distinct(), "sequence", "left_semi")
    short = freeze(short.mapInArrow(finish, "sequence string, cost long, audit string"), "solved")
    found = alone.join(for_lookup(short), "sequence").select("conv", "cost", "audit")
    level = freeze(pieces.join(several, "conv", "left_semi").join(solved, "sequence").select("conv", "piece", "costs", "audits"), "level")
    most = level.agg(F.max("piece")).first()[0]
    if most is None:
        return found
    while most:
        parts = level.groupBy("conv", F.call_function("div", F.col("piece"), F.lit(LEVEL)).alias("piece")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("piece").alias("place"), "costs", "audits"))).alias("parts"))
        level = freeze(parts.mapInArrow(merge, f"conv {conv}, piece long, {_MATRIX}"), "level")
        most //= LEVEL
    return found.unionByName(level.select("conv", "costs", "audits").mapInArrow(finish, f"conv {conv}, cost long, audit string"))


def repaired_digests(rows: DataFrame, solved: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv, repaired_sha256): hash of the repaired rows ``role:text``, joined by line ends.

    Rows follow their piece's part of the audit in one sorted stream per task; nothing of a conversation is collected.
    """
    conv = solved.schema["conv"].dataType.simpleString()

    def cut(batches):
        edits = re.compile("I*[DKR]").finditer
        for batch in batches:
            out = [], [], []
            for row, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts = [x.start() for n, x in enumerate(edits(audit)) if n % piece == 0]
                for number, (a, b) in enumerate(zip(starts, [*starts[1:], len(audit)])):
                    for column, value in zip(out, (row, number, audit[a:b])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                                             ["conv", "piece", "text"])

    def hashed(batches):
        current = None
        for batch in batches:
            done = []
            for conv, number, at, role, text in zip(*(batch.column(x).to_pylist() for x in range(5))):
                if at < 0 and number == 0:
                    if current:
                        done.append((current.conv, current.end()))
                    current = _Repaired(conv)
                current.segment(text) if at < 0 else current.row(at - number * piece, role, text)
            yield made(done, batch)
        if current:
            yield made([(current.conv, current.end())], batch)

    def made(done, batch):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], batch.schema.field(0).type), pa.array([x[1] for x in done], pa.string())],
                                          ["conv", "repaired_sha256"])

    none = F.lit(None).cast("string")
    audits = solved.select("conv", "audit").mapInArrow(cut, f"conv {conv}, piece long, text string")
    audits = audits.select("conv", "piece", F.lit(-1).cast("long").alias("at"), none.alias("role"), "text")
    stays = rows.filter(~F.col("blank") & ~F.col("again"))
    stays = stays.select("conv", F.call_function("div", F.col("at"), F.lit(piece)).alias("piece"), "at", "role", "text")
    stream = audits.unionByName(stays).repartition("conv").sortWithinPartitions("conv", "piece", "at")
    return stream.mapInArrow(hashed, f"conv {conv}, repaired_sha256 string")


class _Repaired:
    """One conversation's repaired rows as they come."""

    def __init__(self, conv):
        self.conv, self.state, self.hash, self.lines = conv, grammar.START, hashlib.sha256(), 0
        self.edits, self.next = [], 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.lines > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _turn(self, text: str) -> None:
        """A row that gets the role that comes next."""
        self.state = grammar.ASSISTANT if self.state == grammar.USER else grammar.USER
        self._line("user" if self.state == grammar.USER else "assistant", text)

    def _until(self, place: int) -> None:
        while self.next < place:
            for _ in range(self.edits[self.next].count("I")):
                self._turn("")
            self.next += 1

    def segment(self, audit: str) -> None:
        self._until(len(self.edits))
        self.edits, self.next = re.findall("I*[DKR]|I+", audit), 0

    def row(self, place: int, role: str, text: str) -> None:
        self._until(place + 1)
        edit = self.edits[place][-1]
        if edit == "R":
            self._turn(text)
        elif edit == "K":
            self.state = {"s": grammar.SYSTEM, "u": grammar.USER, "a": grammar.ASSISTANT}[role[0]]
            self._line(role, text)

    def end(self) -> str:
        self._until(len(self.edits))
        return self.hash.hexdigest()


def repair(rows: DataFrame, ids: DataFrame, piece: int = PIECE, max_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Per id of ``ids`` (conv_id): faults of its ``rows`` (conv_id, turn, role, text), cost, audit and digest of the repair."""
    small_batches(rows.sparkSession)
    placed = freeze(ordered_rows(rows, max_rows), "rows")
    count = lambda name, value: F.sum(value).alias(name)
    many = lambda condition: F.when(condition, F.col("n")).otherwise(0)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = placed.groupBy("conv").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), count("blank", many(F.col("blank"))),
        count("duplicate", F.when(F.col("blank"), 0).otherwise(F.col("n") - 1 + F.col("again").cast("long"))),
        count("truncated", F.col("truncated").cast("long")), count("illegal", F.col("illegal")))
    solved = freeze(solve(freeze(sequences(placed, piece), "sequences")), "audits")
    digests = repaired_digests(placed, solved, piece)
    found = ids.select(F.struct("conv_id").alias("conv")).distinct()
    for part in (counts, solved, digests):
        found = found.join(part, "conv", "left")
    zero = [F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
