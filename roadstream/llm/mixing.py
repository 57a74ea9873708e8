"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Sources come in order of code points, null last.  They weigh 1, 2, 3, repeating (``cycle``), and share the words of all
documents; a source takes ``most`` times its own words at the most, and what it leaves is shared by weight among the
others until none is above.  With the sources in order of size / weight, that level is the greatest of the levels that
the first k sources' saturation would give.

A source's documents stand in shuffled order on its word line, which is cut into blocks of equal length (to one word;
about ``total / 2^14`` words, ``block`` at the most).  Each source owns as many consecutive points of 0 .. M - 1 as its
target needs blocks.  Slot k of the schedule has the k-th point below M of the van der Corput sequence in base 2 (the
reversed bits of a counter), so every point comes once and each part of the schedule holds each source by its weight.
Slots are ranked per source, in two steps that never sort a source in one task, and a source's slot of rank j takes its
block j modulo the number of blocks; the last one takes what is missing to the target.  So the words taken of a source
are its target rounded, and no word is taken more than ``most`` times.

A word is a run of characters other than blanks, tabs, line ends, vertical tabs and form feeds.  Null texts have none.
The shuffle depends on key, size and ``seed`` only, so partitioning and order of the input do not matter; rows equal in
source, key and size are interchangeable.  Texts without words are never taken.  Every row gives one row; null keys and
null sources are keys and sources of their own; an empty table gives no rows.  Only DataFrame functions are used.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstream.llm.texts import text_of
from roadstream.operators.ordered import Ordered, over_groups
from roadstream.operators.sizing import for_lookup
from roadstream.shared import freeze

#: Fixed value: what separates words from one another is not in this class.
WORD = r"[^\x20\x09-\x0D]+"
SLOTS = 1 << 14
CELL_BITS = 10
EXPAND = 1024


@dataclass(frozen=True)
class Mixture:
    """sources: source, number, size, weight, target, quota (target in words), blocks, slots, before (points of the
    sources before it).  members: number, start (place on the source's word line), doc_id, size, copy (of equal rows).
    slots: k, number, rank."""

    sources: DataFrame
    members: DataFrame
    slots: DataFrame


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _half(bits: int) -> int:
    return (bits + 1) // 2


def _bits(n: int) -> int:
    """Bits of the numbers below ``n``."""
    return max(0, n - 1).bit_length()


def reversed_bits(x: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of ``x`` in reverse order."""
    masks = {1: 0x5555555555555555, 2: 0x3333333333333333, 4: 0x0F0F0F0F0F0F0F0F, 8: 0x00FF00FF00FF00FF, 16: 0x0000FFFF0000FFFF}
    for step, mask in masks.items():
        low = F.lit(mask).cast("long")
        x = F.shiftrightunsigned(x, step).bitwiseAND(low).bitwiseOR(F.shiftleft(x.bitwiseAND(low), step))
    x = F.shiftrightunsigned(x, 32).bitwiseOR(F.shiftleft(x, 32))
    return F.shiftrightunsigned(x, 64 - bits) if bits else F.lit(0).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _targets(sizes: DataFrame, cycle: int, most: int, block: int) -> DataFrame:
    """The sources with their targets, blocks and points."""
    rows = sizes.withColumn("none", F.col("source").isNull())
    add = lambda rows, groups, **sums: groups.running(rows, sums=sums)
    rows = over_groups(rows, [], ["none", "source"], lambda rows, groups: add(rows, groups, number=F.lit(1).cast("long")))
    rows = rows.withColumn("weight", (F.col("number") - 1) % cycle + 1).withColumn("ratio", F.col("size") / F.col("weight"))
    rows = freeze(rows, "sources")
    total, weights = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    rows = over_groups(rows, [], ["ratio", "number"], lambda rows, groups: add(rows, groups, upto=F.col("size"), heavier=F.col("weight")))
    level = (F.lit(total) - most * (F.col("upto") - F.col("size"))) / (F.lit(weights) - F.col("heavier") + F.col("weight"))
    level = rows.agg(F.max(level)).first()[0]
    rows = rows.withColumn("target", F.least((most * F.col("size")).cast("double"), F.lit(level).cast("double") * F.col("weight")))
    rows = rows.withColumn("quota", F.floor(F.col("target") + 0.5))
    length = max(1, min(block, total // SLOTS))
    rows = rows.withColumn("blocks", F.when(F.col("size") > 0, F.greatest(F.lit(1).cast("long"), _div(F.col("size"), F.lit(length)))).otherwise(0))
    # Slots of rank j < slots are needed, where ``slots`` blocks in turn hold the quota or more.
    short, longer = _div(F.col("size"), F.greatest("blocks", F.lit(1))), F.col("size") % F.greatest("blocks", F.lit(1))
    rows = rows.withColumns({"short": short, "longer": longer}).withColumn("rest", F.col("quota") % F.greatest("size", F.lit(1)))
    partial = F.when(F.col("rest") > 0, _block_of(F.col("rest") - 1) + 1).otherwise(0)
    rows = rows.withColumn("slots", _div(F.col("quota"), F.greatest("size", F.lit(1))) * F.col("blocks") + partial)
    rows = over_groups(rows, [], ["number"], lambda rows, groups: add(rows, groups, before=F.col("slots")))
    rows = rows.withColumn("before", F.col("before") - F.col("slots"))
    return freeze(rows.drop("none", "ratio", "upto", "heavier", "rest"), "targets")


def _block_of(word: Column) -> Column:
    """The block that holds a word of the source's line: the first ``longer`` blocks have one word more than ``short``."""
    edge = F.col("longer") * (F.col("short") + 1)
    return F.when(word < edge, _div(word, F.col("short") + 1)).otherwise(
        F.col("longer") + _div(word - edge, F.greatest("short", F.lit(1))))


def _block_start(block: Column) -> Column:
    return block * F.col("short") + F.least(block, F.col("longer"))


def _line(classes: DataFrame, sources: DataFrame) -> DataFrame:
    """Places of the documents on their sources' word lines: number, start, doc_id, size, copy."""
    bits = min(30, _half(_bits(classes.count())) + 1)
    named = for_lookup(sources.select(F.col("source").alias("named"), "number"))
    rows = classes.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("source", "named")
    rows = rows.withColumn("bucket", F.shiftright(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long"), 32 - bits))
    rows = rows.withColumn("words", F.col("size") * F.col("copies"))
    # Sums per bucket first: no task sorts a whole source.
    sums = rows.groupBy("number", "bucket").agg(F.sum("words").alias("held"))
    sums = sums.withColumn("before", F.sum("held").over(Window.partitionBy("number").orderBy("bucket")) - F.col("held"))
    inside = Window.partitionBy("number", "bucket").orderBy("shuffle", F.col("doc_id").cast("string"), "size")
    rows = rows.withColumn("start", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
    rows = rows.join(sums.select("number", "bucket", "before"), ["number", "bucket"]).withColumn("start", F.col("start") + F.col("before"))
    rows = freeze(rows.select("number", "start", "doc_id", "size", "copies"), "line")
    # Copies of a key that fills much of the table are dealt out in shares.
    few = rows.filter(F.col("copies") <= EXPAND).withColumn("share", F.lit(0).cast("long"))
    many = rows.filter(F.col("copies") > EXPAND).withColumns({"share": F.lit(0).cast("long"), "held": F.lit(EXPAND ** 4)})
    for step in (EXPAND ** 3, EXPAND ** 2, EXPAND):
        last = F.least(F.col("share") + F.col("held"), F.col("copies")) - 1
        many = many.withColumn("share", F.explode(F.sequence("share", last, F.lit(step).cast("long")))).withColumn("held", F.lit(step))
        many = many.repartition("number", "start", "share")
    dealt = few.unionByName(many.drop("held")).withColumn("copy", F.explode(F.sequence(
        F.col("share"), F.least(F.col("share") + EXPAND, F.col("copies")) - 1)))
    return dealt.select("number", (F.col("start") + F.col("copy") * F.col("size")).alias("start"), "doc_id", "size", "copy")


def _slots(sources: DataFrame) -> DataFrame:
    """(k, number, rank): the schedule's slots in order of k, and their rank among the source's slots."""
    spark = sources.sparkSession
    points = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    bits = _bits(points)
    counter = spark.range(1 << bits if points else 0).select(F.col("id").alias("k"), reversed_bits(F.col("id"), bits).alias("point"))
    counter = counter.filter(F.col("point") < points).withColumn("cell", F.shiftright("point", CELL_BITS))
    # Cumulative weights, met by cells of points: an equality join in place of a comparison with every source.
    owned = sources.filter("slots > 0").select("number", "before", "slots", F.explode(F.sequence(
        F.shiftright("before", CELL_BITS), F.shiftright(F.col("before") + F.col("slots") - 1, CELL_BITS))).alias("cell"))
    slots = counter.join(for_lookup(freeze(owned, "cells")), "cell").filter(
        (F.col("point") >= F.col("before")) & (F.col("point") < F.col("before") + F.col("slots")))
    slots = slots.select("k", "number", F.shiftright("k", _half(bits)).alias("part"))
    counts = slots.groupBy("number", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("earlier", F.sum("n").over(Window.partitionBy("number").orderBy("part")) - F.col("n"))
    slots = slots.withColumn("rank", F.row_number().over(Window.partitionBy("number", "part").orderBy("k")) - 1)
    return slots.join(counts.drop("n"), ["number", "part"]).select("k", "number", (F.col("rank") + F.col("earlier")).alias("rank"))


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", cycle: int = 3, most: int = 3,
            block: int = 1024, seed: int = 0) -> Mixture:
    """Targets, shuffled word lines and schedule."""
    rows = docs.select(docs[source].alias("source"), docs[key].alias("doc_id"), word_count(text_of(docs, text)).alias("size"))
    classes = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    classes = classes.withColumn("shuffle", F.md5(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"), F.lit(str(seed)))))
    classes = freeze(classes, "documents")
    sizes = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
    sources = _targets(sizes, cycle, most, block)
    return Mixture(sources, freeze(_line(classes, sources), "members"), _slots(sources))


def mix(mixture: Mixture) -> DataFrame:
    """The mix: (k, number, start, doc_id, copy, size, first, last), words ``first`` to ``last`` (exclusive) of a document in
    slot k; the document is the one that begins at ``start`` of its source's line."""
    blocks = for_lookup(mixture.sources.select("number", "blocks", "short", "longer", "quota", F.col("size").alias("whole")))
    pieces = mixture.members.filter("size > 0").join(blocks, "number").withColumn("block", F.explode(F.sequence(
        _block_of(F.col("start")), _block_of(F.col("start") + F.col("size") - 1))))
    slots = mixture.slots.join(blocks.select("number", "blocks"), "number").select(
        "k", "number", (F.col("rank") % F.col("blocks")).alias("block"), _div(F.col("rank"), F.col("blocks")).alias("epoch"))
    met = pieces.join(slots, ["number", "block"])
    # What is missing to the quota ends the source's last slot.
    end = F.least(_block_start(F.col("block") + 1), F.col("quota") - F.col("epoch") * F.col("whole"))
    first = F.greatest(_block_start(F.col("block")), F.col("start")) - F.col("start")
    last = F.least(end, F.col("start") + F.col("size")) - F.col("start")
    return met.select("k", "number", "start", "doc_id", "copy", "size", first.alias("first"), last.alias("last")).filter("first < last")


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target (of its source), taken (words that the mix takes)."""
    made = mixture(docs, **options)
    identity = ["number", "start", "doc_id", "size", "copy"]
    rows = mix(made).select(*identity, (F.col("last") - F.col("first")).alias("words"))
    rows = rows.unionByName(made.members.select(*identity, F.lit(0).cast("long").alias("words")))
    rows = rows.groupBy(*identity).agg(F.sum("words").alias("taken"))
    sources = for_lookup(made.sources.select("number", F.col("size").alias("source_size"), "target"))
    return rows.join(sources, "number").select("doc_id", "size", "source_size", "target", "taken")
