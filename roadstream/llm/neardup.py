"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words in lower case (a shorter text with words is one shingle); its weight in a text is its number of
occurrences times 2 + ln(total / max(df, floor)) / ln(HEAVY), where df counts the rows that hold it, total
is the sum of all df and floor = total / HEAVY.  At most HEAVY shingles can reach the floor; those are counted exactly,
from a fixed-size table of counts that first leaves only candidates, and every other shingle has the highest weight 3.
So document frequencies come from all texts, and the list that tasks receive has a proven bound at any size.

Texts with the same words are one class from the start, and one representative row of each is sampled: ``SAMPLES``
consistent weighted samples, in ``BANDS`` bands.  Two texts of similarity s share a band with probability
1 - (1 - s^4)^16, 0.9998 at 0.8.  The samples travel with the members of a bucket; a pair is verified, by its exact
weighted Jaccard similarity, if ``AGREE`` of 64 samples are equal (0.99998 of pairs at 0.8; the share of equal samples
estimates the similarity).  In every bucket the most central member (the one whose buckets hold most rows) leads and meets
the others.  Verified links are joined into components.  In a bucket that still holds several, all pairs across components
are compared if it has at most ``SMALL`` members; in a larger one, the most central member outside the leader's component
leads once more and meets the members of other components.

Members of larger buckets that hold several components even then are dealt out again by fresh, longer bands: ``SPLITS``
sets of ``LONG`` of their samples, of which two texts at 0.8 share one with probability 0.99 and two at 0.5 seldom.  There
they are compared in the same way.  What then still stands in large buckets of several components falls into clusters, the
components of rows that share a band.  All texts of a cluster are compared exactly: they are dealt into tiles of bounded
size, every two tiles meet in a task, and no pair becomes a row but those that join two components there.

Rows are numbered in a written table, so keys need not be unique.  Null and empty texts, and those without words, are near
no other text and form classes of their own.  Equal rows with words are in one class.  Every row gives one row.  An empty
table gives no rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from roadstream.llm.graph import components
from roadstream.llm.texts import Words, mix, small_batches, split_rows, text_of
from roadstream.operators.sizing import for_lookup
from roadstream.shared import freeze

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
HEAVY = 1 << 16
TABLE_BITS = 20
TOP = 3.0
SALT_ROWS = 128
SMALL = 32
#: Equal samples of a pair that is verified; sets of samples that make the fresh bands, and their size.
AGREE = 38
SPLITS, LONG = 48, 8
#: Members of buckets that a task compares at once.
CHUNK_ROWS = 1 << 12
#: Texts and code points of a tile in exact comparisons, and the most tasks that tiles are dealt to.
TILE_ROWS, TILE_CHARS, TILE_TASKS = 512, 1 << 20, 10_000
_DRAWS = 1 << 16


def _per_text(doc: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, shingle) with their number of occurrences, in this order."""
    order = np.lexsort([shingle, doc])
    doc, shingle = doc[order], shingle[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])])[: len(doc)])
    return doc[first], shingle[first], np.diff(np.append(first, len(doc)))


class Weights:
    """Weights of shingles: ``heavy`` ones (sorted) by their df, any other the highest."""

    def __init__(self, heavy: np.ndarray, df: np.ndarray, total: int):
        order = np.argsort(heavy)
        self.heavy = heavy[order]
        floor = max(1.0, total / HEAVY)
        self.weight = TOP - 1 + np.log(max(total, 1) / np.maximum(df[order], floor)) / np.log(HEAVY)
        self.weight = np.clip(self.weight, TOP - 1, TOP)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        found = np.full(len(shingles), TOP)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, shingles), len(self.heavy) - 1)
            known = self.heavy[at] == shingles
            found[known] = self.weight[at[known]]
        return found


def _draws() -> tuple[np.ndarray, ...]:
    """Tables of the random parts of a sample: r and ln c of Gamma(2, 1), and beta; the last is ln a for the top weight."""
    random = np.random.default_rng(20240229)
    r, c, beta = random.gamma(2, 1, _DRAWS), random.gamma(2, 1, _DRAWS), random.random(_DRAWS)
    log_c = np.log(c)
    return tuple(x.astype(np.float32) for x in (r, log_c, beta))


R, LOG_C, BETA = _draws()


def _log_a(draw: np.ndarray, log_weight) -> tuple[np.ndarray, np.ndarray]:
    """(ln a, t) of the consistent weighted sampling scheme."""
    r, beta = R[draw], BETA[draw]
    t = np.floor(log_weight / r + beta)
    return LOG_C[draw] - r * (t - beta) - r, t


_TOP_A, _TOP_T = _log_a(np.arange(_DRAWS), np.float32(np.log(TOP)))


def samples(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, bands: int = BANDS, rows: int = ROWS,
            sketch: np.ndarray | None = None) -> np.ndarray:
    """Band hashes (texts x bands) of texts given as sorted ``doc`` with their distinct shingles.

    ``sketch`` (texts x samples) receives 16 bits of each sample.
    """
    edge = np.flatnonzero(np.diff(doc, prepend=-1))
    length = np.diff(np.append(edge, len(doc)))
    plain = np.flatnonzero(weight == TOP)
    other = np.flatnonzero(weight != TOP)
    log_other = np.log(weight[other]).astype(np.float32)
    out = np.zeros((len(edge), bands), dtype=np.uint64)
    a, t = np.empty(len(doc), np.float32), np.empty(len(doc), np.float32)
    base = np.repeat(np.arange(len(edge)), length)
    place = np.arange(len(doc))
    for sample in range(bands * rows):
        keyed = mix_once(shingle, sample)
        draw = (keyed >> np.uint64(48)).astype(np.int64)
        a[plain], t[plain] = _TOP_A[draw[plain]], _TOP_T[draw[plain]]
        if len(other):
            a[other], t[other] = _log_a(draw[other], log_other)
        least = np.minimum.reduceat(a, edge)
        # Ties of the drawn values are broken by the keyed hash, the same in every text.
        rivals = np.flatnonzero(a == least[base])
        order = np.lexsort([keyed[rivals], base[rivals]])
        rivals = rivals[order][np.diff(base[rivals[order]], prepend=-1) > 0]
        chosen = mix(keyed[rivals] ^ (t[rivals].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        if sketch is not None:
            sketch[:, sample] = chosen >> np.uint64(48)
        band = sample // rows
        out[:, band] = mix(out[:, band] * np.uint64(31) + chosen + np.uint64(band))
    return out


def mix_once(shingle: np.ndarray, number: int) -> np.ndarray:
    keyed = (shingle ^ np.uint64((number * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    keyed ^= keyed >> np.uint64(32)
    return keyed * np.uint64(0xD6E8FEB86659FD93)


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two texts as (sorted shingles, weights)."""
    _, a, b = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    least = np.minimum(left[1][a], right[1][b]).sum()
    return float(least / (left[1].sum() + right[1].sum() - least))


def weighted(texts: list[str], weights: Weights) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted shingles, weights) of each text."""
    doc, shingle, times = _per_text(*Words(texts).shingles(WORDS))
    weight = times * weights.of(shingle)
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [(shingle[a:b], weight[a:b]) for a, b in zip(edge, edge[1:])]


def _words_digest(words: Words, n: int) -> list[str | None]:
    """A digest of each text's words in order; None without words."""
    count = np.bincount(words.doc, minlength=n)
    found: list[str | None] = [None] * n
    offset = np.arange(len(words.hash)) - (np.cumsum(count) - count)[words.doc]
    parts = []
    for seed in (1, 2):
        value = mix(words.hash + mix(offset.astype(np.uint64) * np.uint64(2 * seed + 1)) + np.uint64(seed))
        total = np.zeros(n, dtype=np.uint64)
        used = np.flatnonzero(count)
        if len(used):
            total[used] = np.add.reduceat(value, (np.cumsum(count) - count)[used])
        parts.append(total)
    for x in np.flatnonzero(count):
        found[x] = f"{int(parts[0][x]):016x}{int(parts[1][x]):016x}{int(count[x]):x}"
    return found


def heavy_shingles(rows: DataFrame) -> Weights:
    """Document frequencies of the shingles that reach the floor."""
    size = 1 << TABLE_BITS
    piece = 1 << 12

    def slots(shingle):
        return (shingle >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def count(batches):
        task, table = TaskContext.get().partitionId(), np.zeros(size, dtype=np.int64)
        for batch in batches:
            for _, texts in split_rows(batch):
                _, shingle, _ = _per_text(*Words(texts).shingles(WORDS))
                table += np.bincount(slots(shingle), minlength=size)
        for at in range(0, size, piece):
            body = table[at:at + piece]
            if body.any():
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([task], pa.int32()), pa.array([body.tobytes()])],
                                                 ["at", "task", "body"])

    def add(key, frame):
        total = np.sum([np.frombuffer(x, dtype=np.int64) for x in frame["body"]], axis=0)
        return pd.DataFrame({"at": [key[0]], "task": [key[-1] >> 6], "total": [int(total.sum())], "body": [total.tobytes()]})

    spark = rows.sparkSession
    # 64 tasks' tables are added up at a time, so no group grows with the number of tasks beyond its root.
    shape = "at long, task int, total long, body binary"
    tables = rows.select("text").mapInArrow(count, "at long, task int, body binary")
    tables = tables.groupBy("at", (F.col("task") / 64).cast("int").alias("task")).applyInPandas(add, shape)
    tables = freeze(tables.groupBy("at").applyInPandas(add, shape), "counts")
    total = tables.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    floor = max(2.0, total / HEAVY)

    def above(batches):
        for batch in batches:
            for at, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.flatnonzero(np.frombuffer(body, dtype=np.int64) >= floor) + at
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["slot"])

    # The counts add up to the total, so at most HEAVY slots reach the floor.
    used = tables.select("at", "body").mapInArrow(above, "slot long").toPandas()["slot"].to_numpy(np.int64)
    open_ = np.zeros(size, dtype=bool)
    open_[used] = True
    sent = spark.sparkContext.broadcast(np.packbits(open_))

    def candidates(batches):
        mask = np.unpackbits(sent.value).view(bool)
        kept = []
        for batch in batches:
            for _, texts in split_rows(batch):
                _, shingle, _ = _per_text(*Words(texts).shingles(WORDS))
                kept.append(shingle[mask[slots(shingle)]])
                if sum(map(len, kept)) > 1 << 22:
                    yield partial(kept)
                    kept = []
        yield partial(kept)

    def partial(kept):
        found, n = np.unique(np.concatenate([np.empty(0, np.uint64), *kept]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["shingle", "n"])

    heavy = rows.select("text").mapInArrow(candidates, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("df"))
    heavy = heavy.filter(F.col("df") >= floor).toPandas()  # HEAVY rows at most, as above
    return Weights(heavy["shingle"].to_numpy(np.int64).view(np.uint64), heavy["df"].to_numpy(np.float64), int(total))


def signatures(rows: DataFrame, weights: Weights) -> DataFrame:
    """(row, digest, bands, sketch) of ``rows`` (row, text): digest of the words, null without words, and their samples."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                words = Words(texts)
                doc, shingle, times = _per_text(*words.shingles(WORDS))
                bands, sketches = [None] * len(texts), [None] * len(texts)
                if len(doc):
                    numbers = np.unique(doc)
                    sketch = np.empty((len(numbers), SAMPLES), np.uint16)
                    hashes = samples(doc, shingle, times * sent.value.of(shingle), sketch=sketch).view(np.int64)
                    for number, row, own in zip(numbers, hashes, sketch):
                        bands[number], sketches[number] = row.tolist(), own.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(_words_digest(words, len(texts)), pa.string()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(sketches, pa.binary())], ["row", "digest", "bands", "sketch"])

    return rows.mapInArrow(run, "row long, digest string, bands array<long>, sketch binary")


def agreeing(pairs: DataFrame, least: int = AGREE) -> DataFrame:
    """(leader, doc) of the different ``pairs`` (leader, doc, left, right) with ``least`` equal samples."""
    def run(batches):
        for batch in batches:
            sketches = [np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint16).reshape(-1, SAMPLES) for x in (2, 3)]
            keep = pa.array((sketches[0] == sketches[1]).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(x).filter(keep) for x in (0, 1)], ["leader", "doc"])

    return pairs.select("leader", "doc", "left", "right").mapInArrow(run, "leader long, doc long").distinct()


def agreeing_inside(members: DataFrame, least: int = AGREE) -> DataFrame:
    """(leader, doc), the smaller first, of pairs across parts of ``members`` (bucket, doc, sketch, part) with ``least`` equal samples.

    Rows of a bucket lie together in a task and are compared there, so a pair becomes a row only if it agrees.  A task holds
    a chunk and the rows of one bucket, so buckets should be of bounded size.
    """
    def pairs(bucket, doc, part, sketch):
        found = [np.empty((0, 2), np.int64)]
        for step in range(1, len(bucket)):
            left = np.flatnonzero(bucket[:-step] == bucket[step:])
            if not len(left):
                break
            left = left[part[left] != part[left + step]]
            left = left[(sketch[left] == sketch[left + step]).sum(axis=1) >= least]
            found.append(np.stack([doc[left], doc[left + step]], axis=1))
        found = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["leader", "doc"])

    def run(batches):
        held = None
        for batch in batches:
            rows = [batch.column(x).to_numpy(zero_copy_only=False) for x in range(3)]
            rows.append(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16).reshape(-1, SAMPLES))
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if len(held[0]) >= CHUNK_ROWS:
                # The last bucket may go on in the next batch.
                edge = int(np.searchsorted(held[0], held[0][-1]))
                yield pairs(*(x[:edge] for x in held))
                held = [x[edge:] for x in held]
        if held is not None:
            yield pairs(*held)

    dealt = members.select("bucket", "doc", "part", "sketch").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "leader long, doc long")


def fresh_bands(members: DataFrame) -> DataFrame:
    """(bucket, *columns) of ``members``: one row for each of ``SPLITS`` sets of ``LONG`` samples."""
    pick = np.random.default_rng(20240307)
    sets = np.array([pick.choice(SAMPLES, LONG, replace=False) for _ in range(SPLITS)])
    names = members.columns

    def run(batches):
        for batch in batches:
            sketch = np.frombuffer(b"".join(batch.column(names.index("sketch")).to_pylist()), np.uint16).reshape(-1, SAMPLES).astype(np.uint64)
            bucket = np.tile(np.arange(SPLITS, dtype=np.uint64), (len(sketch), 1))
            for place in range(LONG):
                bucket = mix(bucket * np.uint64(31) + sketch[:, sets[:, place]] + np.uint64(1))
            again = pa.array(np.repeat(np.arange(len(sketch)), SPLITS))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64).ravel()), *(x.take(again) for x in batch.columns)], ["bucket", *names])

    schema = ", ".join(f"{x} {members.schema[x].dataType.simpleString()}" for x in names)
    return members.mapInArrow(run, f"bucket long, {schema}")


def verify(pairs: DataFrame, texts: DataFrame, weights: Weights, similar: float = SIMILAR) -> DataFrame:
    """Those of ``pairs`` (leader, doc) whose weighted Jaccard similarity is ``similar`` or more.

    A leader's pairs are dealt into shares of about ``SALT_ROWS``, and its text goes to each share once.
    """
    sent = pairs.sparkSession.sparkContext.broadcast(weights)
    shares = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("shares"))
    left = shares.join(texts.withColumnsRenamed({"doc": "leader", "text": "leader_text"}), "leader").select(
        F.col("leader").alias("head"), "leader_text",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("head_share"))
    right = pairs.join(shares, "leader").select(
        "leader", "doc", F.pmod(F.xxhash64("doc"), "shares").alias("share")).join(texts, "doc")

    def run(key, leader, members):
        near = []
        if len(leader) and len(members):
            first = weighted([leader["leader_text"].iloc[0]], sent.value)[0]
            for at in range(0, len(members), 16):
                part = members.iloc[at:at + 16]
                near += [x for x, y in zip(part["doc"], weighted(part["text"].tolist(), sent.value))
                         if len(first[0]) and len(y[0]) and similarity(first, y) >= similar]
        return pd.DataFrame({"leader": [key[0]] * len(near), "doc": near})

    kind = pairs.schema["doc"].dataType.simpleString()
    return left.groupBy("head", "head_share").cogroup(right.groupBy("leader", "share")).applyInPandas(run, f"leader {kind}, doc {kind}")


def _classed(docs: DataFrame, key: str, text: str, similar: float) -> tuple[DataFrame, DataFrame]:
    """The numbered rows (row, doc_id, text, whole), and per row: row, doc_id, class_id, kept."""
    small_batches(docs.sparkSession)
    stored = freeze(docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("doc_id"), docs[text].alias("text"),
                                F.struct(*(docs[x] for x in docs.columns if x != text)).alias("whole")), "documents")
    rows = stored.select("row", text_of(stored).alias("text"))
    weights = heavy_shingles(rows)
    signed = freeze(signatures(rows, weights), "signatures")
    named = signed.select("row", "digest").join(stored.select("row", "doc_id"), "row")
    # Of texts with the same words one row stands for all; the first by key stays, null keys last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    same = freeze(named.filter("digest is not null").groupBy("digest").agg(F.min("row").alias("doc"), first), "same-words")
    stand = signed.join(for_lookup(same.select("doc")), signed["row"] == F.col("doc"), "left_semi")
    stand = freeze(stand.select(F.col("row").alias("doc"), "bands", "sketch"), "stand")
    keys = stand.select("doc", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = freeze(keys.join(shared.hint("merge"), "bucket"), "buckets")
    centre = met.groupBy("doc").agg(F.sum(F.log2("n")).alias("score")).join(stand.select("doc", "sketch"), "doc")
    met = freeze(met.select("bucket", "doc").join(centre, "doc"), "members")
    needed = for_lookup(met.select("doc").distinct())
    texts = freeze(rows.join(needed, rows["row"] == needed["doc"], "left_semi").select(F.col("row").alias("doc"), "text"), "texts")
    links = _linked(met, texts, weights, similar)
    roots = components(links.select(F.col("leader").alias("a"), F.col("doc").alias("b")))
    parted = same.join(roots, same["doc"] == roots["node"], "left").select("digest", "best", F.coalesce("root", "doc").alias("root"))
    best = parted.groupBy("root").agg(F.min("best").alias("first"))
    classed = parted.join(best, "root").select("digest", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("keep"))
    found = named.join(classed, "digest", "left").select(
        "row", "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("row") == F.col("keep"), F.lit(True)).alias("kept"))
    return stored, found


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id): one row per row of ``docs``; class_id is the smallest key of the class."""
    return _classed(docs, key, text, similar)[1].select("doc_id", "class_id")


def _parted(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with ``part``, their component by ``links``."""
    roots = components(links.select(F.col("leader").alias("a"), F.col("doc").alias("b"))).withColumnRenamed("node", "doc")
    return members.join(roots, "doc", "left").withColumn("part", F.coalesce("root", "doc")).drop("root")


_MEMBER = ["doc", "sketch", "part"]


def _mixed(parted: DataFrame) -> DataFrame:
    """Members of buckets that hold several parts, with the bucket's size and most central member."""
    mixed = parted.groupBy("bucket").agg(
        F.max_by(F.struct(*_MEMBER), F.struct("score", "doc")).alias("best"), F.count(F.lit(1)).alias("n"),
        F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("bucket", "best", "n")
    return parted.join(mixed.hint("merge"), "bucket")


def _unsettled(parted: DataFrame) -> DataFrame:
    """Members of buckets that hold several parts, without the buckets."""
    mixed = parted.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    return parted.join(mixed.select("bucket").hint("merge"), "bucket", "left_semi").drop("bucket").distinct()


def _crossing(live: DataFrame, heads: tuple[str, ...] = ("best", "next")) -> DataFrame:
    """Agreeing pairs across parts (leader, doc): all in buckets of up to ``SMALL`` members, else with two leaders.

    ``heads`` leaves out the first leader where all have met it.
    """
    small = agreeing_inside(live.filter(F.col("n") <= SMALL))
    many = live.filter(F.col("n") > SMALL)
    second = many.filter(F.col("part") != F.col("best.part")).groupBy("bucket").agg(
        F.max_by(F.struct(*_MEMBER), F.struct("score", "doc")).alias("next"))
    wide = many.join(second.hint("merge"), "bucket").withColumn("head", F.explode(F.array(*heads)))
    wide = wide.filter(F.col("part") != F.col("head.part"))
    return small.unionByName(agreeing(wide.select(
        F.col("head.doc").alias("leader"), "doc", F.col("head.sketch").alias("left"), F.col("sketch").alias("right")))).distinct()


def _linked(met: DataFrame, texts: DataFrame, weights: Weights, similar: float) -> DataFrame:
    """Verified links (leader, doc) between members of a bucket (bucket, doc, score, sketch)."""
    leaders = met.groupBy("bucket").agg(F.max_by(F.struct("doc", "sketch"), F.struct("score", "doc")).alias("best"))
    first = met.join(leaders.hint("merge"), "bucket").filter(F.col("doc") != F.col("best.doc"))
    first = first.select(F.col("best.doc").alias("leader"), "doc", F.col("best.sketch").alias("left"), F.col("sketch").alias("right"))
    tried = freeze(agreeing(first), "pairs")
    found = freeze(verify(tried, texts, weights, similar), "links")

    def more(pairs: DataFrame) -> DataFrame:
        """Links among ``pairs`` that were not tried yet."""
        nonlocal tried
        both = tried.unionByName(tried.select(F.col("doc").alias("leader"), F.col("leader").alias("doc")))
        pairs = freeze(pairs.join(both.hint("merge"), ["leader", "doc"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        return freeze(verify(pairs, texts, weights, similar), "links")

    live = freeze(_mixed(_parted(met, found)), "mixed")
    found = found.unionByName(more(_crossing(live, ("next",))))
    wide = live.filter(F.col("n") > SMALL).select("bucket", "doc", "score", "sketch")
    open_ = freeze(_unsettled(_parted(wide, found)), "open")
    if not open_.head(1):
        return found
    live = freeze(_mixed(fresh_bands(open_)), "mixed")
    found = found.unionByName(more(_crossing(live)))
    rest = _unsettled(_parted(live.filter(F.col("n") > SMALL).select("bucket", "doc"), found))
    rest = freeze(rest.select("doc", "part"), "rest")
    if not rest.head(1):
        return found
    return found.unionByName(close_links(clusters(rest, met), texts, weights, similar))


def clusters(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """``members`` with ``cluster``: the component of those that share one of ``buckets`` (bucket, doc)."""
    held = buckets.select("bucket", "doc").join(for_lookup(members.select("doc")), "doc", "left_semi")
    first = held.groupBy("bucket").agg(F.min("doc").alias("a"))
    roots = components(held.join(first.hint("merge"), "bucket").select("a", F.col("doc").alias("b")))
    roots = roots.select(F.col("node").alias("doc"), F.col("root").alias("cluster"))
    return members.join(roots, "doc", "left").withColumn("cluster", F.coalesce("cluster", "doc"))


def near_places(left: list[tuple], right: list[tuple], similar: float = SIMILAR):
    """Places (in ``left``, in ``right``) of the vectors whose similarity is ``similar`` or more."""
    shingle = np.concatenate([np.empty(0, np.uint64), *(x for x, _ in right)])
    order = np.argsort(shingle, kind="stable")
    shingle, held = shingle[order], np.concatenate([np.empty(0), *(x for _, x in right)])[order]
    owner = np.repeat(np.arange(len(right)), [len(x) for x, _ in right])[order]
    total = np.array([x.sum() for _, x in right])
    for place, (own, weight) in enumerate(left):
        begin = np.searchsorted(shingle, own)
        n = np.searchsorted(shingle, own, side="right") - begin
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        least = np.bincount(owner[at], np.minimum(held[at], np.repeat(weight, n)), len(right))
        # Sums in another order differ in their last digits, so the definition decides at the bound.
        for other in np.flatnonzero((least > 0) & (least >= similar * (1 - 1e-9) * (weight.sum() + total - least))):
            if similarity((own, weight), right[other]) >= similar:
                yield place, int(other)


def close_links(members: DataFrame, texts: DataFrame, weights: Weights, similar: float = SIMILAR) -> DataFrame:
    """Links (leader, doc) that join the parts of ``members`` (doc, part, cluster) as all similar pairs of a cluster do.

    A cluster of parts is dealt into tiles of about ``TILE_ROWS`` texts and ``TILE_CHARS`` code points, and a task compares
    two of them, so its memory is bounded.  It gives one row for each two parts that it joins, whatever their sizes.
    """
    sent = members.sparkSession.sparkContext.broadcast(weights)
    held = freeze(texts.join(members, "doc").select("doc", "part", "cluster", "text"), "held")
    sizes = held.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / TILE_ROWS), F.ceil(F.sum(F.length("text")) / TILE_CHARS), F.lit(1)).alias("tiles"),
        F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("cluster", "tiles")
    sizes = freeze(sizes, "tiles")
    meetings = sizes.agg(F.sum(F.expr("tiles * (tiles + 1) div 2"))).first()[0] or 1
    tiled = held.join(for_lookup(sizes), "cluster").withColumn("tile", F.pmod(F.xxhash64("doc"), "tiles"))
    tiled = tiled.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = tiled.select("cluster", F.least("tile", "met").alias("low"), F.greatest("tile", "met").alias("high"), "tile", "doc", "part", "text")

    def run(key, frame):
        body, vectors = frame["text"].tolist(), []
        for at in range(0, len(body), 16):
            vectors += weighted(body[at:at + 16], sent.value)
        doc, part, tile = (frame[x].tolist() for x in ("doc", "part", "tile"))
        sides = [[x for x, own in enumerate(tile) if own == side] for side in key[1:]]
        above, found = {}, []

        def top(x):
            while above.get(x, x) != x:
                x = above[x]
            return x

        for x, y in near_places(*([vectors[x] for x in side] for side in sides), similar):
            x, y = sides[0][x], sides[1][y]
            a, b = top(part[x]), top(part[y])
            if a != b:
                above[max(a, b)] = min(a, b)
                found.append((min(doc[x], doc[y]), max(doc[x], doc[y])))
        return pd.DataFrame(found, columns=["leader", "doc"], dtype="int64")

    keys = ["cluster", "low", "high"]
    dealt = dealt.repartition(min(int(meetings), TILE_TASKS), *keys)
    return freeze(dealt.groupBy(*keys).applyInPandas(run, "leader long, doc long"), "links")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the first by key."""
    stored, rows = _classed(docs, key, text, SIMILAR)
    gone = for_lookup(freeze(rows.filter("not kept").select("row"), "gone"))
    kept = stored.join(gone, "row", "left_anti")
    return kept.select(*((F.col("whole")[x] if x != text else F.col("text")).alias(x) for x in docs.columns))
