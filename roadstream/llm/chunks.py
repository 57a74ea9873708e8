"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 32 characters decides where a text is cut: after each place whose hash is the largest
within ``NEAR`` places on either side.  So a cut depends on the characters near it alone, and an insertion moves only the cuts
near it.  Chunks have ``LEAST`` to ``MOST`` code points, about 43 on average, but for a text's last one, which can be shorter.
A chunk whose digest occurs in two or more documents is shared; the document with the smallest key keeps it.  Shared chunks that
adjoin form a span; with ``span``, only spans of so many code points count, which leaves lines out that many texts
share, and can leave out a passage whose ends fall badly.  With 0 all count.  Digests are counted with partial sums, and
each document's shared chunks meet in one place, no chunk's documents do.

Null and empty texts have no chunks.  Rows with equal keys count as one document.  A chunk that repeats inside one document
only is not shared.  An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadstream.llm.texts import keyed_texts, mix, split_rows

LEAST, MOST = 16, 96
NEAR = 20
WINDOW = 32
SPAN = 96
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_GEAR = mix(np.arange(1, 1 << 12, dtype=np.uint64)).astype(np.uint32)
_GEAR = np.concatenate([np.zeros(1, np.uint32), _GEAR])


def gear(codes: np.ndarray) -> np.ndarray:
    """At each place, the sum of the gear values of the last 32 characters, each shifted by its distance."""
    rolled = _GEAR[(codes ^ codes >> 12) & 0xFFF]
    for step in (1, 2, 4, 8, 16):
        later = rolled.copy()
        later[step:] += rolled[:-step] << np.uint32(step)
        rolled = later
    return rolled


def peaks(codes: np.ndarray) -> np.ndarray:
    """The places after those whose hash is larger than any other within ``NEAR`` places."""
    value = mix(gear(codes).astype(np.uint64))
    size, width = len(value), 1
    before = value.copy()  # the largest of the last ``width`` places
    while width < NEAR:
        step = min(width, NEAR - width)
        later = before.copy()
        np.maximum(before[step:], before[:-step], out=later[step:])
        before, width = later, width + step
    top = np.zeros(size, dtype=bool)
    inner = value[NEAR:size - NEAR]
    top[NEAR:size - NEAR] = (inner > before[NEAR - 1:size - NEAR - 1]) & (inner > before[2 * NEAR:])
    return np.flatnonzero(top) + 1


def cuts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, text, start, end) of all chunks; places are those in ``codes``."""
    gap = "\0" * WINDOW
    codes = np.frombuffer((gap + gap.join(texts) + gap).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    first = WINDOW + np.cumsum(length + WINDOW) - (length + WINDOW)
    marks = peaks(codes)
    text, start, end = [], [], []
    low = np.searchsorted(marks, first, side="right").tolist()
    high = np.searchsorted(marks, first + length, side="left").tolist()
    for number, (a, b, at, stop) in enumerate(zip(low, high, first.tolist(), (first + length).tolist())):
        for mark in [*marks[a:b].tolist(), stop]:
            while mark - at > MOST:
                text.append(number)
                start.append(at)
                at += MOST
                end.append(at)
            if mark - at >= LEAST or (mark == stop and mark > at):
                text.append(number)
                start.append(at)
                end.append(mark)
                at = mark
    return codes, np.array(text, np.int64), np.array(start, np.int64), np.array(end, np.int64)


def digests(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each chunk's characters."""
    length = end - start
    offset = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    value = mix(codes[np.repeat(start, length) + offset].astype(np.uint64) + np.uint64(1))
    edge = np.cumsum(length) - length
    found = []
    for factor in _FACTORS:
        powers = np.cumprod(np.full(MOST + 1, factor, dtype=np.uint64))
        found.append(mix(np.add.reduceat(value * powers[offset], edge) ^ length.astype(np.uint64)).view(np.int64))
    return found


def chunk(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, a, b): every chunk with its digest (a, b)."""
    rows = keyed_texts(docs, key, text)

    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                codes, number, start, end = cuts(texts)
                if not len(number):
                    continue
                a, b = digests(codes, start, end)
                first = np.cumsum([WINDOW, *(len(x) + WINDOW for x in texts)])[number]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(number)), pa.array((start - first).astype(np.int32)),
                     pa.array((end - first).astype(np.int32)), pa.array(a), pa.array(b)], ["doc_id", "start", "end", "a", "b"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start int, `end` int, a long, b long")


def shared_spans(docs: DataFrame, span: int = SPAN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, n_chunks, first_doc_id, kept): every span that documents share.

    kept: this document has the smallest key for all of the span, so the span stays in it.
    """
    chunks = chunk(docs, key, text)
    seen = chunks.groupBy("a", "b").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
    shared = seen.filter(F.col("first_doc_id") != F.col("last")).drop("last")
    hits = chunks.join(shared.hint("merge"), ["a", "b"]).select("doc_id", "start", "end", "first_doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("start")
    breaks = F.coalesce((F.lag("end").over(order) != F.col("start")).cast("int"), F.lit(1))
    runs = hits.withColumn("breaks", breaks).withColumn("run", F.sum("breaks").over(order))
    spans = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_chunks"),
        F.min("first_doc_id").alias("first_doc_id"), F.max("first_doc_id").alias("last"))
    return spans.filter(F.col("end") - F.col("start") >= span).select(
        "doc_id", F.col("start").cast("long"), F.col("end").cast("long"), "n_chunks", "first_doc_id",
        ((F.col("first_doc_id") == F.col("doc_id")) & (F.col("last") == F.col("doc_id"))).alias("kept"))


def remove_shared(docs: DataFrame, span: int = SPAN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each shared span cut out of all documents but the one that keeps it."""
    spans = shared_spans(docs, span, key, text).filter(~F.col("kept"))
    gone = spans.groupBy(F.col("doc_id").alias("_key")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_gone"))
    body = F.coalesce(F.col(text), F.lit(""))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col("_gone.end"))
    starts = F.concat(F.col("_gone.start"), F.array(F.length(body).cast("long")))
    pieces = F.transform(F.arrays_zip(ends.alias("at"), starts.alias("to")),
                         lambda x: F.substr(body, (x["at"] + 1).cast("int"), (x["to"] - x["at"]).cast("int")))
    joined = docs.join(gone, docs[key] == F.col("_key"), "left")
    return joined.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))).drop("_key", "_gone")
