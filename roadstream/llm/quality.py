"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

Labels are learned from a bounded sample (``SAMPLE`` labelled rows, those whose key hashes lowest) of the rows that are not
held out; only the text is an input.  Every whole text is scored.  Null counts as empty, and an empty text has a score
like any other.  Labels that are neither 0 nor 1 are not learned from; without usable labels every score is 0.5.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadstream.llm import boosting
from roadstream.llm.texts import Words, keyed_texts, small_batches, split_rows

SAMPLE = 20_000
ACCEPT = 0.3
#: Characters by kind: capital, digit, white space, line end, sentence marks, bars, calls, other signs, beyond ASCII.
KINDS = 10


def _kinds() -> np.ndarray:
    kind = np.zeros(256, dtype=np.int8)
    for point in range(128):
        char = chr(point)
        kind[point] = (1 if char.isupper() else 2 if char.isdigit() else 4 if char == "\n" else 3 if char.isspace()
                       else 5 if char in ".,;:?'\"-()" else 6 if char == "|" else 7 if char == "!" else 0 if char.isalpha() else 8)
    kind[128:] = 9
    return kind


_KIND = _kinds()


def _distinct(doc: np.ndarray, item: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of different items and the most frequent one's occurrences."""
    most = np.zeros(n)
    if not len(doc):
        return np.zeros(n), most
    order = np.lexsort([item, doc])
    doc, item = doc[order], item[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]))
    np.maximum.at(most, doc[first], np.diff(np.append(first, len(doc))))
    return np.bincount(doc[first], minlength=n), most


def statistics(texts: list[str]) -> np.ndarray:
    """One row of numbers per text."""
    words = Words(texts)
    n = len(texts)
    length = np.diff(words.first) - 1
    size = np.maximum(length, 1)
    kind = _KIND[np.minimum(words.codes, 255)]
    edge = words.first[:-1]
    columns = [np.log1p(length)]
    lines = None
    for which in range(1, KINDS):
        found = np.add.reduceat((kind == which).astype(np.int64), edge) if n else np.zeros(0)
        if which == 4:
            lines = found + 1
        columns.append(found / size)
    columns += [np.log1p(lines), length / lines]
    doc = words.doc
    count = np.bincount(doc, minlength=n)
    some = np.maximum(count, 1)
    span = words.end - words.start
    mean = np.bincount(doc, span, n) / some
    columns += [np.log1p(count), mean, np.sqrt(np.maximum(np.bincount(doc, span.astype(float) ** 2, n) / some - mean**2, 0)), count / lines]
    different, most = _distinct(doc, words.hash, n)
    columns += [different / some, most / some, different / np.sqrt(some)]
    same = np.concatenate([[False], (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])])[: len(doc)]
    columns.append(np.bincount(doc, same, n) / some)
    triple, shingle = words.shingles(3)
    columns.append(_distinct(triple, shingle, n)[0] / np.maximum(np.bincount(triple, minlength=n), 1))
    after = kind[np.minimum(words.end, len(kind) - 1)]
    for which in (5, 6, 7, 8):
        columns.append(np.bincount(doc, after == which, n) / some)
    capital = kind[words.start] == 1
    columns.append(np.bincount(doc, capital, n) / some)
    whole = capital & (span > 1) & (kind[words.end - 1] == 1)
    columns.append(np.bincount(doc, whole, n) / some)
    return np.stack(columns, axis=1).astype(np.float64)


def held_out(key: Column, parts: int = 5, rest: int = 0) -> Column:
    """Whether a row's label may not be learned from; rows without a key count as held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == rest, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, sample: int, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(text, label) of at most ``sample`` labelled keys, those that hash lowest; of a key's texts the least."""
    chosen = labels.filter(usable & labels[label].isin(0, 1)).select(labels[key].alias("doc_id"), labels[label].alias("label"))
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = keyed_texts(docs, key, text).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")


def numbers(rows: DataFrame, statistic) -> tuple[np.ndarray, np.ndarray]:
    """The statistics and labels of a bounded sample, on the driver."""
    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                table = statistic(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).cast(pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1]).cast(
                        pa.list_(pa.float64()))], ["label", "row"])

    found = rows.mapInArrow(run, "label int, row array<double>").toPandas()
    width = statistic([""]).shape[1]
    table = np.array(found["row"].tolist(), dtype=np.float64).reshape(len(found), width)
    # The same rows in the same order, whichever task is first.
    order = np.lexsort([found["label"].to_numpy(), *table.T])
    return table[order], found["label"].to_numpy(np.float64)[order]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality", usable: Column | None = None,
          key: str = "doc_id", text: str = "text") -> boosting.Trees:
    usable = ~held_out(labels[key]) if usable is None else usable
    return boosting.fit(*numbers(labelled_sample(docs, labels, label, usable, sample, key, text), statistics))


def scores(docs: DataFrame, model, statistic=statistics, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = keyed_texts(docs, key, text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.score(statistic(texts)))], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def accept(docs: DataFrame, model, least: float = ACCEPT, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores ``least`` or more."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch, text):
                found = sent.value.score(statistics([x or "" for x in texts]))
                yield part.filter(pa.array(found >= least))

    return docs.mapInArrow(run, docs.schema)
