"""Token-id files under a canonical Huffman code of limited length.

A file set is a Parquet folder ``blocks`` and a table ``codebook`` (id, bits): the code is rebuilt from the lengths
alone.  A block holds whole documents in ascending order of their key: their keys, their numbers of ids, the bits,
and the bit offset of every ``STEP``-th id of each document.  Blocks are independent, and within a block all
checkpoints are decoded side by side through one table of 2^limit entries.  Lengths come from the counts of all ids.
Null and empty texts hold the end id alone.  Equal keys keep one entry each.  An empty table gives an empty file set.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadstream.llm.texts import keyed_texts, split_rows
from roadstream.llm.vocabulary import File, WordTokens
from roadstream.shared import freeze, new_path

STEP = 256
BLOCK_IDS = 1 << 18
LIMIT = 16


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): each whole text's ids and the end id, as little-endian 32-bit numbers."""
    file = File(docs.sparkSession, tokenizer)
    rows = keyed_texts(docs, key, text)
    end = end_id.to_bytes(4, "little")

    def run(batches):
        vocabulary = file.open(WordTokens)
        for batch in batches:
            for part, texts in split_rows(batch):
                ids = pa.array([x + end for x in vocabulary.encode(texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def add_counts(total: np.ndarray, documents: list[bytes], step: int = 1 << 20) -> np.ndarray:
    """``total`` with how often each id stands in ``documents``.

    Counting takes as long as the vocabulary however short a text is, so texts are counted together, ``step`` ids at a time.
    """
    ids = np.frombuffer(b"".join(documents), dtype="<u4")
    for at in range(0, len(ids), step):
        found = np.bincount(ids[at:at + step])
        if len(found) > len(total):
            total = np.pad(total, (0, len(found) - len(total)))
        total[:len(found)] += found
    return total


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) over all rows, summed in each task first."""
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            total = add_counts(total, batch.column(0).to_pylist())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    merged, leaves = weights, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        by = np.argsort(both, kind="stable")
        merged = both[by]
        leaves.append(by < n)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for leaf in reversed(leaves):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    result = np.empty(n, dtype=np.int64)
    result[order] = lengths
    return result


class Code:
    """The canonical code of (ids, lengths): shorter codes first, equal lengths by id."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort([ids, bits])
        ids, bits = ids[order], bits[order]
        self.limit = max(1, int(bits.max(initial=1)))
        width = np.int64(1) << (self.limit - bits)
        first = np.cumsum(width) - width
        size = int(ids.max(initial=-1)) + 1
        self.codes, self.bits = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        self.codes[ids], self.bits[ids] = first >> (self.limit - bits), bits
        self.symbol, self.length = np.zeros(1 << self.limit, dtype=np.uint32), np.ones(1 << self.limit, dtype=np.int64)
        used = int(width.sum())
        self.symbol[:used], self.length[:used] = np.repeat(ids, width), np.repeat(bits, width)

    def encode(self, documents: list[np.ndarray]) -> tuple[list[bytes], list[np.ndarray]]:
        """Bits of each document, filled up to bytes, and the bit offsets of every ``STEP``-th id."""
        count = np.array([len(x) for x in documents])
        ids = np.concatenate([*documents, np.empty(0, np.uint32)])
        bits = self.bits[ids]
        after = np.cumsum(bits)
        ends = np.cumsum(count)
        total = np.diff(np.concatenate([[0], np.concatenate([[0], after])[ends]]))
        size = (total + 7) // 8
        begin = np.cumsum(size) - size
        shift = 8 * begin - (np.cumsum(total) - total)
        at = after - bits + np.repeat(shift, count)
        word, off = at >> 5, at & 31
        value = self.codes[ids] << (64 - off - bits).astype(np.uint64)
        out = np.zeros(int(size.sum()) // 4 + 3, dtype=np.uint64)
        if len(ids):
            edge = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[edge]] += np.add.reduceat(value >> np.uint64(32), edge)
            out[word[edge] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), edge)
        stream = out.astype(">u4").tobytes()
        marks = [at[e - n:e:STEP] - 8 * b for e, n, b in zip(ends, count, begin)]
        return [stream[b:b + s] for b, s in zip(begin, size)], marks

    def decode(self, payload: bytes, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids at ``offsets``, ``counts`` of them each, in the order of the offsets."""
        body = np.frombuffer(payload + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
        window = body[:-3] << 24 | body[1:-2] << 16 | body[2:-1] << 8 | body[3:]
        order = np.argsort(-counts, kind="stable")
        place = (np.cumsum(counts) - counts)[order]
        left, at = counts[order], offsets[order].astype(np.int64)
        ids = np.empty(int(counts.sum()), dtype="<u4")
        mask, down = np.uint32((1 << self.limit) - 1), 32 - self.limit
        live = len(at)
        for step in range(int(counts.max(initial=0))):
            live = int(np.searchsorted(-left[:live], -step, side="left"))
            at = at[:live]
            code = window[at >> 3] >> (down - (at & 7)).astype(np.uint32) & mask
            ids[place[:live] + step] = self.symbol[code]
            at = at + self.length[code]
        return ids


def write(tokens: DataFrame, path: str, limit: int = LIMIT, tasks: int | None = None) -> None:
    """Write (doc_id, ids) as a file set.  ``tokens`` is read twice and has to be stable."""
    spark = tokens.sparkSession
    counts = count_ids(tokens).toPandas()  # at most one row for each id of the vocabulary
    bits = code_lengths(counts["n"].to_numpy(np.int64), limit)
    book = pd.DataFrame({"id": counts["id"].astype("int64"), "bits": bits.astype("int32")})
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    sent = spark.sparkContext.broadcast((counts["id"].to_numpy(np.int64), bits))

    def encode(batches):
        code = Code(*sent.value)
        for batch in batches:
            documents = [np.frombuffer(x, dtype="<u4") for x in batch.column(1).to_pylist()]
            payload, marks = code.encode(documents)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in documents], pa.int64()), pa.array(payload, pa.binary()),
                 pa.array(marks, pa.list_(pa.int64()))], ["doc_id", "n", "payload", "marks"])

    id_type = tokens.schema["doc_id"].dataType.simpleString()
    coded = tokens.select("doc_id", "ids").mapInArrow(encode, f"doc_id {id_type}, n long, payload binary, marks array<long>")
    coded = coded.repartitionByRange(tasks, "doc_id") if tasks else coded.repartitionByRange("doc_id")
    coded = coded.sortWithinPartitions("doc_id", "n", "payload")
    blocks = "part int, block int, doc_ids array<{0}>, counts array<long>, marks array<long>, payload binary".format(id_type)
    schema = spark.createDataFrame([], blocks).schema

    def gather(batches):
        part, number = TaskContext.get().partitionId(), 0
        keys, counts, marks, payload, size, held = [], [], [], [], 0, 0

        def block():
            from pyspark.sql.pandas.types import to_arrow_schema

            row = {"part": [part], "block": [number], "doc_ids": [keys], "counts": [counts],
                   "marks": [np.concatenate(marks).tolist()], "payload": [b"".join(payload)]}
            return pa.RecordBatch.from_pydict(row, schema=to_arrow_schema(schema))

        for batch in batches:
            for key, n, body, mark in zip(*(x.to_pylist() for x in batch.columns)):
                if keys and held + n > BLOCK_IDS:
                    yield block()
                    number += 1
                    keys, counts, marks, payload, size, held = [], [], [], [], 0, 0
                keys.append(key)
                counts.append(n)
                marks.append(np.asarray(mark, dtype=np.int64) + 8 * size)
                payload.append(body)
                size += len(body)
                held += n
        if keys:
            yield block()

    coded.mapInArrow(gather, schema).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a file set; start counts the ids of all documents before."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()  # one row for each id of the vocabulary at most
    sent = spark.sparkContext.broadcast((book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64)))
    blocks = spark.read.parquet(f"{path}/blocks")
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)
    sizes = blocks.select("part", "block", size.alias("size"))
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))  # one row a file
    before = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    within = sizes.select("part", "block", (F.sum("size").over(
        Window.partitionBy("part").orderBy("block")) - F.col("size")).alias("within"))
    starts = within.join(before, "part").select("part", "block", (F.col("before") + F.col("within")).alias("start"))
    id_type = blocks.schema["doc_ids"].dataType.elementType

    def decode(batches):
        code = Code(*sent.value)
        for batch in batches:
            for row in range(batch.num_rows):
                keys, counts, marks, payload, start = (
                    batch.column(batch.schema.get_field_index(x))[row] for x in ("doc_ids", "counts", "marks", "payload", "start"))
                counts = np.asarray(counts.as_py(), dtype=np.int64)
                lanes = -(-counts // STEP)
                number = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
                lane = np.minimum(np.repeat(counts, lanes) - number * STEP, STEP)
                ids = code.decode(payload.as_py(), np.asarray(marks.as_py(), dtype=np.int64), lane).tobytes()
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(start.as_py() + ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([ids[4 * (e - n):4 * e] for e, n in zip(ends, counts)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    rows = blocks.join(starts, ["part", "block"]).select("doc_ids", "counts", "marks", "payload", "start")
    return rows.mapInArrow(decode, f"doc_id {id_type.simpleString()}, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, write and read back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write(freeze(token_ids(docs, tokenizer, end_id, key, text), "ids"), path)
    return read(spark, path)
