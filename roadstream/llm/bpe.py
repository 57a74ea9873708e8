"""Byte-level BPE over chunks that overlap, and its decoding.

Texts up to ``chunk`` code points are encoded where they lie.  A longer text is cut into chunks that overlap; each
chunk finds its pre-tokens alone.  Where a chunk and the next one start a pre-token at the same place of their
overlap, after a character that is no white space, both have resynchronised: the text is cut there.  The pieces
between cuts are encoded in parallel.  Chunks without a common place stay in one piece, so no result depends on the
chunk size.  Null and empty texts have no ids; every row of ``docs`` gives one row, equal rows included.
"""

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from roadstream.llm.texts import keyed_texts, split_rows
from roadstream.llm.vocabulary import File, TokenBytes, ranks_under
from roadstream.shared import freeze

#: A match that ends this close to a chunk's end may be another one in the whole text.
MARGIN = 8


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = 1 << 15, overlap: int = 512) -> DataFrame:
    """(doc_id, ids): ids of each whole text as little-endian 32-bit numbers."""
    file = File(docs.sparkSession, ranks)
    kind = ranks_under(pattern)
    rows = keyed_texts(docs, key, text)
    long = F.length("text") > chunk
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def whole(batches):
        vocabulary = file.open(kind)
        for batch in batches:
            for part, texts in split_rows(batch):
                ids = pa.array([vocabulary.encode(x) for x in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    near = rows.filter(~long).mapInArrow(whole, f"doc_id {id_type}, ids binary")
    far = rows.filter(long).select("doc_id", F.sha2("text", 256).alias("digest"), "text")
    encoded = _encode_long(far, file, kind, pattern, chunk, overlap)
    return near.unionByName(far.select("doc_id", "digest").join(encoded, "digest").select("doc_id", "ids"))


def _encode_long(texts: DataFrame, file: File, kind, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(digest, ids) of each different text."""
    reach = chunk + overlap

    def cut(batches):
        for batch in batches:
            for digest, text in zip(*(x.to_pylist() for x in batch.columns)):
                starts = list(range(0, max(1, len(text) - overlap), chunk))
                yield pa.RecordBatch.from_pydict(
                    {"digest": [digest] * len(starts), "k": list(range(len(starts))), "last": [len(starts) - 1] * len(starts),
                     "part": [text[s:s + reach] if s != starts[-1] else text[s:] for s in starts]},
                    schema=pa.schema([("digest", pa.string()), ("k", pa.int64()), ("last", pa.int64()), ("part", pa.string())]))

    def boundaries(batches):
        find = regex.compile(pattern).finditer
        for batch in batches:
            heads, tails = [], []
            k, last, part = (batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("k", "last", "part"))
            for number, end, body in zip(k, last, part):
                begin = number * chunk
                places = [x.start() for x in find(body) if x.start() and not body[x.start() - 1].isspace()]
                heads.append([begin + x for x in places if x < overlap])
                tails.append([begin + x for x in places if chunk <= x < len(body) - MARGIN] if number < end else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.list_(pa.int64())),
                                              pa.array(tails, pa.list_(pa.int64()))], [*batch.schema.names, "heads", "tails"])

    def merge(batches):
        vocabulary = file.open(kind)
        for batch in batches:
            for part, pieces in split_rows(batch, "piece"):
                ids = pa.array([vocabulary.encode(x).hex() for x in pieces], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids], ["digest", "first", "ids"])

    chunks = texts.select("digest", "text").mapInArrow(cut, "digest string, k long, last long, part string")
    # Equal texts give equal chunks; one of each stays, and a long text spreads over tasks.
    chunks = chunks.groupBy("digest", "k").agg(F.first("last").alias("last"), F.first("part").alias("part"))
    chunks = freeze(chunks.mapInArrow(
        boundaries, "digest string, k long, last long, part string, heads array<long>, tails array<long>"), "chunks")
    order = Window.partitionBy("digest").orderBy("k")
    cuts = chunks.select("digest", "k", "last", "heads", "tails")
    cuts = cuts.withColumn("cut", F.array_min(F.array_intersect("tails", F.lead("heads").over(order))))
    # After a place without a cut, a chunk may be out of step with the text: its later cuts are given up.
    cuts = cuts.withColumn("cut", F.when(
        F.count(F.when(F.col("cut").isNull(), 1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0,
        F.col("cut")))
    before = F.lag("cut").over(order)
    cuts = cuts.select(
        "digest", "k", F.coalesce(before, F.col("k") * chunk).alias("start"),
        F.when(F.col("k") < F.col("last"), F.coalesce("cut", (F.col("k") + 1) * chunk)).alias("end"),
        F.max(F.when(F.col("k").eqNullSafe(0) | before.isNotNull(), F.col("k"))).over(order).alias("first"))
    begin = F.col("start") - F.col("k") * chunk
    pieces = chunks.select("digest", "k", "part").join(cuts, ["digest", "k"]).select(
        "digest", "first", "k", F.substr("part", (begin + 1).cast("int"),
                                         F.coalesce(F.col("end") - F.col("start"), F.length("part")).cast("int")).alias("part"))
    pieces = pieces.groupBy("digest", "first").agg(F.sort_array(F.collect_list(F.struct("k", "part"))).alias("parts"))
    pieces = pieces.select("digest", "first", F.array_join(F.col("parts.part"), "").alias("piece"))
    ids = pieces.mapInArrow(merge, "digest string, first long, ids string")
    ids = ids.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("parts"))
    return ids.select("digest", F.unhex(F.array_join(F.col("parts.ids"), "")).alias("ids"))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for, in order.  Null ids decode to no bytes."""
    file = File(encoded.sparkSession, ranks)
    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))

    def read(batches):
        tokens = file.open(TokenBytes)
        for batch in batches:
            for part, ids in split_rows(batch, "ids"):
                found = pa.array([tokens.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, found], ["doc_id", "ids", "decoded"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {id_type}, ids binary, decoded binary")
