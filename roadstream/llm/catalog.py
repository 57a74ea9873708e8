"""The queries of this subpackage over the driver's tables, and their SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstream.llm import alignment, bpe, chunks, exact, mixing, neardup, packing, pii, quality, repair, token_files, topk, toxicity
from roadstream.shared import freeze

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RANKS = "byte_bpe_50k.tiktoken"
WORDS = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_byte_bpe(spark, folder):
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    # Written in between: encoding and decoding workers never share an executor's memory.
    encoded = freeze(bpe.encode(table(spark, folder, "documents"), path, pattern), "ids")
    rows = bpe.decode(encoded, path)
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op2_packing(spark, folder):
    items = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path(WORDS))
    return packing.pack(freeze(items, "pieces"))


@query("""
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e from embeddings),
s as (select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank, vec_id, score
  from s)
select * from r where rank <= 5""")
def op3_top_k(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op4_minhash(spark, folder):
    return neardup.classes(table(spark, folder, "documents"))


@query()
def op5_token_files(spark, folder):
    rows = token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path(WORDS))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("""
with d as (select doc_id, coalesce(text, '') whole, translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') t
  from documents),
g as (select doc_id, t, first_value(doc_id) over (partition by t order by length(whole) desc, doc_id) keep_id,
  count(*) over (partition by t) group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(t) text_sha256 from g""")
def op6_exact_dedup(spark, folder):
    _, rows = exact.groups(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query()
def op7_pii(spark, folder):
    rows = pii.spans(table(spark, folder, "documents"))
    return rows.select("doc_id", *(pii.count(F.col("base"), x).alias(f"n_{x}") for x in pii.KINDS[:4]),
                       F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@query()
def op8_quality(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = quality.scores(docs, quality.learn(docs, labels))
    return rows.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


@query()
def op9_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = quality.scores(docs, *toxicity.learn(docs, labels))
    return rows.select("doc_id", quality.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                       (F.col("score") >= toxicity.ALERT).cast("int").alias("predicted"))


@query()
def op10_substring_dedup(spark, folder):
    return chunks.shared_spans(table(spark, folder, "documents"), span=0)


@query(r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) size from documents),
n as (select source, cast(sum(size) as bigint) whole, row_number() over (order by source is null, source) number from d group by source),
w as (select *, (number - 1) % 3 + 1 weight from n),
o as (select *, sum(whole) over r - whole below, sum(weight) over r - weight lighter, sum(whole) over () total, sum(weight) over () weights
  from w window r as (order by cast(whole as double) / weight, number rows unbounded preceding)),
l as (select max(cast(total - 3 * below as double) / cast(weights - lighter as double)) level from o),
t as (select number, source, whole, least(cast(3 * whole as double), level * weight) target from w, l),
q as (select *, cast(floor(target + 0.5) as bigint) quota from t),
p as (select d.doc_id, d.size, q.whole, q.target, q.quota, cast(sum(d.size) over (partition by q.number
  order by md5(concat_ws(':', coalesce(cast(d.doc_id as varchar), 'null'), d.size, '0')), cast(d.doc_id as varchar) nulls first, d.size
  rows unbounded preceding) as bigint) upto from d join q on d.source is not distinct from q.source)
select doc_id, cast(size as bigint) size, whole source_size, target, case when whole = 0 then 0 else cast(quota // whole * size
  + greatest(0, least(upto, quota % whole) - (upto - size)) as bigint) end taken from p""")
def op11_source_mix(spark, folder):
    return mixing.taken(table(spark, folder, "documents"))


@query()
def op12_conversation_repair(spark, folder):
    rows = table(spark, folder, "conversations")
    return repair.repair(repair.damage(rows), rows)


@query()
def op13_tokenizer_alignment(spark, folder):
    return alignment.align(table(spark, folder, "documents"), *(public_tokenizers.path(x) for x in (BYTES, PIECES)))
