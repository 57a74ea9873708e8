"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a DataFrame that is
written and read again as the next one's docs.  All but the last return the columns of ``documents``.

Null texts count as empty.  The quality stage gives an empty text a score like any other, the copies' stages keep one of
equal empty texts, and packing makes it an end id alone.  An empty table passes through as an empty table.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadstream.llm import exact, neardup, packing, pii, quality
from roadstream.shared import freeze, new_path, ship_package

#: No SQL says what a learned classifier or a sampled similarity decides; the stages are tested one by one.
ORACLE_SQL = None
TOKENIZER = "word_bpe_49k.json"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship_package(spark)
    return quality.accept(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship_package(spark)
    return neardup.keep_one(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with marks in place of personal data."""
    ship_package(spark)
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    ship_package(spark)
    return packing.pack(freeze(packing.pieces(docs, public_tokenizers.path(TOKENIZER)), "pieces"))


STAGES = [("quality", quality_filter), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", sanitise), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
