import pytest
from pyspark.sql import types as T

from roadstream.shared import ship_package

FOLDER = "/root/testdata/sf0.001"
#: Extra columns whose names operators use themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns of clashing names, in several partitions."""
    ship_package(spark)

    def make(rows, parts=3):
        return spark.createDataFrame([(k, t, "en", "r", "d", 1, 2, 0.5, True) for k, t in rows], SCHEMA).repartition(parts)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    ship_package(spark)
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


PROSE = "the quick brown fox jumps over a lazy dog and then it runs far away into deep green woods near the old river bank"


def words(seed, n):
    """n made-up words, the same for the same seed."""
    import random

    pick = random.Random(seed)
    return ["".join(pick.choices("abcdefghijklmnoprstuvw", k=pick.randint(2, 9))) for _ in range(n)]


#: Null, empty, blank, repeated, and one long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, PROSE), (4, PROSE), (5, PROSE), (None, "no key"), (6, "x" * 3000),
       (7, " ".join(words(7, 9000))), (8, "naïve Ünïcödé 中文字 ½² <|endoftext|> don't"), (9, "́ é a\x1cb\x0bc")]
