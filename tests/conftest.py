import os
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


# Two cars: one keeps near its limits, one speeds, with a late passage and a repeated one.
SPEEDING_LOG = """1700000003000,m1,c1,BLUE-1,55.5,r1,a1
1700000007000,m2,c1,BLUE-1,40.0,r1,a1
1700000030000,m1,c2,RED-7,90.0,r2,a2
1700000034000,m2,c2,RED-7,95.0,r2,a2
1700000041000,m3,c2,RED-7,99.0,r2,a2
1700000037000,m4,c2,RED-7,99.0,r2,a2
1700000034000,m2,c2,RED-7,95.0,r2,a2
1700000055000,m9,c2,RED-7,80.0,r2,a2""".split("\n")

# The input of the one printed result that tests compare with.
AVERAGE_LOG = """1592722028000,0001,16278,皖M16450,116.3,30,83
1592722031000,0001,16278,皖M16450,116.3,30,83
1592722035000,0008,16278,皖M16450,116.3,30,83
1592722140000,0009,16278,皖M16450,116.3,30,83""".split("\n")

MONITORS = [("m0", "r1", 90, "a1"), ("m1", "r1", 50, "a1"), ("m2", "r2", 70, "a2"), ("m3", "r2", 120, None), ("m4", "r2", 0, "a2")]

LISTED = [("GREY-3", "stolen", None), ("GREY-4", "unpaid", None)]


@pytest.fixture(scope="session")
def make(spark):
    """Helpers that build the small input tables."""
    from roadstream import schemas
    from roadstream.sources import parse

    def lines(texts):
        return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, id bigint")

    def passages(rows):
        """rows: (id, time, car, monitor, speed, area)"""
        raw = spark.createDataFrame(
            rows, "id bigint, action_time bigint, car string, monitor_id string, speed double, area_id string")
        return raw.withColumns({"camera_id": F.lit("c"), "road_id": F.lit("r")})

    return SimpleNamespace(
        lines=lines, passages=passages, parsed=lambda texts: parse.parse_passages(lines(texts)),
        monitors=lambda: spark.createDataFrame(MONITORS, schemas.MONITOR),
        listed=lambda rows=LISTED: spark.createDataFrame(rows, schemas.VIOLATION_LIST))


def rows(df, *columns):
    """Sorted plain tuples of the named columns."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
