"""The subpackage's queries with SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from roadstream.llm import catalog
from roadstream.shared import freeze
from tests.llm.conftest import FOLDER, ODD, PROSE, words


def test_registered():
    numbers = sorted(int(x[2:].split("_")[0]) for x in contract.queries() if x.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = connection.sql(catalog.ORACLES[name])
    assert sorted(want.columns) == columns
    places = [want.columns.index(c) for c in columns]
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(tuple(r[p] for p in places) for r in want.fetchall())


def pipeline_input(spark, docs, rows, folder):
    labels = [(k, int(k % 4 > 0), 0) for k in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    table = docs(rows)
    table.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return table


def test_pipeline(spark, docs, tmp_path):
    rows = [(k, " ".join(words(k, 80)) if k % 4 else "BUY!! " * 60) for k in range(200)]
    rows += [(301, rows[1][1]), (302, rows[1][1].replace(" ", "\n")), (303, rows[2][1] + " and more"), (304, rows[3][1] + " a@b.cd"), *ODD]
    table = pipeline_input(spark, docs, rows, tmp_path)
    state, seen = table, {}
    for name, stage in corpus_pipeline.STAGES:
        before, state = state, freeze(stage(spark, state, str(tmp_path)), name)
        if name != "packing":
            assert state.schema == table.schema
        seen[name] = [r.doc_id for r in state.collect()]
        assert set(seen[name]) <= {r.doc_id for r in before.collect()}
    assert not {k for k in range(200) if k % 4 == 0 and k > 9} & set(seen["quality"])
    assert {k for k in range(200) if k % 4 and k > 9} <= set(seen["quality"])
    assert (1 in seen["exact_dedup"]) + (301 in seen["exact_dedup"]) + (302 in seen["exact_dedup"]) == 1
    assert 2 in seen["near_dedup"] and 303 not in seen["near_dedup"] and seen["near_dedup"].count(4) <= 1
    assert sorted(map(repr, seen["pii"])) == sorted(map(repr, seen["near_dedup"]))
    assert set(map(repr, seen["packing"])) == set(map(repr, seen["pii"]))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])
    assert PROSE


def test_pipeline_empty_table(spark, docs, tmp_path):
    pipeline_input(spark, docs, [], tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
