"""Registered queries over a given table, and against SQL where there is any."""

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from commandwatch.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, len(QUERIES) + 1)}
    assert QUERIES.keys() | {"pipeline"} <= driver.queries().keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    theirs = con.sql(ORACLES[name])
    ours = QUERIES[name](spark, small).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - {"op1_secrets", "op9_packed", "op12_filter_audit"}))
def test_a_row_for_each_document(spark, small, name):
    ids = spark.read.parquet(f"{small}/documents.parquet").select("doc_id")
    found = QUERIES[name](spark, small).select("doc_id")
    assert sorted(found.collect()) == sorted(ids.collect())
