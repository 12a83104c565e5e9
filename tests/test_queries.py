"""Registered queries against their SQL, and how they are planned."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from commandwatch import CATALOG_POLICY, CATALOG_RULES, audit
from commandwatch.operators import classify, denials
from commandwatch.plans.event_log import payload_log
from commandwatch.plans import queries
from commandwatch.plans.queries import QUERIES

TABLES = ("events", "documents", "conversations", "pages", "customer")


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, small, sql, name):
    ours = driver.queries()[name](spark, small)
    theirs = sql.sql(driver.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    rows = by_name(ours.collect(), ours.columns)
    assert rows
    assert rows == by_name(theirs.fetchall(), theirs.columns)


def test_every_query_has_sql():
    assert QUERIES.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    counts = dict(map(tuple, driver.entry(spark).groupBy("catalog").count().collect()))
    assert counts == {"system": 267, "samples": 233, "gops_dev": 100, "sandbox_hackaton": 67}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_audit_is_narrow_and_parses_once(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    denied = denials(audit(payload_log(events))).select("event_id", "catalog")
    assert "Exchange" not in plan(denied)
    assert plan(denied).count("from_json(StructField(body,ArrayType(StructType") == 1
    assert "Python" not in plan(denied)


def test_keys_are_lowered_once(spark):
    log = spark.createDataFrame([("{}",)], "payload string")
    assert plan(audit(log).select("verdict")).count("regexp_replace(") == 2  # for two keys


def test_a_denial_filter_does_not_match_twice(spark, small):
    log = spark.read.parquet(f"{small}/documents.parquet")
    denied = denials(classify(log, CATALOG_RULES, CATALOG_POLICY, command="text"))
    text = plan(denied.select("doc_id", "catalog"))
    assert text.count(r"(?<=\bsystem)\b") == 1
    assert text.count(r"\bdatabricks\b") == 1


def test_filters_and_columns_reach_the_scan(spark, small):
    log = spark.read.parquet(f"{small}/documents.parquet")
    verdicts = classify(log, CATALOG_RULES, CATALOG_POLICY, command="text")
    some = verdicts.filter(F.col("lang") == "en").select("doc_id", "catalog")
    assert "EqualTo(lang,en)" in plan(some)
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan(some)


# The others return a table that they have written.
LAZY = [q for q in QUERIES if not q.startswith(("stream_", "written_", "text_log", "whole_file"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, small, name):
    text = plan(driver.queries()[name](spark, small))
    assert "NestedLoop" not in text
    assert "CartesianProduct" not in text


def test_the_remainder_of_written_tables_shuffles_no_log(spark, small):
    text = plan(driver.queries()["allowed_commands_anti"](spark, small))
    assert "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("name", ["document_terms_shuffle", "denied_commands_shuffle", "command_verdict_long_shuffle"])
def test_texts_are_scanned_once_before_they_are_matched(spark, small, name):
    text = plan(driver.queries()[name](spark, small))
    scans = [line for line in text.splitlines() if "FileScan" in line and ("events" in line or "documents" in line)]
    assert len(scans) == (2 if name == "command_verdict_long_shuffle" else 1)  # the verdicts are joined to the log


def test_all_tasks_write_payload_files_and_as_many_verdict_files(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda _, name: f"{tmp_path}/{name}")
    rows = driver.queries()["whole_file_reasons"](spark, small).collect()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = list((tmp_path / "payload-files" / "in").glob("part-*.txt"))
    assert len({f.name.split("-")[1] for f in files}) == tasks  # was one for so few bytes
    assert len(files) == sum(row["n"] for row in rows) > tasks
    assert all(f.read_text().strip().startswith("[") and f.read_text().count('"command"') <= 16 for f in files)
    assert len(list((tmp_path / "payload-files" / "out").glob("part-*.parquet"))) <= tasks


def test_payload_files_in_folders_that_are_streamed_one_by_one(spark, tmp_path, monkeypatch):
    rows = [(k // 2 * 2, f"2024-01-{1 + k % 28:02d}", k % 150, ("view", "click", "error")[k % 3], '{"k": %d}' % (k % 90)) for k in range(3_000)]
    rows += [(None, None, None, None, None)]
    table = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, props string")
    events = table.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", F.lit(0.5).alias("value"), "props")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "scratch_dir", lambda _, name: f"{tmp_path}/{name}")
    whole = sorted(map(str, driver.queries()["whole_file_reasons"](spark, str(tmp_path)).collect()))
    monkeypatch.setattr(queries, "scratch_dir", lambda _, name: f"{tmp_path}/again-{name}")
    monkeypatch.setattr(queries, "FILES_AT_ONCE", 40)
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert sorted(map(str, driver.queries()["whole_file_reasons"](spark, str(tmp_path)).collect())) == whole
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    folders = list((tmp_path / "again-payload-files").glob("in*"))
    assert len(folders) > 4 and all(len(list(f.iterdir())) <= 40 for f in folders)
    assert sum(len(list(f.iterdir())) for f in folders) == 189  # 188 of 16 commands or fewer, one without a key
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert sum(n for *_, n in con.sql(driver.oracle_sql()["whole_file_reasons"]).fetchall()) == 189


def test_no_events_make_no_files(spark, small, tmp_path):
    spark.read.parquet(f"{small}/events.parquet").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    assert driver.queries()["whole_file_reasons"](spark, str(tmp_path)).collect() == []
