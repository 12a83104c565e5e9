"""Sources, sinks, streams and scratch folders."""

import json

import pytest
from pyspark.sql import functions as F

from commandwatch import CATALOG_POLICY, CATALOG_RULES, audit
from commandwatch.operators import (
    allowed_rest,
    classify,
    classify_by_table,
    denials,
    deny_by_table,
    extract_command,
    first_match,
    match_policy_table,
    verdict_counts,
)
from commandwatch.plans.event_log import COMMANDS, ENVELOPES
from commandwatch.sources import (
    many_small_files,
    read_log,
    read_text_log,
    scratch_dir,
    stream_log,
    stream_text_log,
    write_bucketed,
    write_files,
    write_table,
    write_verdict_lines,
)
from commandwatch.sources import sinks
from commandwatch.streaming import start_audit, start_table_audit


def payload(command):
    return json.dumps({"tool_input": {"command": command}})


def test_text_in_verdict_lines_out(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(map(payload, COMMANDS[:15])))
    (tmp_path / "in" / "b.txt").write_text("\n".join(map(payload, COMMANDS[15:])))
    denied = denials(audit(read_text_log(spark, str(tmp_path / "in"))))
    write_verdict_lines(denied, CATALOG_POLICY.allowed, str(tmp_path / "out"))
    lines = [row.value for row in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == 20
    record = json.loads(lines[0])
    assert record.keys() == {"continue", "stopReason", "systemMessage", "hookSpecificOutput"}
    assert record["continue"] is False
    assert record["stopReason"] == record["systemMessage"]
    assert record["hookSpecificOutput"] == {
        "hookEventName": "PreToolUse",
        "permissionDecision": "deny",
        "permissionDecisionReason": record["stopReason"],
    }
    assert all("'sandbox_others'" in json.loads(line)["stopReason"] for line in lines)


def test_kinds_of_commands_in_lists(spark):
    cases = {
        '[{"tool_input":{"command":"ls"}},{"tool_input":{"command":"a: [b, {c}, true"}}]': ["ls", "a: [b, {c}, true"],
        '{"tool_input":[{"command":"5"},{"command":"NaN"},{"command":"\\"q\\""},{"command":"true"}]}': ["5", "NaN", '"q"', "true"],
        '[{"tool_input":[{"command":["[x]",null]},{"command":"{}"}]},{"tool_input":{}}]': ["[x]", "{}"],
        **{f'[{{"tool_input":{{"command":{c}}}}},{{"tool_input":{{"command":"ls"}}}}]': None for c in ("5", "-1e3", "true", "false", "{}", "[1]", '{"a":"b"}')},
    }
    log = spark.createDataFrame([(p,) for p in cases], "payload string")
    found = {r.payload: (r.arguments, r.reason) for r in extract_command(log).collect()}
    assert found == {p: (a, None if a else "non_string_command") for p, a in cases.items()}


def test_one_payload_per_file(spark, tmp_path):
    text = json.dumps({"tool_input": {"command": "use catalog system"}}, indent=2)
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "empty.json").write_text("")
    log = read_text_log(spark, str(tmp_path), whole_files=True)
    assert [row.catalog for row in denials(audit(log)).collect()] == ["system"]


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_table_formats(spark, tmp_path, fmt):
    rows = [(i, payload(c)) for i, c in enumerate(COMMANDS)]
    log = spark.createDataFrame(rows, "id INT, payload STRING")
    write_table(log, str(tmp_path / fmt), fmt)
    again = audit(read_log(spark, str(tmp_path / fmt), fmt))
    assert denials(again).count() == 20


def test_verdict_table_partitions(spark, tmp_path):
    log = spark.createDataFrame([(c,) for c in COMMANDS], "command STRING")
    write_table(
        classify(log, CATALOG_RULES, CATALOG_POLICY), str(tmp_path / "t"), partition_by=["verdict"]
    )
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {
        "verdict=allow",
        "verdict=deny",
    }


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()

    def add(name, lines):
        (tmp_path / "in" / name).write_text("\n".join(lines))

    def run():
        stream = audit(stream_text_log(spark, source, max_files_per_trigger=1)).drop("file")
        query = start_audit(stream, sink, checkpoint)
        query.awaitTermination()
        assert all(not p["stateOperators"] for p in query.recentProgress)
        return len(query.recentProgress)

    add("a.txt", map(payload, COMMANDS[:10]))
    add("b.txt", map(payload, COMMANDS[10:]))
    assert run() >= 2
    add("c.txt", [line for line in ENVELOPES if line] * 2)
    run()
    run()

    batch = audit(read_text_log(spark, source)).drop("file")
    streamed = spark.read.parquet(sink)
    assert streamed.count() == 30 + 2 * (len(ENVELOPES) - 1)
    assert streamed.exceptAll(batch).isEmpty()
    assert batch.exceptAll(streamed).isEmpty()


def test_stream_of_tables(spark, tmp_path):
    log = spark.createDataFrame([(c,) for c in COMMANDS], "command STRING")
    write_table(log, str(tmp_path / "in"))
    stream = stream_log(spark, str(tmp_path / "in"), log.schema)
    decided = denials(classify(stream, CATALOG_RULES, CATALOG_POLICY))
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    query = start_audit(decided, sink, checkpoint, fmt="json", partition_by=["catalog"])
    query.awaitTermination()
    assert spark.read.json(sink).count() == 20


def test_stream_against_a_policy_table(spark, tmp_path):
    log = spark.createDataFrame(list(enumerate(COMMANDS)), "id INT, command STRING")
    write_table(log, str(tmp_path / "in"))
    stream = stream_log(spark, str(tmp_path / "in"), log.schema)
    table = CATALOG_POLICY.to_table(spark)
    args = (CATALOG_RULES, table, ["id"])
    matches = match_policy_table(stream, *args, strategy="broadcast")
    start_audit(matches, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    batch = match_policy_table(log, *args)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(batch.collect())


def test_start_audit_refuses_batch(spark, tmp_path):
    with pytest.raises(ValueError, match="streaming"):
        start_audit(spark.range(1), str(tmp_path / "o"), str(tmp_path / "c"))


class FakeConf:
    def __init__(self, **values):
        self.values = values

    def get(self, name, default):
        return self.values.get(name.replace(".", "_"), default)


class FakeSession:
    def __init__(self, **values):
        self.conf = FakeConf(**values)


def test_scratch_uses_the_shared_folder():
    session = FakeSession(spark_checkpoint_dir="hdfs://x/tmp/", spark_master="yarn")
    assert scratch_dir(session, "a").startswith("hdfs://x/tmp/a-")
    assert scratch_dir(session, "a") != scratch_dir(session, "a")


def test_scratch_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(FakeSession(spark_master="yarn"), "a")


def test_verdict_for_every_row_from_denials(spark):
    log = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, command STRING")
    matches = spark.createDataFrame(
        [(1, 2, "late"), (1, 1, "early")], "id INT, pos INT, catalog STRING"
    )
    rows = deny_by_table(log, first_match(matches, ["id"]), ["id"]).orderBy("id").collect()
    assert [(r.id, r.verdict, r.catalog) for r in rows] == [
        (1, "deny", "early"),
        (2, "allow", None),
    ]


def test_one_hot_command_in_a_third_of_the_rows(spark):
    n = 300_000
    log = spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, "databricks schemas list system")
        .otherwise(F.concat(F.lit("databricks x"), F.col("id").cast("string")))
        .alias("command"),
    )
    counts = verdict_counts(classify(log, CATALOG_RULES, CATALOG_POLICY)).collect()
    assert sorted(map(tuple, counts)) == [
        ("allow", "allow", n - n // 3),
        ("deny", "system", n // 3),
    ]
    for strategy in ("broadcast", "shuffle"):
        matches = match_policy_table(
            log, CATALOG_RULES, CATALOG_POLICY.to_table(spark), ["id"], strategy=strategy
        )
        assert first_match(matches, ["id"]).count() == n // 3


def test_whole_files_on_a_stream(spark, tmp_path):
    indented = json.dumps([{"tool_input": {"command": c}} for c in ("ls", "use catalog system")], indent=2)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(indented)
    (tmp_path / "in" / "b.json").write_text(indented.replace("system", "samples"))
    (tmp_path / "in" / "c.json").write_text(indented[:-1])
    log = stream_text_log(spark, str(tmp_path / "in"), max_files_per_trigger=1, whole_files=True)
    start_audit(audit(log).select("reason", "catalog", "arguments"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.reason, r.catalog or "", len(r.arguments or [])) for r in rows) == [("malformed", "", 0), ("match", "samples", 2), ("match", "system", 2)]


def test_whole_files_are_read_as_bytes_alike(spark, tmp_path):
    made = {"a.json": b'[\n "\xc3\xa9\\n"\r\n]\n', "b.json": b"", "c.json": b"\xff\x00x\n\n", "d.json": b"\xef\xbb\xbf{}", ".e": b"hidden"}
    (tmp_path / "in").mkdir()
    for name, content in made.items():
        (tmp_path / "in" / name).write_bytes(content)

    def read(compressed):
        log = stream_text_log(spark, str(tmp_path / "in"), whole_files=True, compressed=compressed)
        assert log.columns == ["payload", "file"]
        out = str(tmp_path / f"out-{compressed}")
        start_audit(log.select(F.col("payload").cast("binary").alias("p"), "file"), out, str(tmp_path / f"check-{compressed}")).awaitTermination()
        return sorted((r.file.rsplit("/", 1)[1], bytes(r.p)) for r in spark.read.parquet(out).collect())

    assert read(False) == read(True) == sorted((n, c) for n, c in made.items() if c and n != ".e")


@pytest.mark.parametrize("local", [True, False])
def test_each_text_in_a_file_and_no_more_files_in_a_folder(spark, tmp_path, monkeypatch, local):
    if not local:
        monkeypatch.setattr(sinks, "_on_local_disk", lambda *_: None)
    made = [f"{k}\né\r" for k in range(50)] + ["", "twice", "twice"]
    texts = spark.createDataFrame([(t,) for t in made], "payload string").repartition(4)
    folders = write_files(texts, f"file://{tmp_path}/in", 4, 20)
    assert len(folders) == 3 and (folders[0] == f"file://{tmp_path}/in") == local
    found = [list(tmp_path.glob(f"{f.removeprefix(f'file://{tmp_path}/').removeprefix(f'file:{tmp_path}/')}/part-*.txt")) for f in folders]
    assert all(0 < len(files) <= 20 for files in found)
    assert sorted(f.read_bytes().decode() for files in found for f in files) == sorted(f"{t}\n" for t in made)
    if local:  # no checksum beside each file
        assert not list(tmp_path.glob("in*/.*"))


def test_no_texts_and_no_files(spark, tmp_path):
    texts = spark.createDataFrame([], "payload string").repartition(4)
    assert write_files(texts, str(tmp_path / "in"), 4, 20) == [str(tmp_path / "in")]
    assert list((tmp_path / "in").iterdir()) == []


def test_settings_for_many_small_files_are_put_back(spark):
    names = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name, None) for name in names]
    with pytest.raises(KeyError), many_small_files(spark, 3):
        assert [spark.conf.get(name) for name in names] == ["3", "12", "16384"]
        raise KeyError
    assert [spark.conf.get(name, None) for name in names] == before


def test_a_policy_table_on_a_stream_and_a_batch_that_runs_again(spark, tmp_path):
    names = [*(f"c{k}" for k in range(150)), "main db"]
    table = spark.createDataFrame(list(enumerate(names)), "pos INT, name STRING")
    commands = [f"use catalog c{k % 200} c{k % 7}" for k in range(400)] + ["use catalog main db", None] * 20
    frame = spark.createDataFrame(list(enumerate(commands)), "id INT, command STRING")
    frame.repartition(6).write.parquet(str(tmp_path / "in"))
    log = stream_log(spark, str(tmp_path / "in"), frame.schema, max_files_per_trigger=2)
    out, check = str(tmp_path / "out"), tmp_path / "check"

    def run(strategy):
        start_table_audit(log, CATALOG_RULES, table, out, str(check), strategy=strategy).awaitTermination()
        return sorted(map(str, spark.read.parquet(out).select("id", "command", "verdict", "catalog").collect()))

    first = run("shuffle")
    batch = classify_by_table(spark.read.parquet(str(tmp_path / "in")), CATALOG_RULES, table)
    assert first == sorted(map(str, batch.select("id", "command", "verdict", "catalog").collect()))
    assert len(list((tmp_path / "out").glob("batch=*"))) > 1
    # As after a failure between writing a batch and noting its end.
    last = max((p for p in (check / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (check / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert run("broadcast") == first
    with pytest.raises(ValueError):
        start_table_audit(frame, CATALOG_RULES, table, out, str(check))


def test_tables_in_the_same_buckets_are_joined_as_they_lie(spark, tmp_path):
    log = spark.range(1_000).select((F.col("id") % 900).alias("id"), F.lit("x").alias("command"))
    left = write_bucketed(log, "bucketed_log", str(tmp_path / "log"), ["id"], 4)
    denied = log.filter("id % 3 = 0").select("id").distinct()
    right = write_bucketed(denied, "bucketed_denied", str(tmp_path / "denied"), ["id"], 4)
    rest = allowed_rest(left, right.hint("merge"), ["id"])
    text = rest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert rest.count() == log.filter("id % 3 <> 0").count()
