"""Policy tables of any size and with long histories, against plain loops."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from commandwatch import Policy, Rule
from commandwatch.operators import (
    classify,
    classify_as_of_table,
    classify_by_table,
    history_faults,
    match_policy_table,
    policy_coverage,
    policy_table,
)
from commandwatch.operators.periods import bins_of, in_bins, merged_periods

ANY = [Rule(0, "")]
START = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_names(rng, n):
    words, gaps = ["a", "b", "sys", "É", "x_1", "東", "á"], [" ", "-", ".", "  ", "\n", "-_", "@ "]
    names = set()
    while len(names) < n:
        name = rng.choice(["", "", rng.choice(gaps)]) + rng.choice(words)
        for _ in range(rng.choice([0, 0, 1, 2])):
            name += rng.choice(gaps) + rng.choice(words)
        names.add((name + rng.choice(["", "", rng.choice(gaps)])).lower())
    return sorted(names)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(21)
    names = random_names(rng, 150)
    pieces = ["a", "B", "sys", "é", "X_1", "東", "á", " ", "-", ".", "  ", "\n", "@ ", "-_", "\0"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(600)]
    keys = [rng.choice([None, *range(200)]) for _ in texts]
    log = spark.createDataFrame(list(zip(keys, texts, strict=True)), "id INT, command STRING")
    log = log.unionByName(spark.createDataFrame([(7, "sys a-b")] * 50 + [(None, None)], log.schema))
    table = spark.createDataFrame(list(enumerate(names)), "pos INT, name STRING")
    return log.repartition(4), table, names


def test_the_rows_don_t_follow_the_plan_where_keys_repeat_or_are_null(case, monkeypatch):
    log, table, names = case
    found = {}
    for strategy in ("inline", "broadcast", "shuffle"):
        monkeypatch.setattr(policy_table, "MAX_INLINE_NAMES", 10_000 if strategy == "inline" else 0)
        hits = match_policy_table(log, ANY, table, ["id"], strategy=None if strategy == "inline" else strategy)
        found[strategy] = Counter(map(tuple, hits.collect()))
    assert found["inline"] == found["broadcast"] == found["shuffle"]
    assert sum(found["inline"].values()) > 900


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_every_row_has_the_verdict_of_the_inline_plan(case, strategy):
    log, table, names = case
    rows = classify_by_table(log, ANY, table, strategy=strategy)
    wanted = classify(log, ANY, Policy(denied=tuple(names))).select(*rows.columns)
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, wanted.collect()))


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_lists_of_strings_against_a_table(spark, strategy):
    rng = random.Random(4)
    parts = ["databricks", "a b", "b", "a", "sys-x", "x", "use catalog"]
    rows = [(k, None if k % 3 else rng.choice(parts), [rng.choice(parts) for _ in range(3)] if k % 3 else None) for k in range(300)]
    log = spark.createDataFrame(rows, "id INT, command STRING, arguments ARRAY<STRING>")
    names = ("b a", "a b", "sys-x", "b", "x a")
    table = Policy(denied=names).to_table(spark)
    found = classify_by_table(log, ANY, table, strategy=strategy, arguments="arguments")
    wanted = classify(log, ANY, Policy(denied=names), arguments="arguments").drop("reason")
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.select(*found.columns).collect()))
    assert found.filter("catalog = 'b a'").isEmpty()  # nothing reaches from one string into the next


def test_frequent_n_grams_are_spread_and_only_their_names_repeated(spark, monkeypatch):
    rows = [(k, f"hot word{k % 500} hot pair" if k % 3 else "other") for k in range(6_000)]
    log = spark.createDataFrame(rows, "id INT, command STRING")
    names = ["hot", "hot pair", *(f"word{k}" for k in range(0, 500, 5))]
    table = spark.createDataFrame(list(enumerate(names)), "pos INT, name STRING")
    grams = policy_table._grams(log.withColumn("_text", F.col("command")), policy_table._extent(policy_table._denied_names(table, None)))
    salts = policy_table._salts(grams)
    hashed = {r.h for r in spark.createDataFrame([("hot",), ("hot pair",)], "g STRING").select(F.xxhash64("g").alias("h")).collect()}
    assert hashed <= salts.keys() and len(salts) < 10
    found = match_policy_table(log, ANY, table, ["id"], strategy="shuffle")
    inline = classify(log, ANY, Policy(denied=("hot pair",)))
    assert found.filter("catalog = 'hot pair'").count() == inline.filter("verdict = 'deny'").count() == 4_000
    assert found.count() == 4_000 * 2 + sum(k % 3 > 0 and k % 500 % 5 == 0 for k in range(6_000))


def test_texts_are_read_once_and_don_t_travel(spark, small):
    log = spark.read.parquet(f"{small}/documents.parquet")
    table = spark.createDataFrame([(1, "gnu general"), (2, "the"), (3, "by-nc")], "pos INT, name STRING")
    text = plan(match_policy_table(log, ANY, table, ["doc_id"], command="text", strategy="shuffle"))
    assert text.count("FileScan") == 1
    assert "SortMergeJoin" in text and "NestedLoop" not in text
    carried = re.findall(r", \[([^\]]*)\], true, \[_gram#", text)  # what stays beside each n-gram
    assert len(carried) == 1 and "text" not in carried[0] and "doc_id" in carried[0]


def test_one_command_in_a_third_of_the_log_makes_no_pairs(spark, tmp_path):
    hot = "databricks tables list hot pair"
    log = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("use catalog c"), "id")).alias("command")
    )
    names = ["hot pair", *(f"c{k}" for k in range(0, 30_000, 100))]
    table = spark.createDataFrame(list(enumerate(names)), "pos INT, name STRING")
    decided = classify_by_table(log, ANY, table, strategy="shuffle")
    assert decided.filter("catalog = 'hot pair'").count() == 10_000
    assert decided.filter("verdict = 'deny'").count() == 10_000 + 200
    # Distinct commands meet the policy: one row of the hot one.
    matched = match_policy_table(
        policy_table._with_digest(log, "command", None), ANY, table, ["_digest"], strategy="shuffle", collapse=True
    )
    assert matched.count() == 1 + 200


# Histories ---------------------------------------------------------------------------------


def history(spark, rows):
    frame = spark.createDataFrame(rows, "pos INT, name STRING, f STRING, t STRING")
    return frame.select("pos", "name", F.col("f").cast("timestamp_ntz").alias("valid_from"), F.col("t").cast("timestamp_ntz").alias("valid_to"))


def revisions(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        begin = START + timedelta(minutes=20 * k)
        end = START + timedelta(minutes=20 * (k + 1))
        for pos, name in enumerate(rng.sample(["a", "b", "c d", "E"], rng.randint(0, 3))):
            rows.append((pos, name, str(begin), None if k == n - 1 else str(end)))
    return rows + [(9, "zz", str(START), str(START)), (8, "long", str(START + timedelta(days=2)), str(START + timedelta(days=9)))]


@pytest.mark.parametrize("strategy", [None, "shuffle"])
def test_a_thousand_revisions(spark, strategy):
    rows = revisions(1_000, 3)
    rng = random.Random(5)
    times = [START + timedelta(seconds=rng.randint(-5_000, 1_400_000)) for _ in range(800)] + [None, START]
    texts = ["x a", "b a", "c d b", "e long", "zz", "long"]
    log = [(k % 50, rng.choice(texts), t) for k, t in enumerate(times)]
    frame = spark.createDataFrame(log, "id INT, command STRING, at TIMESTAMP_NTZ")
    decided = classify_as_of_table(frame, ANY, history(spark, rows), "at", strategy=strategy)
    expected = Counter()
    for key, text, at in log:
        held = []
        for pos, name, begin, end in rows:
            if at and str(begin) <= str(at) and (end is None or str(at) < end) and re.search(rf"\b{name.lower()}\b", text):
                held.append((pos, name))
        expected[key, text, at, min(held)[1] if held else None] += 1
    assert Counter((r.id, r.command, r["at"], r.catalog) for r in decided.collect()) == expected
    few = classify_as_of_table(frame, ANY, history(spark, rows[:40]), "at", strategy="broadcast")
    many = classify_as_of_table(frame, ANY, history(spark, rows), "at", strategy="broadcast")
    assert len(plan(many)) < 1.1 * len(plan(few))


def test_periods_that_touch_become_one_and_lie_in_few_bins(spark):
    rows = revisions(400, 8)
    periods = history(spark, rows).select("pos", "name", F.col("valid_from").alias("_valid_from"), F.col("valid_to").alias("_valid_to"))
    merged = merged_periods(periods, "pos", "name")
    covered = {}
    for pos, name, begin, end in sorted(rows, key=lambda r: r[2]):
        if end is not None and end <= begin:
            continue
        spans = covered.setdefault((pos, name), [])
        if spans and spans[-1][1] == begin:
            spans[-1][1] = end
        else:
            spans.append([begin, end])
    got = {}
    for r in merged.orderBy("_valid_from").collect():
        got.setdefault((r.pos, r.name), []).append([str(r._valid_from), None if r._valid_to is None else str(r._valid_to)])
    assert got == covered
    assert in_bins(merged, bins_of(merged)).count() <= 3 * merged.count()


def test_faults_of_a_history(spark):
    day = lambda d: f"2024-01-{d:02} 00:00:00"
    rows = [
        (1, "a", day(1), day(5)),
        (2, "A", day(1), day(3)),  # repeated
        (3, "b", day(1), day(1)),  # empty
        (4, "b", day(2), day(1)),  # empty
        (5, "c", None, day(2)),  # no start
        (6, "a", day(4), day(6)),  # overlaps
        (6, "d", day(4), day(6)),  # the same position
        (7, "d", day(6), day(7)),  # touches: no fault
        (8, "e", day(9), None),  # a gap from the 7th on
        (8, "e", day(20), day(21)),  # overlaps an open period
        (9, "f", day(25), day(26)),
    ]
    got = {(r.fault, r.name, r["at"] and str(r["at"])) for r in history_faults(history(spark, rows)).collect()}
    assert got == {
        ("repeated_name", "a", day(1)),
        ("empty_period", "b", day(1)),
        ("empty_period", "b", day(2)),
        ("no_start", "c", None),
        ("overlap", "a", day(4)),
        ("repeated_position", "a", day(4)),
        ("gap", None, day(7)),
        ("overlap", "e", day(20)),
    }
    assert history_faults(history(spark, [])).isEmpty()
    sound = [(k, f"n{k}", day(1 + k), day(2 + k)) for k in range(9)]
    assert history_faults(history(spark, sound)).isEmpty()


def test_coverage_of_tables(spark):
    inventory = spark.createDataFrame([("A",), ("b",), ("b",), (None,), ("new",)], "name STRING")
    policy = spark.createDataFrame([(1, "a", "deny"), (2, "B", "allow"), (3, "old", "deny"), (4, None, "deny")], "pos INT, name STRING, effect STRING")
    named = spark.createDataFrame([("a",), ("A",), ("old",)], "catalog STRING")
    got = {tuple(r) for r in policy_coverage(spark, inventory, policy, named).collect()}
    assert got == {("a", "deny", 2), ("b", "allow", 0), ("new", "unlisted", 0), ("old", "not in inventory", 1)}


def test_a_shuffle_carries_only_n_grams_with_the_hash_of_a_name(spark, monkeypatch):
    texts = ["use system samples x", "gnu  general, gnu general é", None, "", "by-nc BY-NC byte", *[f"w{k} v{k}" for k in range(50)]]
    rows = [(k % 40 if k % 7 else None, text) for k, text in enumerate(texts * 3)]
    log = spark.createDataFrame(rows, "id BIGINT, command STRING")
    names = ["system", "gnu general", "by-nc", "é", "v7", "w9 v9", None]
    table = spark.createDataFrame([(k, name, "deny") for k, name in enumerate(names)], "pos INT, name STRING, effect STRING")

    def matched(strategy):
        return match_policy_table(log, [Rule(0, "")], table, ["id"], strategy=strategy)

    expected = sorted(map(str, matched("broadcast").collect()))
    found = matched("shuffle")
    assert sorted(map(str, found.collect())) == expected and len(expected) > 15
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and plan.index("Join Inner") < plan.index("Join LeftSemi")
    monkeypatch.setattr(policy_table, "MAX_HASHED_ROWS", 0)
    assert sorted(map(str, matched("shuffle").collect())) == expected
