"""Word matching: equal plans, random text, unusual names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from commandwatch import CATALOG_RULES, Policy, Rule
from commandwatch.functions import word_hit, words
from commandwatch.operators import (
    all_matches,
    classify,
    classify_as_of,
    classify_by_table,
    first_match,
    match_policy_table,
    tag_rules,
)
from commandwatch.operators import policy_table

ANY = [Rule(0, "")]
NAMES = ["sys", "a_b", "été", "prod-eu", "prod-us", "x.y", "k8", "eu", "b c", "数据"]


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = [*NAMES, *"-_. \n/éS2'\u0301\"", "prod", "ys"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate(random_texts(3000, 7)))
    return spark.createDataFrame(rows, "id INT, command STRING").cache()


def brute_force(text):
    # Python's \w lacks combining marks, which Spark's (?U) has.
    word = r"[\w\u0301]"
    return [
        name
        for name in NAMES
        if re.search(rf"(?<!{word}){re.escape(name)}(?!{word})", text.lower())
    ]


def test_random_text_against_brute_force(texts):
    expected = {
        (row.id, name) for row in texts.collect() for name in brute_force(row.command)
    }
    found = all_matches(texts, ANY, Policy(denied=tuple(NAMES))).collect()
    assert len(expected) > 1500
    assert {(row.id, row.catalog) for row in found} == expected
    assert len(found) == len(expected)


@pytest.mark.parametrize("strategy", [None, "broadcast", "shuffle"])
def test_join_finds_the_same_words(spark, texts, strategy):
    policy = Policy(denied=tuple(NAMES))
    inline = all_matches(texts, ANY, policy).select("id", "catalog")
    joined = match_policy_table(
        texts, ANY, policy.to_table(spark), ["id"], strategy=strategy
    ).select("id", "catalog")
    assert inline.exceptAll(joined).isEmpty()
    assert joined.exceptAll(inline).isEmpty()


def test_first_match_is_the_same_in_both_plans(spark, texts):
    policy = Policy(denied=tuple(NAMES))
    inline = classify(texts, ANY, policy).filter("verdict = 'deny'").select("id", "catalog")
    matches = match_policy_table(texts, ANY, policy.to_table(spark), ["id"])
    joined = first_match(matches, ["id"])
    assert inline.exceptAll(joined).isEmpty()
    assert joined.exceptAll(inline).isEmpty()


@pytest.mark.parametrize("limit", [0, 5, 7])
def test_a_policy_over_the_limit_is_not_broadcast(spark, texts, limit, monkeypatch):
    # 0: nothing fits; 5: only the names of several words do; 7: the same, not all.
    monkeypatch.setattr(policy_table, "MAX_BROADCAST_ROWS", limit)
    monkeypatch.setattr(policy_table, "MAX_INLINE_NAMES", 0)
    table = Policy(denied=tuple(NAMES)).to_table(spark)
    with pytest.raises(ValueError, match="too large"):
        match_policy_table(texts, ANY, table, ["id"], strategy="broadcast")
    joined = match_policy_table(texts, ANY, table, ["id"])
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    inline = all_matches(texts, ANY, Policy(denied=tuple(NAMES))).select("id", "catalog")
    assert sorted(joined.select("id", "catalog").collect()) == sorted(inline.collect())


@pytest.mark.parametrize("inline", [100, 3])
def test_every_row_from_a_table(spark, texts, inline, monkeypatch):
    monkeypatch.setattr(policy_table, "MAX_INLINE_NAMES", inline)
    policy = Policy(denied=tuple(NAMES))
    rows = classify_by_table(texts, ANY, policy.to_table(spark), ["id"])
    wanted = classify(texts, ANY, policy).select(*rows.columns)
    assert rows.exceptAll(wanted).isEmpty()
    assert wanted.exceptAll(rows).isEmpty()


@pytest.mark.parametrize("strategy", [None, "broadcast", "shuffle"])
def test_policy_in_force_at_the_time(spark, texts, strategy):
    log = texts.withColumn(
        "at", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 30)")
    )
    history = [
        ("2024-01-03 00:00:00", "2024-01-10 00:00:00", Policy(denied=("sys", "prod-eu", "eu"))),
        ("2024-01-10 00:00:00", "2024-01-20 00:00:00", Policy(denied=("eu", "x.y", "sys"))),
        ("2024-01-20 00:00:00", None, Policy(denied=("b c",))),
    ]
    rows = [
        (start, end, pos, name)
        for start, end, policy in history
        for pos, name in enumerate(policy.denied)
    ]
    table = spark.createDataFrame(rows, "f STRING, t STRING, pos INT, name STRING").select(
        F.col("f").cast("timestamp_ntz").alias("valid_from"),
        F.col("t").cast("timestamp_ntz").alias("valid_to"),
        "pos",
        "name",
    )
    matches = match_policy_table(log, ANY, table, ["id"], as_of="at", strategy=strategy)
    joined = first_match(matches, ["id"])
    inline = classify_as_of(log, ANY, history, at="at").filter("verdict = 'deny'")
    wanted = sorted(map(tuple, inline.select("id", "catalog").collect()))
    assert len(wanted) > 200
    assert sorted(map(tuple, joined.collect())) == wanted


@pytest.mark.parametrize("strategy", [None, "broadcast", "shuffle"])
def test_key_columns_named_like_the_policy(spark, strategy):
    log = spark.createDataFrame([("n", 1, "a x-y")], "name STRING, pos INT, command STRING")
    table = spark.createDataFrame([(7, "x-y"), (8, "a")], "pos INT, name STRING")
    matches = match_policy_table(log, ANY, table, ["name"], strategy=strategy)
    assert sorted(map(tuple, matches.collect())) == [("n", 7, "x-y"), ("n", 8, "a")]


def test_word_equals_token(texts):
    disagree = texts.select(F.lower("command").alias("t")).filter(
        word_hit(F.col("t"), "sys") != F.array_contains(words(F.col("t")), "sys")
    )
    assert disagree.isEmpty()


def test_capitals_in_a_policy_name(spark):
    log = spark.createDataFrame([(1, "use catalog PROD_X")], "id INT, command STRING")
    policy = Policy(denied=("Prod_X",))
    assert classify(log, CATALOG_RULES, policy).first().catalog == "Prod_X"
    joined = match_policy_table(log, CATALOG_RULES, policy.to_table(spark), ["id"])
    assert joined.first().catalog == "Prod_X"


def test_lines_and_blanks(spark):
    # "." stops at a line feed only, and any Unicode blank separates words.
    commands = [
        "drop x\r catalog",
        "drop x\u2028 catalog",
        "drop x\n catalog",
        "use\u00a0catalog",
        "use\u0085catalog",
        "usecatalog",
        "éselect catalog",
        "select catalogé",
    ]
    log = spark.createDataFrame(list(enumerate(commands)), "id INT, command STRING")
    fired = {row.id for row in tag_rules(log, CATALOG_RULES).collect()}
    assert fired == {0, 1, 3, 4}


def test_rejected_policies(spark):
    with pytest.raises(ValueError, match="distinct"):
        Policy(denied=("a", "A"))
    with pytest.raises(ValueError, match="word character"):
        Policy(denied=("--",))
    log = spark.createDataFrame([(1, "a")], "id INT, command STRING")
    table = spark.createDataFrame([(1, "--")], "pos INT, name STRING")
    with pytest.raises(ValueError, match="word character"):
        match_policy_table(log, ANY, table, ["id"])


@pytest.mark.parametrize("padding", [50, 200])
def test_long_lists_give_the_same_rows(spark, padding):
    names = ("system", "SYSTEM", *(f"name{i}" for i in range(padding)))
    rows = [(None, "a system"), (1, "ls"), (1, "b System name7"), (2, "name7"), (2, None)]
    log = spark.createDataFrame(rows, "id INT, command STRING")
    table = spark.createDataFrame(list(enumerate(names)), "pos INT, name STRING")
    found = classify_by_table(log, ANY, table, ["id"]).collect()
    assert sorted((r.id or 0, r.verdict, r.catalog or "") for r in found) == [
        (0, "deny", "system"),
        (1, "allow", ""),
        (1, "deny", "system"),
        (2, "allow", ""),
        (2, "deny", "name7"),
    ]
    policy = Policy.from_table(Policy(denied=names[1:]).to_table(spark))
    assert classify(log, ANY, policy).filter("verdict = 'deny'").count() == 3


def test_empty_rules_and_policy(spark, texts):
    assert classify(texts, [], Policy(denied=("sys",))).filter("verdict = 'deny'").isEmpty()
    assert classify(texts, ANY, Policy(denied=())).filter("verdict = 'deny'").isEmpty()
