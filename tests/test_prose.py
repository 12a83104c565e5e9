"""The written rule beside the deny list, and the rows on which they differ."""

import pytest

from pyspark.sql import functions as F

from commandwatch import CATALOG_POLICY, CATALOG_RULES, Policy
from commandwatch.operators import classify, policy_gaps, prose_verdict, with_targets
from commandwatch.operators.prose import PLATFORM_RULES
from commandwatch.plans.event_log import COMMANDS


@pytest.mark.parametrize(
    ("command", "targets"),
    [
        ("databricks schemas list system", ["system"]),
        ("databricks tables list Main bronze", ["main"]),
        ("databricks catalogs list", []),
        ("databricks catalogs get `My Cat`", ["my cat"]),
        ("curl https://h/api/2.1/unity-catalog/schemas?catalog_name=gops_dev&x=1", ["gops_dev"]),
        ("curl https://h/api/2.1/unity-catalog/catalogs/samples", ["samples"]),
        ("USE CATALOG `system`", ["system"]),
        ("create catalog if not exists a; drop catalog if exists b; alter catalog c", ["a", "b", "c"]),
        ("show schemas in samples", ["samples"]),
        ("show tables from samples.nyctaxi", ["samples"]),
        ("select * from system.access.audit join `x y`.`s.t`.u", ["system", "x y"]),
        ("select * from schema.table", []),
        ("insert into a.b.c select * from d.e.f, g.h.i", ["a", "d"]),
        ("databricks tables get main.s.t", ["main"]),
        ("databricks tables get s.t", []),
        ("use catalog a use catalog a", ["a"]),
        ("cat system samples", []),
        ("databricks fs ls dbfs:/system/x", []),
        ("reuse catalogue system", []),
        ("use catalog", []),
        ("", []),
        (None, []),
    ],
)
def test_targets(spark, command, targets):
    log = spark.createDataFrame([(1, command)], "id INT, command STRING")
    assert with_targets(log).first().targets == targets


def test_the_written_rule_and_the_gaps(spark):
    log = spark.createDataFrame(list(enumerate(COMMANDS)), "id INT, command STRING")
    platform = [rule for rule in CATALOG_RULES if rule.rule_id in PLATFORM_RULES]
    tagged = classify(log, platform, Policy(denied=()))
    tagged = tagged.withColumn("platform", F.col("reason") == "no_match").drop("verdict", "catalog", "reason")
    both = prose_verdict(classify(tagged, CATALOG_RULES, CATALOG_POLICY), CATALOG_POLICY.allowed)
    script = classify(log, CATALOG_RULES, CATALOG_POLICY)
    assert both.select("id", "verdict", "catalog").exceptAll(script.select("id", "verdict", "catalog")).isEmpty()
    gaps = {r.id: (r.gap, r.gap_catalog) for r in policy_gaps(both, CATALOG_POLICY).collect()}
    assert gaps == {
        0: ("D3", "samples"),  # a file's name behind another tool's
        10: ("D2", "system"),  # a plain select
        16: ("D4", "system"),  # English
        17: ("D3", "samples"),
        19: ("D3", "system"),
        22: ("D3", "system"),  # a path
        21: ("D1", "system_tables"),
        23: ("D1", "main"),  # on no list
        25: ("D3", "samples"),
        28: ("D4", "samples"),
    }
    allowed = prose_verdict(log, CATALOG_POLICY.allowed).filter("command LIKE '%list sandbox_others'")
    assert allowed.first().prose_verdict == "allow" and allowed.first().targets == ["sandbox_others"]
