"""Reports on classified commands: denials, remainder, records, counts, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commandwatch.functions.verdict import denial_message, verdict_record
from commandwatch.operators.classify import ALLOW, DENY
from commandwatch.policy import Policy


def denials(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("verdict") == DENY)


def allowed(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("verdict") == ALLOW)


def allowed_rest(log: DataFrame, denied: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of the log without a denial in ``denied``, e.g. a table written earlier."""
    return log.join(denied.select(*key), list(key), "left_anti")


def verdict_records(denied: DataFrame, allowed_name: str) -> DataFrame:
    """Add the nested verdict as column ``record``."""
    message = denial_message(F.col("catalog"), allowed_name)
    return denied.withColumn("record", verdict_record(message))


def verdict_json(denied: DataFrame, allowed_name: str) -> DataFrame:
    """Add the verdict as one line of JSON in column ``value``."""
    return (
        verdict_records(denied, allowed_name)
        .withColumn("value", F.to_json("record"))
        .drop("record")
    )


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """Commands per verdict and denied catalog; allowed ones count under "allow"."""
    counted = verdicts.groupBy("verdict", "catalog").agg(F.count("*").alias("n"))
    return counted.select("verdict", F.coalesce("catalog", F.lit(ALLOW)).alias("catalog"), "n")


def verdict_rollup(verdicts: DataFrame, *by: str) -> DataFrame:
    """Counts by the given columns with subtotals; ``level`` is the grouping id.

    Counts each full combination first, so the rollup expands a few rows, not the log.
    """
    counted = verdicts.groupBy(*by).agg(F.count("*").alias("n"))
    return counted.rollup(*by).agg(
        F.sum("n").alias("n"), F.grouping_id().cast("int").alias("level")
    )


def policy_coverage(
    spark: SparkSession,
    inventory: Sequence[str] | DataFrame,
    policy: Policy | DataFrame,
    mentions: DataFrame,
) -> DataFrame:
    """Each catalog of the inventory or the policy, its status, and how often it is named.

    The inventory is a list or a table with a column ``name``, the policy one in the plan or a
    table with ``name`` and ``effect``. The status is the effect, "unlisted" for a catalog
    that the policy doesn't have, or "not in inventory". Names are compared and given in lower
    case, as commands are matched; a name with two effects has a row for each.

    ``mentions`` has one row per command and catalog it names.
    """
    if not isinstance(inventory, DataFrame):
        inventory = spark.createDataFrame([(name,) for name in inventory], "name STRING")
    table = policy if isinstance(policy, DataFrame) else policy.to_table(spark)
    lowered = F.lower("name").alias("catalog")
    known = inventory.filter("name IS NOT NULL").select(lowered).distinct()
    listed = table.filter("name IS NOT NULL").select(lowered, "effect").distinct()
    in_both = known.intersect(listed.select("catalog")).join(listed, "catalog")
    unlisted = known.exceptAll(listed.select("catalog").distinct()).withColumn(
        "effect", F.lit("unlisted")
    )
    unknown = (
        listed.select("catalog")
        .distinct()
        .exceptAll(known)
        .withColumn("effect", F.lit("not in inventory"))
    )
    status = in_both.unionByName(unlisted).unionByName(unknown)
    named = mentions.groupBy(F.lower("catalog").alias("catalog")).agg(
        F.count("*").alias("n_commands")
    )
    return status.join(named, "catalog", "left").select(
        "catalog",
        F.col("effect").alias("status"),
        F.coalesce("n_commands", F.lit(0)).alias("n_commands"),
    )
