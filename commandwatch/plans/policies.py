"""Policies of the registered queries besides the catalog policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commandwatch.policy import Policy, Rule, ordered_on_a_line

# Every row is in context.
ANY_TEXT = (Rule(0, ""),)

LICENSE_RULES = (
    Rule(1, r"\blicensed\s+under\b", "licensed"),
    Rule(
        2,
        r"\breleased\b.*\blicense\b",
        "released",
        ordered_on_a_line(r"\breleased\b", r"\blicense\b"),
    ),
    Rule(3, r"\btoken\s*=", "token"),
)
LICENSE_POLICY = Policy(denied=("gnu", "apache", "token", "mit", "cc by-nc"))

# Frequent, rare, accented and two-word terms.
TERMS = (
    "license",
    "licensed",
    "apache",
    "token",
    "the",
    "ré",
    "ción",
    "der",
    "gnu general",
    "by-nc",
)

PAGE_RULES = (
    Rule(1, r"\bblog\.\w+\.example\.(com|net)\b", "blog."),
    Rule(2, r"^https://.*[?&]ref=", "ref="),
)
PAGE_POLICY = Policy(denied=("und", "page", "script"))

# (valid from, valid to, policy); the order of the names changes along the way.
HISTORY = (
    ("2024-01-01 00:00:00", "2024-01-10 00:00:00", Policy(denied=("system",))),
    ("2024-01-10 00:00:00", "2024-01-20 12:00:00", Policy(denied=("samples", "system"))),
    (
        "2024-01-20 12:00:00",
        None,
        Policy(denied=("gops_dev", "system", "sandbox_hackaton", "sandbox_others")),
    ),
)


def term_table(spark: SparkSession) -> DataFrame:
    return Policy(denied=TERMS).to_table(spark)


def history_table(spark: SparkSession) -> DataFrame:
    rows = [
        (start, end, pos, name)
        for start, end, policy in HISTORY
        for pos, name in enumerate(policy.denied, start=1)
    ]
    table = spark.createDataFrame(
        rows, "valid_from STRING, valid_to STRING, pos INT, name STRING"
    )
    return table.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in ("valid_from", "valid_to")}
    )


# Names that the events' own values hold, one of them of two words.
VALUE_POLICY = Policy(denied=("u42", "user u14", "u7", "u143", "u69", "user u7"), allowed="u8")


def customer_policy(customer: DataFrame) -> DataFrame:
    """pos, name, effect: a denied name for each customer, every third one of two words."""
    name = F.concat(F.lit("u"), F.col("c_custkey").cast("string"))
    spelled = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("user "), name)).otherwise(name)
    pos = F.col("c_nationkey") * 1_000_000 + F.col("c_custkey")
    return customer.select(pos.alias("pos"), spelled.alias("name"), F.lit("deny").alias("effect"))


def _minutes(amount: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), amount.cast("int"))


def customer_history(customer: DataFrame) -> DataFrame:
    """A policy history with a revision for each customer: pos, name, valid_from, valid_to."""
    key, start = F.col("c_custkey"), F.lit("2024-01-01").cast("timestamp_ntz")
    begin = start + _minutes(20 * key)
    end = begin + _minutes(480 * (1 + F.col("c_nationkey")))
    name = F.concat(F.lit("U"), (key % 200).cast("string"))
    return customer.select(
        key.alias("pos"),
        name.alias("name"),
        begin.alias("valid_from"),
        F.when(key % 29 != 0, end).alias("valid_to"),
    )


def faulty_history(customer: DataFrame) -> DataFrame:
    """A history of pairs of rows, with every kind of fault in it."""
    key, start = F.col("c_custkey"), F.lit("2024-01-01").cast("timestamp_ntz")
    pair, place = F.floor(key / 2), key % 100
    begin = start + _minutes(40 * F.floor(place / 2) + 16_500 * F.floor(key / 100))
    end = begin + _minutes(480 * (1 + F.col("c_nationkey")))
    alike = F.when(key % 26 == 1, 2 * pair).otherwise(key) % 40
    return customer.select(
        F.when(key % 34 == 1, 2 * pair).otherwise(key).alias("pos"),
        F.concat(F.when(key % 2 == 0, "U").otherwise("u"), alike.cast("string")).alias("name"),
        F.when(key % 46 != 0, begin).alias("valid_from"),
        F.when(key % 22 == 0, begin).otherwise(end).alias("valid_to"),
    )


def customer_inventory(customer: DataFrame) -> DataFrame:
    """name: a catalog for most customers."""
    kept = customer.filter("c_nationkey < 20")
    return kept.select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("name"))


def customer_effects(customer: DataFrame) -> DataFrame:
    """pos, name, effect: a policy that denies some catalogs, allows some, and misses others."""
    return customer.select(
        F.col("c_custkey").alias("pos"),
        F.concat(F.lit("u"), (F.col("c_custkey") + 40).cast("string")).alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, "deny").otherwise("allow").alias("effect"),
    )
