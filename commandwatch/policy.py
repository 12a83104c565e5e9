"""Context rules and catalog policies as data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

POLICY_SCHEMA = "pos INT, name STRING, effect STRING"
RULE_SCHEMA = "rule_id INT, pattern STRING, needs STRING, linear STRING"

# Every name is a test per row; past this, classify_by_table takes a join, with equal rows.
MAX_INLINE_NAMES = 100


@dataclass(frozen=True)
class Rule:
    """A regex over lowercased text that marks a command as a catalog operation.

    ``needs`` is an optional literal contained in every match of ``pattern``. ``linear`` is
    an optional equivalent of ``pattern`` for Spark, where ``pattern`` itself takes time
    quadratic in the length of a line.
    """

    rule_id: int
    pattern: str
    needs: str | None = None
    linear: str | None = None

    @property
    def search(self) -> str:
        return self.linear or self.pattern


def ordered_on_a_line(first: str, then: str) -> str:
    """Equivalent of ``first.*then`` that tries only the first ``first`` of each line.

    If any occurrence has ``then`` behind it, so has the first one. Without the anchor every
    occurrence scans the rest of the line again.
    """
    return rf"(?m)^(?>.*?{first}).*{then}"


@dataclass(frozen=True)
class Policy:
    """Denied names in order of precedence, and the name the message points to."""

    denied: tuple[str, ...]
    allowed: str = ""

    def __post_init__(self) -> None:
        lowered = [name.lower() for name in self.denied]
        if len(set(lowered)) != len(lowered):
            raise ValueError("denied names must be distinct, ignoring case")
        if any(not re.search(r"\w", name) for name in self.denied):
            raise ValueError("a denied name needs at least one word character")
        if any("\0" in name for name in self.denied):
            raise ValueError("a denied name has no null character")

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(pos, name, "deny") for pos, name in enumerate(self.denied, start=1)]
        if self.allowed:
            rows.append((None, self.allowed, "allow"))
        return spark.createDataFrame(rows, POLICY_SCHEMA)

    @classmethod
    def from_table(cls, table: DataFrame) -> Policy:
        """Read a policy table that is to become part of a plan, name by name."""
        denied = table.filter("effect = 'deny'").orderBy("pos").select("name").collect()
        allowed = table.filter("effect = 'allow'").select("name").limit(2).collect()
        if len(allowed) > 1:
            raise ValueError("a policy has one allowed name")
        return cls(tuple(row.name for row in denied), allowed[0].name if allowed else "")


def rules_to_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(r.rule_id, r.pattern, r.needs, r.linear) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rules_from_table(table: DataFrame) -> list[Rule]:
    rows = table.select("rule_id", "pattern", "needs", "linear").orderBy("rule_id")
    return [Rule(*row) for row in rows.collect()]


# The patterns and names decide the results.
_SQL_VERB = (
    r"\b(select|insert|update|delete|create|drop|alter|grant|revoke|merge|truncate)\b"
)
_CATALOG_WORD = r"\bcatalog\b"
CATALOG_RULES = (
    Rule(1, r"\bdatabricks\b", "databricks"),
    Rule(2, r"\bunity-catalog\b", "unity-catalog"),
    Rule(3, r"/api/2\.[01]/unity-catalog", "/unity-catalog"),
    Rule(4, r"\bcloud\.databricks\.com\b", "cloud.databricks.com"),
    Rule(5, r"\bazuredatabricks\.net\b", "azuredatabricks.net"),
    Rule(
        6,
        f"{_SQL_VERB}.*{_CATALOG_WORD}",
        "catalog",
        ordered_on_a_line(_SQL_VERB, _CATALOG_WORD),
    ),
    Rule(7, r"use\s+catalog", "catalog"),
    Rule(8, r"show\s+(catalogs|schemas|tables)", "show"),
)
CATALOG_POLICY = Policy(
    denied=("system", "samples", "gops_dev", "sandbox_hackaton"),
    allowed="sandbox_others",
)
CATALOG_INVENTORY = ("system", "samples", "gops_dev", "sandbox_hackaton", "sandbox_others")
