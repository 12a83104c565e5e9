r"""The written rule as a second verdict, and where it differs from the deny list.

The deny list looks for names anywhere in commands of a few kinds. The written rule allows one
catalog and denies operations that target another one. Targets are found by their place: the
argument of a CLI command on a catalog or its schemas and tables, the value of a request's
``catalog_name`` or path, the object of an SQL statement on a catalog, and the first part of a
three-part name behind a word that names a relation. Names may stand in backticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commandwatch.functions.staged import once
from commandwatch.functions.text import REGEX_FLAGS
from commandwatch.operators.classify import ALLOW, DENY
from commandwatch.policy import Policy

_PART = r"(?:`[^`\n]+`|[\w-]+)"
_DOTTED = rf"({_PART}(?:\.{_PART})*)"
#: What stands before a name whose first part is a catalog.
BEFORE_CATALOG = (
    r"\b(?:schemas|tables|volumes|functions)\s+list\s+",
    r"\bcatalogs\s+(?:get|create|update|delete)\s+",
    r"\bcatalog_name=",
    r"/unity-catalog/catalogs/",
    r"\buse\s+catalog\s+",
    r"\b(?:create|drop|alter)\s+catalog\s+(?:if\s+(?:not\s+)?exists\s+)?",
    r"\bshow\s+(?:schemas|tables)\s+(?:in|from)\s+",
)
#: What stands before a relation; only a name of three parts begins with a catalog.
BEFORE_RELATION = (r"\b(?:from|join|into|update|table|view)\s+", r"\btables\s+(?:get|delete)\s+")
#: Rules that fire for a platform's own words, addresses and paths; the others also for English.
PLATFORM_RULES = (1, 2, 3, 4, 5)

UNLISTED_CATALOG = "D1"
MISSED_TARGET = "D2"
MERE_MENTION = "D3"
ORDINARY_COMMAND = "D4"


def _behind(text: Column, before: tuple[str, ...]) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{REGEX_FLAGS}(?:{'|'.join(before)}){_DOTTED}"), 1)


def name_parts(name: Column) -> Column:
    """The parts of a dotted name, without backticks."""
    parts = F.regexp_extract_all(name, F.lit(f"{REGEX_FLAGS}({_PART})"), 1)
    return F.transform(parts, lambda part: F.regexp_replace(part, "`", ""))


def target_catalogs(text: Column) -> Column:
    """The distinct catalogs that a lowercased command targets: in places of catalogs first,
    then in names of relations, each in the order of the text."""
    first = lambda parts: F.get(parts, F.lit(0))
    catalogs = F.transform(_behind(text, BEFORE_CATALOG), lambda n: first(name_parts(n)))
    relations = F.transform(_behind(text, BEFORE_RELATION), name_parts)
    relations = F.transform(F.filter(relations, lambda p: F.size(p) >= 3), first)
    return F.array_distinct(F.concat(catalogs, relations))


def with_targets(log: DataFrame, command: str = "command") -> DataFrame:
    """Add ``targets``, the catalogs that a command targets; none for a null command."""
    found = F.coalesce(target_catalogs(F.lower(command)), F.array().cast("array<string>"))
    return once(log.drop("targets"), "targets", found)


def prose_verdict(log: DataFrame, allowed: str, command: str = "command") -> DataFrame:
    """Add ``targets``, ``prose_verdict`` and ``prose_catalog`` to every row: denied for the
    first catalog that it targets and that is not the allowed one."""
    others = F.filter("targets", lambda name: name != allowed.lower())
    return (
        with_targets(log, command)
        .withColumn("prose_catalog", F.get(others, F.lit(0)))
        .withColumn("prose_verdict", F.when(F.col("prose_catalog").isNotNull(), DENY).otherwise(ALLOW))
    )


def policy_gaps(verdicts: DataFrame, policy: Policy, platform: str = "platform") -> DataFrame:
    """The rows whose two verdicts differ, with ``gap`` and the ``gap_catalog`` concerned.

    ``verdicts`` has ``verdict`` and ``catalog`` of the deny list, the columns of
    `prose_verdict`, and in ``platform`` whether a rule of `PLATFORM_RULES` fires. D1: the
    target is on no list. D2: a denied catalog is targeted by a command that isn't in context.
    D3: the denied name is only mentioned. D4: so it is, in a command that isn't the platform's.
    """
    listed = F.col("prose_catalog").isin([name.lower() for name in policy.denied])
    only_prose = (F.col("prose_verdict") == DENY) & (F.col("verdict") == ALLOW)
    only_script = (F.col("verdict") == DENY) & (F.col("prose_verdict") == ALLOW)
    gap = (
        F.when(only_prose & listed, MISSED_TARGET)
        .when(only_prose, UNLISTED_CATALOG)
        .when(only_script & F.col(platform), MERE_MENTION)
        .when(only_script, ORDINARY_COMMAND)
    )
    named = F.when(only_prose, F.col("prose_catalog")).otherwise(F.col("catalog"))
    found = verdicts.withColumn("gap", gap).withColumn("gap_catalog", named)
    return found.filter("gap IS NOT NULL")
