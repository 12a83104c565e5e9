"""Context rules and verdicts per command, without a shuffle.

A command may also be a list of strings, in a column ``arguments`` beside the command. Its
strings are matched one by one: a rule fires if it does on one of them, and a name is held if
one of them holds it; no match reaches from one string into the next.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commandwatch.functions.staged import add_any, add_first, explode_hits
from commandwatch.functions.text import rule_hit, word_hit
from commandwatch.policy import Policy, Rule

ALLOW, DENY = "allow", "deny"
NO_CONTEXT, NO_MATCH, MATCH = "no_context", "no_match", "match"
#: Between two strings of a list.
JOINT = "\0"


def _name_hits(names: Sequence[str]) -> list[tuple[Column, str]]:
    return [(word_hit(F.col("_text"), name), name) for name in names]


def _lowered(log: DataFrame, command: str, arguments: str | None) -> DataFrame:
    """Add the lowercased command as ``_text`` and, with ``arguments``, those as ``_strings``.

    The text of a list are its strings with a null character between two, which is no part of
    a word and of no name; so whole names can be searched in the text of any command.
    """
    if arguments is None:
        return log.withColumn("_text", F.lower(command))
    lowered = log.withColumn("_strings", F.transform(arguments, F.lower))
    joined = F.array_join("_strings", JOINT)
    text = F.when(F.col("_strings").isNull(), F.lower(command)).otherwise(joined)
    return lowered.withColumn("_text", text)


def _on_any_string(rules: Sequence[Rule]) -> Column:
    """Rules may match a null character, or what is around it; they look at each string."""
    return F.exists(
        "_strings", lambda s: functools.reduce(operator.or_, [rule_hit(s, r) for r in rules])
    )


def with_context(
    log: DataFrame, rules: Sequence[Rule], command: str, arguments: str | None = None
) -> DataFrame:
    """Add the lowercased command as ``_text`` and whether any rule fires as ``_context``."""
    lowered = _lowered(log, command, arguments)
    hits = [rule_hit(F.col("_text"), rule) for rule in rules]
    if arguments is not None and hits:
        strings = F.col("_strings")
        hits = [strings.isNull() & hit for hit in hits]
        hits.append(strings.isNotNull() & _on_any_string(rules))
    return add_any(lowered, "_context", hits).drop("_strings")


def in_context(
    log: DataFrame, rules: Sequence[Rule], command: str = "command", arguments: str | None = None
) -> DataFrame:
    """The commands that fire at least one rule."""
    tagged = with_context(log, rules, command, arguments)
    return tagged.filter("_context").drop("_text", "_context")


def tag_rules(
    log: DataFrame, rules: Sequence[Rule], command: str = "command", arguments: str | None = None
) -> DataFrame:
    """One row per command and context rule it fires, in column ``rule_id``."""
    lowered = _lowered(log, command, arguments)
    hits = [(rule_hit(F.col("_text"), rule), rule) for rule in rules]
    if arguments is not None:
        one = F.col("_strings").isNull()
        hits = [((one & hit) | (~one & _on_any_string([rule])), rule) for hit, rule in hits]
    fired = [(hit, rule.rule_id) for hit, rule in hits]
    return explode_hits(lowered, "rule_id", fired, "int").drop("_text", "_strings")


def classify(
    log: DataFrame,
    rules: Sequence[Rule],
    policy: Policy,
    command: str = "command",
    arguments: str | None = None,
) -> DataFrame:
    """Add ``verdict``, ``catalog`` and ``reason`` to every row.

    A command is denied for the first denied name, in policy order, that it holds as a
    whole word, provided that a context rule fires. All other rows are allowed. An existing
    ``reason`` (from ``extract_command``) is kept for rows without a command.
    """
    kept = [name for name in log.columns if name not in ("verdict", "catalog", "reason")]
    earlier = F.col("reason") if "reason" in log.columns else F.lit(None)

    fires = F.col("_context")
    decided = add_first(
        with_context(log, rules, command, arguments),
        "_catalog",
        _name_hits(policy.denied),
        only=fires,
    )
    denied = F.col("_catalog").isNotNull()
    without_command = F.col(command).isNull() | (F.col(command) == "")
    if arguments is not None:
        without_command = without_command & F.col(arguments).isNull()
    return decided.select(
        *kept,
        F.when(denied, DENY).otherwise(ALLOW).alias("verdict"),
        F.col("_catalog").alias("catalog"),
        F.when(denied, MATCH)
        .when(without_command, F.coalesce(earlier, F.lit("no_command")))
        .when(fires, NO_MATCH)
        .otherwise(NO_CONTEXT)
        .alias("reason"),
    )


def all_matches(
    log: DataFrame,
    rules: Sequence[Rule],
    policy: Policy,
    command: str = "command",
    arguments: str | None = None,
) -> DataFrame:
    """One row per command in context and denied name it holds, in column ``catalog``."""
    tagged = with_context(log, rules, command, arguments).filter("_context")
    hits = explode_hits(tagged, "catalog", _name_hits(policy.denied))
    return hits.drop("_text", "_context")


def classify_as_of(
    log: DataFrame,
    rules: Sequence[Rule],
    history: Sequence[tuple[str, str | None, Policy]],
    at: str,
    command: str = "command",
) -> DataFrame:
    """Add ``verdict`` and ``catalog`` under the policy in force at column ``at``.

    ``history`` holds (valid from, valid to or None, policy) with timestamps as text, and
    its periods do not overlap; each ends just before its valid-to time.
    """
    time = F.col(at)
    names = []
    for start, end, policy in history:
        in_force = time >= F.lit(start).cast("timestamp_ntz")
        if end is not None:
            in_force = in_force & (time < F.lit(end).cast("timestamp_ntz"))
        names += [(in_force & hit, name) for hit, name in _name_hits(policy.denied)]

    decided = add_first(
        with_context(log, rules, command), "_catalog", names, only=F.col("_context")
    )
    return decided.select(
        *(name for name in log.columns if name not in ("verdict", "catalog")),
        F.when(F.col("_catalog").isNotNull(), DENY).otherwise(ALLOW).alias("verdict"),
        F.col("_catalog").alias("catalog"),
    )
