"""Operators on command logs: extract, tag, decide, match against tables, report."""

from commandwatch.operators.classify import (
    all_matches,
    classify,
    classify_as_of,
    in_context,
    tag_rules,
)
from commandwatch.operators.extract import extract_command
from commandwatch.operators.policy_table import (
    classify_as_of_table,
    classify_by_table,
    deny_by_table,
    first_match,
    match_policy_table,
)
from commandwatch.operators.periods import history_faults, merged_periods
from commandwatch.operators.prose import policy_gaps, prose_verdict, with_targets
from commandwatch.operators.report import (
    allowed,
    allowed_rest,
    denials,
    policy_coverage,
    verdict_counts,
    verdict_json,
    verdict_records,
    verdict_rollup,
)

__all__ = [
    "all_matches",
    "allowed",
    "allowed_rest",
    "classify",
    "classify_as_of",
    "classify_as_of_table",
    "classify_by_table",
    "denials",
    "deny_by_table",
    "extract_command",
    "first_match",
    "history_faults",
    "in_context",
    "match_policy_table",
    "merged_periods",
    "policy_coverage",
    "policy_gaps",
    "prose_verdict",
    "tag_rules",
    "verdict_counts",
    "verdict_json",
    "verdict_records",
    "verdict_rollup",
    "with_targets",
]
