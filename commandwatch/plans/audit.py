"""The audit from payload to verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from commandwatch.operators.classify import classify
from commandwatch.operators.extract import extract_command
from commandwatch.policy import CATALOG_POLICY, CATALOG_RULES, Policy, Rule


def audit(
    log: DataFrame,
    rules: Sequence[Rule] = CATALOG_RULES,
    policy: Policy = CATALOG_POLICY,
    payload: str = "payload",
    ignore_key_case: bool = True,
) -> DataFrame:
    """Decide every payload of a log, batch or streaming, without a shuffle.

    Adds command, arguments, verdict, catalog and reason to the columns of the log.
    """
    extracted = extract_command(log, payload, ignore_key_case)
    return classify(extracted, rules, policy, arguments="arguments")
