"""Audit command logs against a catalog policy on Spark."""

from commandwatch.plans.audit import audit
from commandwatch.policy import CATALOG_POLICY, CATALOG_RULES, Policy, Rule

__all__ = ["CATALOG_POLICY", "CATALOG_RULES", "Policy", "Rule", "audit"]
