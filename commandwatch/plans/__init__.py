"""Whole jobs put together from the operators."""

from commandwatch.plans.audit import audit

__all__ = ["audit"]
