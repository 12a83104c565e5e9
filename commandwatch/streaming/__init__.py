"""Audit of a log that keeps growing."""

from commandwatch.streaming.audit_stream import start_audit, start_table_audit

__all__ = ["start_audit", "start_table_audit"]
