"""The denial message and the nested record around it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def denial_message(catalog: Column, allowed: str) -> Column:
    return F.concat(
        F.lit("Command denied: it names catalog '"),
        catalog,
        F.lit(
            "' and looks like a platform CLI, SQL or catalog API call. "
            f"Work in this project is limited to catalog '{allowed}'. "
            "The command policy table lists what is denied; "
            "ask the policy owner to change it if this catalog is really needed."
        ),
    )


def verdict_record(message: Column) -> Column:
    """The nested verdict; the field names and constants are fixed values."""
    return F.struct(
        F.lit(False).alias("continue"),
        message.alias("stopReason"),
        message.alias("systemMessage"),
        F.struct(
            F.lit("PreToolUse").alias("hookEventName"),
            F.lit("deny").alias("permissionDecision"),
            message.alias("permissionDecisionReason"),
        ).alias("hookSpecificOutput"),
    )
