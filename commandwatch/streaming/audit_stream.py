"""Audit a stream of commands; every row is decided on its own, so there is no state.

A policy that is part of the plan is decided within the stream. A policy table of any size is
joined batch by batch: the verdicts of a batch go to a folder of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from commandwatch.operators.policy_table import classify_by_table
from commandwatch.policy import Rule

#: The column that tells the batch, and the name of the folders.
BATCH = "batch"


def start_audit(
    verdicts: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    interval: str | None = None,
) -> StreamingQuery:
    """Append streamed verdicts to files below ``path``.

    ``verdicts`` is a streaming DataFrame from ``plans.audit`` or any narrow operator. With
    an ``interval`` such as "1 minute" the query keeps running; otherwise it takes what is
    there, in as many batches as the source's limits ask for, and stops. ``checkpoint`` must
    be on shared storage: after a failure the query resumes there and writes each row once.
    """
    if not verdicts.isStreaming:
        raise ValueError("start_audit needs a streaming DataFrame")
    return (
        verdicts.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**_trigger(interval))
        .start()
    )


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def start_table_audit(
    log: DataFrame,
    rules: Sequence[Rule],
    policy: DataFrame,
    path: str,
    checkpoint: str,
    command: str = "command",
    arguments: str | None = None,
    fmt: str = "parquet",
    interval: str | None = None,
    strategy: str | None = None,
) -> StreamingQuery:
    """Write a streamed log with its verdicts under a policy table, of any size, below ``path``.

    Each batch is decided by `classify_by_table` and written to the folder of its number. A
    batch that runs again after a failure, with the same rows, replaces that folder as a
    whole, so that every row is there once. The policy is read anew for each batch; where it
    changes in place, a batch that runs again follows the later one.
    """
    if not log.isStreaming:
        raise ValueError("start_table_audit needs a streaming DataFrame")

    def write(rows: DataFrame, batch: int) -> None:
        decided = classify_by_table(
            rows, rules, policy, command=command, arguments=arguments, strategy=strategy
        )
        decided.write.format(fmt).mode("overwrite").save(f"{path}/{BATCH}={batch}")

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )
