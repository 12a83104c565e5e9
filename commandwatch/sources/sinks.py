"""Write verdicts."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commandwatch.operators.report import verdict_json


def write_verdict_lines(denied: DataFrame, allowed_name: str, path: str) -> None:
    """Write one line of compact JSON per denial, and nothing for other rows."""
    verdict_json(denied, allowed_name).select("value").write.text(path)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    df.write.format(fmt).partitionBy(*partition_by).save(path)


def _on_local_disk(spark: SparkSession, path: str) -> str | None:
    """The path as Python knows it, if Hadoop's local file system has it."""
    wanted = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = wanted.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(wanted).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_files(texts: DataFrame, path: str, tasks: int, per_folder: int) -> list[str]:
    """Write the text of each row, the only column, as a file of its own, and tell the folders.

    ``texts`` has ``tasks`` partitions. A folder holds at most some ``per_folder`` files, so
    that whoever lists it is done in bounded memory; the first one is ``path`` on a local disk.
    There Python writes the files: Hadoop's local file system starts a ``chmod`` for each file
    and for each of their checksums, which took most of the time. A task that runs again
    replaces its files by the same ones.
    """
    spark = texts.sparkSession
    per_task = math.ceil(per_folder / tasks)
    local = _on_local_disk(spark, path)
    if local is None:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        # Tasks move their own files, side by side, which the driver would do one by one.
        options = {"maxRecordsPerFile": 1, "compression": "none", "mapreduce.fileoutputcommitter.algorithm.version": "2"}
        folders = texts.withColumn("folder", F.floor(place / per_task))
        folders.write.partitionBy("folder").options(**options).text(path)
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
        return sorted(f.getPath().toString() for f in found if f.isDirectory())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt, n = task.partitionId(), task.taskAttemptId(), 0
        for batch in batches:
            for text in batch.column(0):
                folder = local if n < per_task else f"{local}-{n // per_task}"
                if n and n % per_task == 0:
                    os.makedirs(folder, exist_ok=True)
                name = f"part-{part:05d}-{n:09d}.txt"
                hidden = f"{folder}/.{attempt}-{name}"
                with open(hidden, "wb", buffering=0) as file:
                    file.write((text.as_py() or b"") + b"\n")
                os.replace(hidden, f"{folder}/{name}")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    os.makedirs(local)
    written = texts.select(F.col(texts.columns[0]).cast("binary")).mapInArrow(write, "n bigint")
    most = max((row.n for row in written.collect()), default=0)
    return [path, *(f"{path}-{k}" for k in range(1, math.ceil(most / per_task)))]


def write_bucketed(
    df: DataFrame, table: str, path: str, key: Sequence[str], buckets: int
) -> DataFrame:
    """Write ``df`` as a table below ``path`` in buckets by ``key``, and read it.

    Two tables with the same buckets are joined on the key without an exchange. The rows are
    dealt by the same hash before they are written, so that each bucket is one file.
    """
    dealt = df.repartition(buckets, *key)
    writer = dealt.write.format("parquet").bucketBy(buckets, *key).sortBy(*key)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
