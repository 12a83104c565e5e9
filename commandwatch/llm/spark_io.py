"""What several operators need from Spark: checkpoints, Arrow maps, sizes."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
ROWS_PER_BATCH = 1_000
#: Seconds that are left for it at most; shuffles of jobs beside these may stay longer.
LEFT_TO_REMOVE_S = 5


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the folder that spark.checkpoint.dir names.

    Where the setting and the session's folder are unset, a local master gets a folder of
    its own; a cluster has to name one, as its machines share no local folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("name a shared folder in spark.checkpoint.dir")
            folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def _shuffles(spark: SparkSession) -> set[int]:
    """The shuffles that the driver knows of."""
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    keys = tracker.shuffleStatuses().keysIterator()
    found = set()
    while keys.hasNext():
        found.add(keys.next())
    return found


@contextlib.contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Jobs within remove their shuffle files when they have ended.

    Spark only asks for that, so some time is left for it at the end.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    earlier = _shuffles(spark)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
    end = time.monotonic() + LEFT_TO_REMOVE_S
    while not _shuffles(spark) <= earlier and time.monotonic() < end:
        time.sleep(0.02)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty), and the named columns; all others are left out."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch of some BATCH_BYTES of text each, a longer text alone."""
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    first = size = 0
    for i, n in enumerate(lengths):
        if size and size + (n or 0) > BATCH_BYTES:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n or 0
    if first < batch.num_rows:
        yield batch.slice(first)


def each_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply `work` to parts of bounded size; empty batches are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield work(part)
        release()

    return df.mapInArrow(run, schema)


_shared: list[dict] = []


def shared(tables: dict) -> dict:
    """Register tables that the tasks of a worker share, for `forget`."""
    _shared.append(tables)
    return tables


def forget() -> None:
    """Let go of what tasks of earlier stages have left in this worker for others like them."""
    for tables in _shared:
        tables.clear()


def release() -> None:
    """Give the memory that a task has freed back to the machine: its Python worker lives on,
    beside others and the executor's own memory, and would keep it for stages to come."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only in the GNU library
        ctypes.CDLL(None).malloc_trim(0)


def freed(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`work` on a group, with `forget` before and `release` behind it."""

    def run(table: pa.Table) -> pa.Table:
        forget()
        result = work(table)
        release()
        return result

    return run


def freed_pair(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for two groups with the same key."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        forget()
        result = work(left, right)
        release()
        return result

    return run


def encoded(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of a batch as UTF-8."""
    return batch.column("text").cast(pa.binary()).to_pylist()


def tasks(spark: SparkSession) -> int:
    """The number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_sent: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, as --py-files does, and
    have rows travel to Python in small batches, as texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if context.applicationId not in _sent:
        package = Path(__file__).resolve().parent.parent
        base = Path(tempfile.mkdtemp(prefix="package-")) / package.name
        context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        _sent.add(context.applicationId)
