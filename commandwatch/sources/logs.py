"""Read payload logs, in batch or as a stream."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BYTES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _payload_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file")
    )


def read_text_log(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One payload per line, or per file with ``whole_files``: payload, file."""
    return _payload_lines(spark.read.text(path, wholetext=whole_files))


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A log table in any format Spark reads; only used columns are scanned."""
    return spark.read.format(fmt).options(**options).load(path)


def stream_text_log(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    whole_files: bool = False,
    compressed: bool = True,
) -> DataFrame:
    """New text files of a folder as a stream, one payload per line, or per file with
    ``whole_files`` (an indented payload has many lines): payload, file.

    Where no file is ``compressed``, whole files are read as bytes: Spark's reader of whole texts
    copies all of Hadoop's settings for each file.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if whole_files and not compressed:
        files = reader.format("binaryFile").schema(_BYTES).load(path)
        return _payload_lines(files.withColumn("value", F.col("content").cast("string")))
    return _payload_lines(reader.text(path, wholetext=whole_files))


@contextlib.contextmanager
def many_small_files(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Streams that run within list and read many small files by a few times ``tasks`` parts.

    Spark would list the files of a batch by up to 10,000 tasks, each of which first unpacks
    Hadoop's settings, keep in the driver what it found of them, and put some 30 files into a part.
    """
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    settings = {
        listing: str(min(int(spark.conf.get(listing)), tasks)),
        "spark.sql.files.openCostInBytes": "16384",
        "spark.sql.files.minPartitionNum": str(4 * tasks),
        "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stream_log(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder or glob as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
