"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before has kept and returns the columns of `documents`
(the last one: the packed pieces). n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commandwatch.llm import near_dedup, packing, secrets, substring_dedup, toxicity
from commandwatch.llm.queries import TOKENIZER
from commandwatch.llm.spark_io import checkpointed, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity scores 0.3 or more."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels, F.lit(False)))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near copies."""
    prepare(spark)
    return near_dedup.deduplicated(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages out that a document with a smaller doc_id has."""
    prepare(spark)
    return _measured(substring_dedup.unrepeated(docs))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    prepare(spark)
    return _measured(secrets.redacted(docs, secrets.fit(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of all documents into sequences."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express none of the models and no components; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
