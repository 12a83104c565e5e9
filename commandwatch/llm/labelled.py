"""Labelled texts, all or a bounded sample of them, and the calibration of a score on them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spark_io import freed

Model = TypeVar("Model")
ROWS_PER_CLASS = 3_000
CHARS_PER_CLASS = 12_000_000


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """Rows whose labels are not to be learnt; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    unseen: Column,
    rows: int | None = None,
    chars: int | None = None,
) -> DataFrame:
    """doc_id, label, order_ and text of all labelled rows, or, with both bounds, of at most
    `rows` rows and `chars` characters of each class.

    The bounded rows are those with the least hash of the doc_id, so the sample is the same wherever
    it is drawn. A document that would exceed the characters is passed over whole.
    """
    known = labels.where(~unseen & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.xxhash64("doc_id", F.lit(7)).alias("order")
    if rows is None or chars is None:
        return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id").select("doc_id", "label", order.alias("order_"), "text")
    chosen = [row for k in (0, 1) for row in known.where(F.col("label") == k).select("doc_id", "label", order).orderBy("order", "doc_id").limit(rows).collect()]
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id bigint, label int, order_ bigint"))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(wanted, "doc_id")
    sizes = found.groupBy("doc_id").agg(F.max(F.length("text")).alias("size"), F.first("label").alias("label"), F.first("order_").alias("order_"))
    left, kept = {0: chars, 1: chars}, []
    for row in sizes.orderBy("order_", "doc_id").collect():
        if row["size"] <= left[row["label"]]:
            left[row["label"]] -= row["size"]
            kept.append((row["doc_id"],))
    few = F.broadcast(docs.sparkSession.createDataFrame(kept, "doc_id bigint"))
    texts = found.join(few, "doc_id").groupBy("doc_id").agg(F.max(F.struct(F.length("text"), "order_", "label", "text")).alias("row"))
    return texts.select("doc_id", "row.label", "row.order_", "row.text")


def in_folds(rows: DataFrame, folds: int) -> DataFrame:
    """doc_id, label and fold of labelled rows: each class dealt in turn, in the order of order_.

    Rows are numbered within ranges of the hash, which are small, from the number of rows in
    the ranges before.
    """
    rows = rows.select("doc_id", "label", "order_", F.shiftright("order_", 52).alias("range_")).distinct()
    sizes = rows.groupBy("label", "range_").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("label").orderBy("range_")) - F.col("n")
    place = F.row_number().over(Window.partitionBy("label", "range_").orderBy("order_", "doc_id")) - 1
    placed = rows.withColumn("place", place).join(F.broadcast(sizes.select("label", "range_", before.alias("before"))), ["label", "range_"])
    return placed.select("doc_id", "label", F.pmod(F.col("before") + F.col("place"), F.lit(folds)).alias("fold"))


def fitted_on(sample: DataFrame, fit: Callable[[list[tuple[int, str]]], Model]) -> Model:
    """What `fit` makes of the (label, text) pairs of a bounded sample, in the sample's order.

    One task fits it, so that the driver holds the model alone and not the texts.
    """

    def work(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("order_", "ascending"), ("doc_id", "ascending")])
        pairs = list(zip(rows.column("label").to_pylist(), rows.column("text").to_pylist(), strict=True))
        return pa.table({"model": pa.array([pickle.dumps(fit(pairs))], pa.binary())})

    found = sample.groupBy(F.lit(0).alias("all_")).applyInArrow(freed(work), "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([])


def _slopes(features: np.ndarray, labels: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The gradient and, by column, its derivatives, without the penalty."""
    x = np.column_stack([features, np.ones(len(features))])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.column_stack([x.T @ (p - labels), (x * (p * (1 - p))[:, None]).T @ x])


def _newton(slopes: Callable[[np.ndarray], np.ndarray], n: int, width: int, penalty: float, steps: int) -> np.ndarray:
    w = np.zeros(width + 1)
    ridge = np.diag([*[penalty * n] * width, 1e-6])
    for _ in range(steps):
        found = slopes(w)
        step = np.linalg.solve(found[:, 1:] + ridge + 1e-9 * np.eye(len(w)), found[:, 0] + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by Newton's method."""
    return _newton(lambda w: _slopes(features, labels, w), len(features), features.shape[1], penalty, steps)


def logistic_of(
    rows: DataFrame, features: Callable[[np.ndarray], np.ndarray], width: int, penalty: float = 1e-3, steps: int = 30
) -> np.ndarray:
    """The same over all rows of a table of a label and numbers, which `features` turns into
    `width` features; each step adds up the slopes of the batches, and only these sums travel."""

    def slopes(w: np.ndarray) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width + 1, width + 2))
            for batch in batches:
                label, *numbers = (column.to_numpy() for column in batch.columns)
                total += _slopes(features(np.column_stack(numbers)), label.astype(float), w)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        found = rows.mapInArrow(work, "sums binary").collect()
        return sum((np.frombuffer(row["sums"]).reshape(width + 1, width + 2) for row in found), np.zeros((width + 1, width + 2)))

    return _newton(slopes, rows.count(), width, penalty, steps)


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))
