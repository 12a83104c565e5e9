"""Operator 8: quality from how well dictionaries of good and of bad text compress a text.

One zstandard dictionary is trained on labelled good texts and one on bad ones. A text is
compressed with each; the difference of the two sizes over their sum is turned into a score
by a logistic calibration on labelled texts that the dictionaries have not seen (each third
of the sample by dictionaries from the other two).

The dictionaries are fitted on a bounded sample of labelled rows (`ROWS_PER_CLASS`,
`CHARS_PER_CLASS` in `labelled`), cut into training samples of `PART` bytes; every whole
text is scored.

Results: a null or empty text has a difference of 0 and the score that goes with it. Without
labelled rows of both classes every score is the share of good rows in the sample, 0 without
any. Repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import CHARS_PER_CLASS, ROWS_PER_CLASS, fitted_on, labelled_sample, logistic, probability
from .spark_io import each_batch, encoded, texts

DICTIONARY = 64 << 10
LEVEL = 3
PART = 2_000
FOLDS = 3
GOOD_FROM = 0.3


def dictionary(found: list[bytes]) -> bytes:
    """A dictionary for texts like these; too few to train on make one as they are."""
    parts = [text[i : i + PART] for text in found for i in range(0, len(text), PART)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:DICTIONARY]


class Compressors:
    """Sizes under the bad and the good dictionary. Built from bytes in each task."""

    def __init__(self, dictionaries: list[bytes]):
        self.by_class = []
        for data in dictionaries:
            own = zstandard.ZstdCompressionDict(data) if data else None
            if own:
                own.precompute_compress(level=LEVEL)
            self.by_class.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_dict_id=False, write_content_size=False))

    def difference(self, data: bytes) -> float:
        """Above 0 if the good dictionary serves better."""
        if not data:
            return 0.0
        bad, good = (len(c.compress(data)) for c in self.by_class)
        return (bad - good) / (bad + good)


def calibrated(differences: np.ndarray) -> np.ndarray:
    """What the calibration sees: the difference, and its root, which tells small ones apart."""
    x = np.asarray(differences, float)
    return np.column_stack([10 * x, 3 * np.sign(x) * np.sqrt(np.abs(x))])


def fitted(sample: list[tuple[int, str]]) -> tuple[list[bytes], np.ndarray]:
    """The two dictionaries, bad first, and the weights of the calibration."""
    rate = float(np.mean([y for y, _ in sample])) if sample else 0.0
    if not 0 < rate < 1:
        return [b"", b""], np.array([0.0, 0.0, 30.0 if rate else -30.0])
    by_class = [[t.encode("utf-8", "replace") for y, t in sample if y == k] for k in (0, 1)]
    values, target = [], []
    for fold in range(FOLDS):
        fit_on = [dictionary([t for i, t in enumerate(part) if i % FOLDS != fold]) for part in by_class]
        sizes = Compressors(fit_on)
        for y, part in enumerate(by_class):
            values += [sizes.difference(t) for t in part[fold::FOLDS]]
            target += [y] * len(part[fold::FOLDS])
    target = np.array(target, float)
    return [dictionary(part) for part in by_class], logistic(calibrated(values), target)


def quality(docs: DataFrame, dictionaries: list[bytes], weights: np.ndarray) -> DataFrame:
    """doc_id and score of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = Compressors(dictionaries)
        found = [sizes.difference(data) for data in encoded(batch)]
        scores = probability(calibrated(found), weights)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return each_batch(texts(docs), work, "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, unseen: Column) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""
    sample = labelled_sample(docs, labels, "quality", unseen, ROWS_PER_CLASS, CHARS_PER_CLASS)
    scored = quality(docs, *fitted_on(sample, fitted))
    return scored.select("doc_id", unseen.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
