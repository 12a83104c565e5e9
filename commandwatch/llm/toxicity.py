"""Operator 2: toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary text get a word bigram model each. A bigram backs off to the bigrams of
both classes together, those to the class's own continuation counts, and those to
continuation counts that both classes share, so an expression that one class has hardly seen
is smoothed the same way in both. Every count keeps what its discount leaves: the discounts
for 1, 2 and more are estimated from the counts. The score of a text is calibrated on
labelled texts that the counts have not seen (each third of them by counts from the
other two), from the mean log ratio of the two likelihoods and, beside it, means of what lies
far above, above and below the text's median word.

Counts and calibration are learned from all labelled texts, in Spark jobs (`kneser_ney`);
every whole text is scored. The jobs that learn also measure all texts of their table, so that
scoring these takes no more jobs; other texts are measured with the labelled ones beside them.
`fitted` makes the same models of a few texts in memory.

Results: a null or empty text has no words; its mean log ratio is 0 and its score what the
calibration gives for that. Without labelled rows of both classes every score is the share of
toxic rows among the labelled, 0 without any. Repeated rows are scored alike; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kneser_ney import FOLDS, chunked, discounts, looked_up, measured, pair_keys, plain_words
from .labelled import in_folds, labelled_sample, logistic, logistic_of, probability
from .spark_io import checkpointed, texts, without_leftovers

STRONG = 2.0  # log ratio
TOXIC_FROM = 0.3
MOST_BROADCAST = 1_000_000  # rows of three numbers
EVIDENCE = ("mean", "strong", "weak", "below")


@dataclass
class KneserNey:
    """Log ratios of the two models: of a word after the backoff (known or not), of leaving a
    word for the backoff, and of the pairs that a class has kept."""

    words: np.ndarray
    word_ratio: np.ndarray
    leave_ratio: np.ndarray
    unseen_ratio: float
    pairs: np.ndarray
    pair_ratio: np.ndarray
    weights: np.ndarray

    def evidence(self, words: np.ndarray) -> tuple[float, float, float, float]:
        """The mean log ratio, and beside it three parts: strong and weak evidence above the
        text's own median word, and evidence below it. From the parts the median takes out
        what language and topic do to all words alike; the mean keeps the level of the whole."""
        if not len(words):
            return 0.0, 0.0, 0.0, 0.0
        at, known = looked_up(self.words, words)
        total = np.full(len(words), self.unseen_ratio)
        total[known] = self.word_ratio[at[known]]
        if len(words) > 1:
            after = np.flatnonzero(known[:-1])
            total[after + 1] += self.leave_ratio[at[after]]
            pair, seen = looked_up(self.pairs, pair_keys(words[:-1], words[1:]))
            total[1:][seen] = self.pair_ratio[pair[seen]]
        mean = float(total.mean())
        total = total - np.median(total)
        strong = np.maximum(total - STRONG, 0).mean()
        return mean, float(strong), float(np.maximum(total, 0).mean() - strong), float(np.maximum(-total, 0).mean())

    def scores(self, found: list[str | None]) -> np.ndarray:
        values = np.array([self.evidence(plain_words(t)) for t in found], float).reshape(-1, 4)
        return probability(calibrated(values), self.weights)


def calibrated(values: np.ndarray) -> np.ndarray:
    """What the calibration sees: each mean, and the roots of the parts, which tell small ones apart."""
    return np.column_stack([values, np.sqrt(values[:, 1:])])


def _discounted(counts: np.ndarray) -> np.ndarray:
    """Counts less the discounts for 1, 2 and more, estimated from how many counts are 1 to 4."""
    n = np.bincount(counts[counts < 5].astype(np.int64), minlength=5)[:5].astype(float)
    return counts - discounts(n)[np.minimum(counts, 3).astype(np.int64)]


def _counted(by_class: list[list[np.ndarray]]) -> KneserNey:
    """The two models of texts given as word hashes, without calibration."""
    vocabulary = np.unique(np.concatenate([w for part in by_class for w in part] or [np.zeros(0, np.uint64)]))
    n = len(vocabulary)
    seen = []  # per class: distinct pairs, their counts, their words' places
    for part in by_class:
        # A pair counts once for each word before it: copies of a text count once.
        words = np.concatenate([*part, np.zeros(2, np.uint64)])
        pair = pair_keys(words[:-1], words[1:])
        inside = np.ones(len(pair), bool)  # pairs with a word before them in the same text
        ends = np.cumsum([len(w) for w in part], dtype=np.int64)
        for at in (ends - 1, ends):
            inside[at[at < len(pair)]] = False
        inside[0] = False
        inside[max(0, len(words) - 3) :] = False
        places = np.flatnonzero(inside)
        _, first = np.unique(pair_keys(words[places - 1], pair[places]), return_index=True)
        places = places[first]
        keys, first, counts = np.unique(pair[places], return_index=True, return_counts=True)
        places = places[first]
        left, right = np.searchsorted(vocabulary, words[places]), np.searchsorted(vocabulary, words[places + 1])
        seen.append((keys, counts, left, right))

    # Continuation counts; what the discounts take from both is what the backoff gives back.
    continuation = [np.bincount(right, minlength=n).astype(float) for _, _, _, right in seen]
    shared = sum(own - _discounted(own) for own in continuation) + 1 / max(n, 1)
    shared /= max(shared.sum(), 1.0)
    words, leave, tables, taken_by, totals = [], [], [], [], []
    for (keys, counts, left, right), own in zip(seen, continuation, strict=True):
        taken, total = _discounted(own), max(own.sum(), 1.0)
        taken_by.append(taken)
        totals.append(total)
        words.append(taken / total + (1 - taken.sum() / total) * shared)
        context = np.maximum(np.bincount(left, weights=counts, minlength=n), 1)
        left_to_pairs = _discounted(counts)
        leave.append(1 - np.bincount(left, weights=left_to_pairs, minlength=n) / context)
        tables.append((keys, left_to_pairs / context[left], left, right))
    # Between a class's pairs and its words stand the pairs of both classes together, so that
    # chance pairs of one class get part of their likelihood in the other, too.
    pairs = np.unique(np.concatenate([keys for keys, *_ in tables]))
    likelihood = np.zeros((2, len(pairs)))
    left_of, right_of = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    both = np.zeros(len(pairs), np.int64)
    for (keys, counts, left, right), _ in zip(seen, tables, strict=True):
        at = np.searchsorted(pairs, keys)
        left_of[at], right_of[at] = left, right
        both[at] += counts
    of_left = np.maximum(np.bincount(left_of, weights=both, minlength=n), 1)
    together = _discounted(both)
    leave_both = 1 - np.bincount(left_of, weights=together, minlength=n) / of_left
    together = together / of_left[left_of]
    for k, (keys, chance, _, _) in enumerate(tables):
        likelihood[k, np.searchsorted(pairs, keys)] = chance
        likelihood[k] += leave[k][left_of] * (together + leave_both[left_of] * words[k][right_of])
    ratio = lambda x: (np.log(x[1]) - np.log(x[0])).astype(np.float32)
    kept = (np.maximum(*taken_by) > 0) | (leave[0] < 1) | (leave[1] < 1)
    unseen = float(np.log(max(1 - taken_by[1].sum() / totals[1], 1e-9)) - np.log(max(1 - taken_by[0].sum() / totals[0], 1e-9)))
    return KneserNey(vocabulary[kept], ratio(words)[kept], ratio(leave)[kept], unseen, pairs, ratio(likelihood), np.zeros(8))


def fitted(sample: list[tuple[int, str]]) -> KneserNey:
    rate = float(np.mean([y for y, _ in sample])) if sample else 0.0
    if not 0 < rate < 1:
        none = np.zeros(0, np.uint64)
        constant = np.array([*[0.0] * 7, 30.0 if rate else -30.0])
        return KneserNey(none, np.zeros(0), np.zeros(0), 0.0, none, np.zeros(0), constant)
    by_class = [[plain_words(t) for y, t in sample if y == k] for k in (0, 1)]
    values, target = [], []
    for fold in range(FOLDS):
        model = _counted([[w for i, w in enumerate(part) if i % FOLDS != fold] for part in by_class])
        for y, part in enumerate(by_class):
            values += [model.evidence(w) for w in part[fold::FOLDS]]
            target += [y] * len(part[fold::FOLDS])
    model = _counted(by_class)
    model.weights = logistic(calibrated(np.array(values)), np.array(target, float))
    return model


@dataclass
class Model:
    """The weights of the calibration, the texts it was fitted on and their evidence (none
    without texts of both classes)."""

    weights: np.ndarray
    docs: DataFrame
    chunks: DataFrame | None = None
    known: DataFrame | None = None


def evidence(ratios: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """`KneserNey.evidence` of n texts at once, from the log ratios of their words."""
    sizes = np.bincount(places, minlength=n)
    filled, starts = sizes > 0, np.cumsum(sizes) - sizes
    means = lambda x: np.bincount(places, weights=x, minlength=n) / np.maximum(sizes, 1)
    if len(ratios) > 100 * n:
        ordered = np.concatenate([np.sort(own) for own in np.split(ratios, starts[1:])])
    else:
        ordered = ratios[np.lexsort((ratios, places))]
    medians = np.zeros(n)
    low, high = starts[filled] + (sizes[filled] - 1) // 2, starts[filled] + sizes[filled] // 2
    medians[filled] = (ordered[low] + ordered[high]) / 2
    from_median = ratios - medians[places]
    strong = means(np.maximum(from_median - STRONG, 0))
    return np.column_stack([means(ratios), strong, means(np.maximum(from_median, 0)) - strong, means(np.maximum(-from_median, 0))])


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("key", F.xxhash64("doc_id", "text"))


def _measured(chunks: DataFrame, docs: DataFrame) -> DataFrame:
    return measured(chunks, evidence, EVIDENCE, docs.schema["doc_id"].dataType.simpleString())


def fit(docs: DataFrame, labels: DataFrame, unseen: Column) -> Model:
    """Evidence of all texts by the counts of all labelled ones, and weights from each labelled
    text's evidence by the counts without its fold."""
    with without_leftovers(docs.sparkSession):
        folds = checkpointed(in_folds(labelled_sample(docs, labels, "toxic", unseen), FOLDS))
        numbers = {row["label"]: row["count"] for row in folds.groupBy("label").count().collect()}
        if len(numbers) < 2:
            return Model(np.array([*[0.0] * 7, 30.0 if numbers.get(1) else -30.0]), docs)
        if sum(numbers.values()) <= MOST_BROADCAST:  # the texts need not be shuffled to meet them
            folds = F.broadcast(folds)
        chunks = chunked(_keyed(docs).join(folds, "doc_id", "left"))
        known = _measured(chunks, docs)
        # Repeated rows of a document are one: the longest.
        apart = F.struct("size", "label", *(F.col(f"apart_{name}").alias(name) for name in EVIDENCE))
        longest = known.where(F.col("label").isNotNull()).groupBy("doc_id").agg(F.max(apart).alias("row"))
        rows = checkpointed(longest.select("row.label", *(f"row.{name}" for name in EVIDENCE)))
        return Model(logistic_of(rows, calibrated, 7), docs, chunks, known)


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, key and score of the texts."""
    weights = model.weights
    if model.chunks is None:
        return _keyed(docs).select("doc_id", "key", F.lit(float(probability(np.zeros((1, 7)), weights)[0])).alias("score"))
    known = model.known
    if docs is not model.docs:
        with without_leftovers(docs.sparkSession):
            fresh = _keyed(docs).select("*", F.lit(None).cast("int").alias("label"), F.lit(None).cast("int").alias("fold"))
            known = _measured(model.chunks.unionByName(chunked(fresh, asking=True)), docs)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.column_stack([batch.column(name).to_numpy() for name in EVIDENCE])
        scores = probability(calibrated(values), weights)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(scores)], ["doc_id", "key", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(work, batches)

    doc_id = known.schema["doc_id"].dataType.simpleString()
    return known.select("doc_id", "key", *EVIDENCE).mapInArrow(run, f"doc_id {doc_id}, key bigint, score double")


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every text."""
    return _scored(docs, model).select("doc_id", "score")


def without_toxic(docs: DataFrame, model: Model, threshold: float = TOXIC_FROM) -> DataFrame:
    """The rows whose text scores less than the threshold, with all their columns."""
    toxic = checkpointed(_scored(docs, model).where(F.col("score") >= threshold).select("key").distinct())
    if toxic.count() <= MOST_BROADCAST:
        toxic = F.broadcast(toxic)
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    return docs.withColumn("key_", key).join(toxic.withColumnRenamed("key", "key_"), "key_", "left_anti").select(*docs.columns)


def toxicity_scores(docs: DataFrame, labels: DataFrame, unseen: Column) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""
    scored = toxicity(docs, fit(docs, labels, unseen))
    return scored.select("doc_id", unseen.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
