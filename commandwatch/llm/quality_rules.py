"""Operator 6: quality rules as a learned decision list.

Statistics of every whole text, two fixed rules on them, and for the rest an ordered list of
threshold conjunctions learned by sequential covering: a rule grows condition by condition
(greatest information gain on two thirds of the rows), is pruned from its end on the last
third, and takes the rows it covers out; the list ends when the next rule is not precise
enough there. The list becomes a chain of Spark conditional expressions.

The list is learned from the statistics of a bounded sample of labelled rows (`ROWS`); the
statistics of every row cover its whole text.

Results: a null or empty text has no words and fails the fixed rules. Without labelled bad
rows the list is empty and keeps what the fixed rules keep. Repeated rows are judged alike;
an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spark_io import each_batch, encoded, texts
from .words import runs, word_hashes

ROWS = 20_000
LEAST_PRECISION, LEAST_COVERED, MOST_CONDITIONS, MOST_RULES = 0.6, 8, 3, 12
MOST_THRESHOLDS = 64
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_stops", "n_lines")
#: What conditions compare: a count over another one.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "stops_per_word": ("n_stops", "n_words"),
}
_SPACES = [0x20, *range(0x09, 0x0E)]
_SYMBOLS = list(b"#*$%&|<>")
_STOPS = list(b".!?")


def counts(data: bytes) -> tuple[int, ...]:
    """The COUNTS of one text."""
    each = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = word_hashes(data)
    characters = int(each.sum() - each[0x80:0xC0].sum() - each[_SPACES].sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    three = runs(words, 3)
    repeated = 0
    if len(three):
        _, which, times = np.unique(three, return_inverse=True, return_counts=True)
        change = np.zeros(len(words) + 1, np.int64)
        twice = times[which] > 1
        change[: len(three)] += twice
        change[3 : 3 + len(three)] -= twice
        repeated = int((np.cumsum(change) > 0).sum())
    return (
        len(words),
        characters,
        int(each[_SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated,
        int(each[ord("A") : ord("Z") + 1].sum()),
        int(each[_STOPS].sum()),
        len(lines),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the COUNTS of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*(counts(data) for data in encoded(batch)), strict=True)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *COUNTS])

    return each_batch(texts(docs), work, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    ratio: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.ratio]
        return x >= self.threshold if self.at_least else x <= self.threshold

    def column(self) -> Column:
        top, bottom = RATIOS[self.ratio]
        x = F.col(top) / F.greatest(F.col(bottom), F.lit(1))
        return x >= self.threshold if self.at_least else x <= self.threshold


Rule = tuple[Condition, ...]


def covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for condition in rule:
        held &= condition.holds(values)
    return held


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the greatest gain of information among the rows that are held."""
    p0, n0 = int((bad & held).sum()), int((~bad & held).sum())
    before = np.log2(p0 / (p0 + n0))
    best, found = 0.0, None
    for ratio, x in values.items():
        cuts = np.unique(np.quantile(x[held], np.linspace(0, 1, MOST_THRESHOLDS)))
        cuts = np.unique(np.concatenate([cuts, np.quantile(x[held & bad], np.linspace(0, 1, MOST_THRESHOLDS))]))
        for at_least in (True, False):
            for cut in cuts:
                condition = Condition(ratio, at_least, float(cut))
                now = held & condition.holds(values)
                p, n = int((bad & now).sum()), int((~bad & now).sum())
                if p < LEAST_COVERED // 2 or p + n == p0 + n0:
                    continue
                if (gain := p * (np.log2(p / (p + n)) - before)) > best + 1e-9:
                    best, found = gain, condition
    return best, found


def _grown(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    held = np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and bad[held].any() and not bad[held].all():
        _, condition = _best_condition(values, bad, held)
        if condition is None:
            break
        rule, held = (*rule, condition), held & condition.holds(values)
    return rule


def _pruned(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The beginning of the rule that does best on fresh rows, its precision and reach."""
    best: tuple[float, Rule, float, int] = (-2.0, (), 0.0, 0)
    for k in range(1, len(rule) + 1):
        held = covered(rule[:k], values, len(bad))
        p, n = int((bad & held).sum()), int((~bad & held).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = (worth, rule[:k], p / max(p + n, 1), p + n)
    return best[1:]


def learned(rows: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """The ordered list of rules for bad rows, from arrays of the COUNTS and the labels."""
    values = {name: rows[top] / np.maximum(rows[bottom], 1) for name, (top, bottom) in RATIOS.items()}
    fresh = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        grow, prune = left & ~fresh, left & fresh
        if bad[grow].sum() < LEAST_COVERED:
            break
        rule = _grown({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        rule, precision, reach = _pruned(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        if precision < LEAST_PRECISION or reach < LEAST_COVERED // 2:
            break
        rules.append(rule)
        left &= ~covered(rule, values, len(bad))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 0; null if none does."""
    found = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules))):
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column()
        found = F.when(held, F.lit(number)).otherwise(found)
    return found


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> list[Rule]:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(rows)
    few = F.broadcast(docs.sparkSession.createDataFrame(chosen.collect(), "doc_id bigint, good int"))
    found = statistics(docs.select("doc_id", "text").join(few, "doc_id", "left_semi")).where(~base_failed()).join(few, "doc_id")
    table = found.orderBy(F.xxhash64("doc_id", F.lit(12)), "doc_id", *COUNTS).toPandas()
    return learned({c: table[c].to_numpy(np.float64) for c in COUNTS}, table["good"].to_numpy() == 0)


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts of every text, base_failed, kept, and the number of the rule that failed it."""
    found = statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", verdict(fit(docs, labels)))
    kept = ~F.col("base_failed") & F.col("rule").isNull()
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.when(~F.col("base_failed"), F.col("rule")).alias("rule"))
