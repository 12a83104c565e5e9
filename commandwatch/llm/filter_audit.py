"""Operator 12: how filters on documents interact, by sorted posting lists.

1. One pass over the texts says which filters each document fails. A filter for repeated
   texts needs the whole table: digests meet the least doc_id of their text in a join.
2. Documents of a part are dealt into ranges of ids. A range keeps one sorted posting list
   for each filter, with the places of the documents that fail it. Rows that agree in id and
   failures are counted before they are dealt, so that a range has a bounded number of
   entries however often a row is repeated.
3. For every set of filters the range merges its lists into their union, and for every filter
   takes the difference of its list and the union: the documents that it would remove after
   that set, in any order of the set. The shorter list gallops through the longer one.
4. Sizes are summed over the ranges of a part. 80 sums a part (5 filters, 16 sets of others)
   answer for all 120 orders, so that orders are only written out at the end.

Results: a null text counts as empty, a null part as the empty string. A document repeats
another if its text equals that of any smaller doc_id, in any part; a null doc_id is larger
than all others, and rows of one doc_id don't repeat one another. Rows of the same doc_id
count one by one. Labels of a doc_id are 1 if any of its rows says so; a null doc_id has none.
An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spark_io import checkpointed, each_batch, encoded

# The filters of the audit; E is the one for repeated texts.
FILTERS = "ABCDE"
REPEATED = FILTERS.index("E")
IDS_PER_RANGE = 1 << 13
CHUNK = 1 << 20
_UPPER = bytes(range(0x41, 0x5B))
_SIGNS = b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))  # all bytes of a character but its first
_BLANKS = b" \t\n\r\x0b\x0c"


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in parts of some CHUNK bytes, cut behind white space, a longer word whole."""
    at = 0
    while len(data) - at > CHUNK:
        end = max(data.rfind(sign, at, at + CHUNK) for sign in (b" ", b"\n")) + 1
        if not end:
            behind = [p for sign in _BLANKS if (p := data.find(sign, at + CHUNK)) >= 0]
            end = min(behind, default=len(data) - 1) + 1
        yield data[at:end]
        at = end
    yield data[at:]


def failures(data: bytes) -> int:
    """Bit by bit, which of the filters on a single text it fails.

    A: fewer than 200 words; B: fewer distinct words than half of all; C: over 3 % of the
    characters are capitals A-Z; D: it has a sign of `#$%&*|`.
    """
    n_words = upper = inner = signs = 0
    distinct: set[bytes] = set()
    for part in _pieces(data):
        words = part.split()  # bytes: at ASCII white space only
        n_words += len(words)
        distinct.update(words)
        upper += len(part) - len(part.translate(None, _UPPER))
        inner += len(part) - len(part.translate(None, _INNER))
        signs += len(part) - len(part.translate(None, _SIGNS))
    failed = n_words < 200, 100 * len(distinct) < 50 * n_words, 100 * upper > 3 * (len(data) - inner), signs > 0
    return sum(bit << k for k, bit in enumerate(failed))


def failing(docs: DataFrame, part: str = "lang") -> DataFrame:
    """part, doc_id and `failed` (one bit for each filter) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = encoded(batch)
        digests = pa.array([hashlib.blake2b(data, digest_size=16).digest() for data in found], pa.binary())
        columns = [batch.column("doc_id"), batch.column("part"), pa.array([failures(data) for data in found], pa.int32()), digests]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "failed", "digest"])

    texts = docs.select(F.col("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    found = checkpointed(each_batch(texts, work, "doc_id bigint, part string, failed int, digest binary"))
    # A text's first document; the join is between two plain exchanges, so that Spark splits
    # the rows of a text that very many documents have.
    firsts = found.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    met = found.join(firsts.select("digest", "first"), "digest", "left")
    repeated = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("first") < F.col("doc_id")))
    return met.select("part", "doc_id", F.col("failed").bitwiseOR(F.when(repeated, 1 << REPEATED).otherwise(0)).alias("failed"))


def minus(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sorted entries of one list that the other lacks; the shorter seeks in the longer."""
    if not len(one) or not len(other):
        return one
    if len(one) <= len(other):
        places = np.searchsorted(other, one)
        return one[other[np.minimum(places, len(other) - 1)] != one]
    places = np.searchsorted(one, other)
    places = places[one[np.minimum(places, len(one) - 1)] == other]
    return np.delete(one, places)


def union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """The merge of sorted lists, each entry once; from the longest on, others are put in."""
    ordered = sorted(lists, key=len, reverse=True)
    merged = ordered[0] if ordered else np.zeros(0, np.int32)
    for one in ordered[1:]:
        new = minus(one, merged)
        merged = np.insert(merged, np.searchsorted(merged, new), new)
    return merged


SUMS = "part string, filter int, others int, kept bigint, removed bigint, good_lost bigint, toxic_lost bigint, failing bigint"


def dealt(failed: DataFrame, labels: DataFrame, ids_per_range: int = IDS_PER_RANGE) -> DataFrame:
    """Rows that agree in part, id and failures, counted, with the labels and range of the id."""

    def says(name: str) -> Column:
        return F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(name)

    known = labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality"), says("toxic"))
    counted = failed.groupBy("part", "doc_id", "failed").agg(F.count("*").alias("rows"))
    return counted.join(known, "doc_id", "left").select(
        "part",
        F.floor(F.col("doc_id") / ids_per_range).cast("bigint").alias("range"),
        "doc_id",
        "failed",
        "rows",
        F.coalesce("quality", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def range_sums(marked: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """For each part, range, filter, and set of other filters (a bit each): what is kept behind
    all of them, what the filter removes behind the others, of that good and toxic documents,
    and the size of the filter's own list."""

    def sums(table: pa.Table) -> pa.Table:
        # An entry's place in the order of ids stands for its id, so that ids may repeat.
        table = table.sort_by([("doc_id", "ascending"), ("failed", "ascending")])
        part, bits, weights = table.column("part")[0].as_py(), table.column("failed").to_numpy(), table.column("rows").to_numpy()
        good, toxic = (weights * table.column(c).to_numpy() for c in ("good", "toxic"))
        postings = [np.flatnonzero(bits >> k & 1) for k in range(n_filters)]
        sizes = [int(weights[x].sum()) for x in postings]
        out = []
        for others in range(1 << n_filters):
            merged = union([postings[k] for k in range(n_filters) if others >> k & 1])
            kept = int(weights.sum() - weights[merged].sum())
            for k in range(n_filters):
                if not others >> k & 1:
                    left = minus(postings[k], merged)
                    removed = int(weights[left].sum())
                    out.append((part, k, others, kept - removed, removed, int(good[left].sum()), int(toxic[left].sum()), sizes[k]))
        kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.table(columns, [x.split()[0] for x in SUMS.split(", ")])

    return marked.groupBy("part", "range").applyInArrow(sums, SUMS)


def audit(sums: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters, and step."""
    n = len(names)
    amounts = ("kept", "removed", "good_lost", "toxic_lost", "failing")
    totals = sums.groupBy("part", "filter", "others").agg(*(F.sum(c).alias(c) for c in amounts))
    # The number of orders in which exactly this set stands before the filter.
    orders = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n))), F.bit_count("others") + 1)
    by_filter = totals.groupBy("part", "filter").agg(
        F.sum(orders * F.col("removed")).alias("shapley"),
        F.sum(F.when(F.bit_count("others") == n - 1, F.col("removed"))).alias("unique_fails"),
    )
    steps = []
    for order in itertools.permutations(range(n)):
        before = 0
        for step, k in enumerate(order, start=1):
            steps.append(("".join(names[i] for i in order), step, k, before))
            before |= 1 << k
    written = sums.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, others int")
    redundant = (F.col("failing") - F.col("removed")).alias("redundant")
    rows = totals.join(by_filter, ["part", "filter"]).join(F.broadcast(written), ["filter", "others"])
    return rows.select("part", "filter_order", "step", "kept", "removed", redundant, "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the five filters on documents, by part."""
    return audit(range_sums(dealt(failing(docs, part), labels)))
