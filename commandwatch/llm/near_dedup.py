"""Operator 5: near-duplicate documents by MinHash, banding, verification and components.

1. Every text becomes its words (A-Z lowered), its set of word shingles (the whole sequence
   if it has fewer words), the minima of the set under many universal hash functions, and
   the bands of those minima.
2. Documents with equal word sequences collapse to the least doc_id, before any pairing.
3. Rounds over the band buckets that hold more than one component: in each round a document
   is compared with one centre of its buckets, so that a round costs no more pairs than
   there are documents. A pair is verified on both full sets. In the end all links are
   contracted to components by alternating large-star and small-star.
4. The documents that lie with several components in a bucket after the rounds are joined
   exactly, through their rarest shingles: whoever is outside the largest component of a
   bucket against all documents of other components.

A bit sketch of all minima stands before each verification; it lets every pair pass whose
similarity is near the threshold (six standard deviations). A pair at the threshold misses
all buckets with probability 5e-8 at 0.8 with 32 bands of 4 minima, 4e-7 at 0.85 with 25
bands of 5.

Results: a null or empty text, or one without words, has no shingles, is linked with nothing
and stays. Rows with a null doc_id follow the documents of the same words; without any, their
component is null and they stay. Repeated rows are resolved one by one, each by its own
text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import dealt, packed, summed_keys
from .components import components
from .spark_io import checkpointed, each_batch, encoded, freed, freed_pair, release, texts
from .words import mixed, runs, word_hashes

MINIMA = 128
CENTRE_ROUNDS = 2
DOCS_PER_GROUP, SHINGLES_PER_GROUP = 1_000, 4_000_000
PROFILE = "doc_id bigint, n_shingles bigint, sequence binary, bands array<bigint>, sketch array<bigint>"
_random = np.random.Generator(np.random.PCG64(5))
_FACTORS = _random.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)


@dataclass(frozen=True)
class Likeness:
    """When two documents are linked: words in a shingle, percent of shingles they share, and
    the bands of minima in which candidates must agree."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4

    @property
    def most_bits(self) -> int:
        """Pairs of sketch bits that may differ: those expected at the threshold, and six
        standard deviations."""
        same = self.percent / 100 + (1 - self.percent / 100) / 4
        return int(MINIMA * (1 - same) + 6 * (MINIMA * same * (1 - same)) ** 0.5) + 1


def shingles(data: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles."""
    words = word_hashes(data.lower())  # bytes: A-Z only
    if not len(words):
        return words
    return np.unique(runs(words, size) if len(words) >= size else runs(words, len(words)))


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of a set under each of the universal hash functions."""
    folded = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(folded), 256):
        np.minimum(least, (folded[i : i + 256, None] * _FACTORS + _TERMS).min(0), out=least)
    return least


def _bands(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = least[: bands * rows].reshape(bands, rows).astype(np.uint64)
    total = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return total.view(np.int64)


def _sketch(least: np.ndarray) -> np.ndarray:
    """Two well mixed bits of each minimum, in four 64-bit words."""
    two = mixed(least.astype(np.uint64)) & np.uint64(3)
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(two.reshape(-1, 32) << shifts, axis=1).view(np.int64)


def profiles(docs: DataFrame, like: Likeness) -> DataFrame:
    """Size of the set, digest of the word sequence, bands and sketch of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, sequences, bands, sketches = [], [], [], []
        for data in encoded(batch):
            found = shingles(data, like.words)
            sizes.append(len(found))
            if len(found):
                least = minima(found)
                sequences.append(hashlib.blake2b(b" ".join(data.lower().split()), digest_size=16).digest())
                bands.append(_bands(least, like.bands, like.rows))
                sketches.append(_sketch(least))
            else:
                sequences.append(None)
                bands.append(None)
                sketches.append(None)
        longs = pa.list_(pa.int64())
        columns = [pa.array(sizes, pa.int64()), pa.array(sequences, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_shingles", "sequence", "bands", "sketch"])

    return each_batch(texts(docs), work, PROFILE)


def _sets_of(table: pa.Table, like: Likeness) -> list[np.ndarray]:
    return [shingles(data, like.words) for data in table.column("text").cast(pa.binary()).to_pylist()]


def sets(docs: DataFrame, like: Likeness, n_groups: int) -> DataFrame:
    """doc_id, n, the full set, its rarest shingles in order, and how common the set is.

    Groups of rows send each shingle and its number of rows once to the blocks of an index,
    which sum up those that more than one group has. Any order of all shingles would do for
    `rare`, as long as it is the same for all rows; this one is by number of rows, then hash.
    """

    def sent(table: pa.Table) -> pa.Table:
        keys, times = np.unique(np.concatenate(_sets_of(table, like)), return_counts=True)
        return dealt(keys, times.astype(np.uint32), table.column("group")[0].as_py(), n_groups)

    def ranked(table: pa.Table, answers: pa.Table) -> pa.Table:
        found = _sets_of(table, like)
        keys, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        times[np.searchsorted(keys, packed(answers, "keys", np.uint64))] = packed(answers, "values", np.uint32)
        rare, common = [], []
        for own in found:
            rows = times[np.searchsorted(keys, own)]
            order = np.lexsort((own, rows))[: len(own) - -(-like.percent * len(own) // 100) + 1]
            rare.append(own[order].view(np.int64))
            common.append(float(np.log(rows).mean()))
        columns = {
            "doc_id": table.column("doc_id"),
            "n": pa.array([len(own) for own in found], pa.int64()),
            "shingles": pa.array([own.tobytes() for own in found], pa.binary()),
            "rare": pa.array(rare, pa.list_(pa.int64())),
            "common": pa.array(common, pa.float64()),
        }
        return pa.table(columns)

    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)).alias("group")
    by_group = docs.select(group, "doc_id", "text").groupBy("group")
    entries = "keys binary, values binary"
    known = by_group.applyInArrow(freed(sent), f"block bigint, group bigint, {entries}")
    answers = known.groupBy("block").applyInArrow(freed(summed_keys), f"group bigint, {entries}")
    schema = "doc_id bigint, n bigint, shingles binary, rare array<bigint>, common double"
    return by_group.cogroup(answers.groupBy("group")).applyInArrow(freed_pair(ranked), schema)


def _alike(like: Likeness) -> Column:
    """Can two sketches and set sizes belong to linked documents?"""
    differing = F.lit(0)
    for k in range(MINIMA // 32):
        x = F.col("sketch_a")[k].bitwiseXOR(F.col("sketch_b")[k])
        pairs = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differing = differing + F.bit_count(pairs)
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (100 * small >= like.percent * large) & (differing <= like.most_bits)


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """The marks of one side of a pair, its id under that name."""
    return rows.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch", *more)))


def _verified(pairs: DataFrame, full: DataFrame, like: Likeness) -> DataFrame:
    """Of distinct pairs (a, b), those whose full sets are similar enough.

    Both joins are between two exchanges and nothing above needs their keys together, so
    that Spark splits the pairs of a document that stands in very many.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            for x, y in zip(left, right, strict=True):
                either = len(np.union1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
                both = (len(x) + len(y)) // 8 - either
                linked.append(100 * both >= like.percent * either)
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
        release()

    left = full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    met = pairs.join(left, "a").join(right, "b")
    return met.select("a", "b", "left", "right").mapInArrow(judge, "a bigint, b bigint")


def _links(pairs: DataFrame, marks: DataFrame, full: DataFrame, like: Likeness) -> DataFrame:
    """Links among candidate pairs (a, b), by sketch first, then on the full sets."""
    met = pairs.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct()
    likely = met.join(_side(marks, "a"), "a").join(_side(marks, "b"), "b").where(_alike(like)).select("a", "b")
    return _verified(likely, full, like)


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold more than one component, with the component."""
    if labels is None:
        return members.withColumn("component", F.col("id"))
    known = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = checkpointed(known.select("band", "id", "component"))
    mixed_up = known.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return known.join(checkpointed(mixed_up.select("band")), "band", "left_semi")


def _centre_pairs(known: DataFrame, marks: DataFrame, turn: int) -> DataFrame:
    """Each document with one centre: of the centres of its buckets in this turn that belong
    to other components, the one it meets most often.

    The first centre of a bucket is the member with the commonest shingles: of the copies of
    a text, the one that is nearest to all others.
    """
    if turn == 0:
        known = known.join(marks.select("id", (-F.col("common")).alias("by")), "id")
    else:
        known = known.withColumn("by", F.xxhash64("id", F.lit(turn)))
    centres = known.groupBy("band").agg(F.min(F.struct("by", "id", "component")).alias("centre"))
    centres = checkpointed(centres.select("band", F.col("centre.id").alias("b"), F.col("centre.component").alias("other")))
    met = known.join(centres, "band").where("component <> other").groupBy("id", "b").count()
    best = met.groupBy("id").agg(F.max_by("b", F.struct("count", "b")).alias("b"))
    return best.select(F.col("id").alias("a"), "b")


def _remaining_pairs(known: DataFrame, marks: DataFrame, like: Likeness) -> DataFrame:
    """All likely pairs of the documents in `known` whose components differ, each with one
    member outside the largest component of some bucket of it.

    Two sets with t shingles in common share one of their n - t + 1 rarest, so a document
    meets those alone that have a rare shingle of its own. What an edited copy has rarest
    are its edits; it doesn't meet the other copies through the text they all come from.
    """
    sizes = known.groupBy("band", "component").agg(F.count("*").alias("size"))
    largest = checkpointed(sizes.groupBy("band").agg(F.max_by("component", F.struct("size", "component")).alias("largest")))
    stray = known.join(largest, "band").where("component <> largest").select("id").distinct().withColumn("stray", F.lit(True))
    marked = known.select("id", "component").distinct().join(marks, "id").join(stray, "id", "left")
    rows = checkpointed(marked.select("id", "component", "n", "sketch", "stray", F.posexplode("rare").alias("place", "shingle")))
    left = rows.where("stray").select("shingle", F.col("id").alias("a"), *(F.col(c).alias(f"{c}_a") for c in ("n", "sketch", "component", "place")))
    right = rows.select("shingle", F.col("id").alias("b"), *(F.col(c).alias(f"{c}_b") for c in ("n", "sketch", "component", "place")))
    common = F.ceil((F.col("n_a") + F.col("n_b")) * like.percent / (100 + like.percent) - 1e-9)
    early = (F.col("place_a") <= F.col("n_a") - common) & (F.col("place_b") <= F.col("n_b") - common)
    return left.join(right, "shingle").where(F.expr("component_a <> component_b") & early & _alike(like)).select("a", "b")


def _followed(labels: DataFrame) -> DataFrame:
    """Labels (id, component) followed to the component of the component: between rounds it is
    enough to know some document that one is linked with in one or two steps."""
    over = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
    met = labels.join(over, "component", "left")
    return met.select("id", F.least("component", F.coalesce("further", "component")).alias("component"))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the document stands for its component)."""
    docs = texts(docs)
    found = checkpointed(profiles(docs, like))
    least = F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("least")
    originals = found.where("doc_id is not null and sequence is not null").groupBy("sequence").agg(least)
    originals = checkpointed(originals.select("sequence", F.col("least.doc_id").alias("id"), F.col("least.n_shingles").alias("n"), "least.bands", "least.sketch"))

    bands = originals.select(F.explode("bands").alias("band"), "id")
    shared = bands.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    members = checkpointed(bands.join(checkpointed(shared.select("band")), "band", "left_semi"))
    near = checkpointed(members.select("id").distinct())
    size = originals.join(near, "id", "left_semi").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).first()
    n_groups = max(1, -(-size["rows"] // DOCS_PER_GROUP), -(-(size["shingles"] or 0) // SHINGLES_PER_GROUP))
    full = checkpointed(sets(docs.join(near.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), like, n_groups))
    marks = checkpointed(originals.select("id", "sketch").join(full.select(F.col("doc_id").alias("id"), "n", "rare", "common"), "id"))

    links, labels = None, None
    for turn in range(CENTRE_ROUNDS + 1):
        known = checkpointed(_labelled(members, labels)) if labels is not None else _labelled(members, None)
        if turn and known.isEmpty():
            break
        pairs = _centre_pairs(known, marks, turn) if turn < CENTRE_ROUNDS else _remaining_pairs(known, marks, like)
        new = checkpointed(_links(pairs, marks, full, like))
        links = new if links is None else links.unionByName(new)
        if turn < CENTRE_ROUNDS:
            labels = checkpointed(_followed(links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))))
    labels = components(links)

    groups = originals.select("sequence", "id").join(labels, "id", "left")
    groups = checkpointed(groups.select("sequence", F.coalesce("component", "id").alias("component_id")))
    with_words = found.where("sequence is not null").join(groups, "sequence", "left")
    alone = found.where("sequence is null").withColumn("component_id", F.col("doc_id"))
    result = with_words.select("doc_id", "n_shingles", "component_id").unionByName(alone.select("doc_id", "n_shingles", "component_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of one document of each component, with all their columns. Rows with a null
    doc_id stay; the rows of one doc_id go or stay together."""
    found = near_duplicates(docs, like).where("doc_id is not null")
    gone = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept_")).where("not kept_").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
