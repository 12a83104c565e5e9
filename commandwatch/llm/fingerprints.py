"""Operator 4: document fingerprints by winnowing, with Spark's own functions alone.

White space counts as one space. A place is the start of a word, and in words longer than 4
characters every offset with 4 characters left, so that places don't depend on what stands
before. From every place 3 units are read, each what is left of its word but 4 characters at
most, and hashed with the spaces between them; of every 5 neighbouring hashes the least is
chosen, the rightmost of equal ones. Two texts that share 32 characters in a row, spaces not
counted, therefore share a chosen hash. Positions, the numbers of the places, are kept with
the hashes. Hash and position travel as one number, hash first and position counted
downwards, so that the least number is the rightmost least hash.

The next document by doc_id is found without an order over all rows: documents are dealt
into buckets of 512 consecutive ids, a window finds the next one inside a bucket, and the
first document of each bucket is copied to the end of the bucket before it. Which bucket
comes before is found in the same way over the buckets, level by level.

Results: a null or empty text, or one of white space, has an empty fingerprint; two empty
fingerprints are alike (1.0), an empty one is unlike any other (0.0). A text of fewer than 3
units has one hash, of its whole. Rows with a null doc_id come first; repeated rows of one doc_id follow
each other by text. A single row is its own next document. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNITS = r"\S{1,4}+ ?+\S{1,4}+ ?+\S{1,4}+"
PLACE = rf"(?:(?<!\S)|(?=\S{{4}}))(?=({UNITS}))\S"
WINDOW = 5
BUCKET_BITS = 9
TOP = 4_096  # so many neighbouring buckets at most are put in order by one task
_LAST_PLACE = (1 << 31) - 1
_NO_ID = -(1 << 63)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The chosen hashes of a text with their positions, in the order of the text."""

    def hashes(runs: Column) -> Column:
        def at(run: Column, i: Column) -> Column:
            return F.shiftleft(F.shiftrightunsigned(F.xxhash64(run), 32), 31).bitwiseOR((F.lit(_LAST_PLACE) - i).cast("bigint"))

        return F.transform(runs, at)

    def chosen(found: Column) -> Column:
        windows = F.greatest(F.size(found) - (WINDOW - 1), F.least(F.size(found), F.lit(1)))

        def least(x: Column, i: Column) -> Column:
            return F.least(x, *(F.get(found, i + k) for k in range(1, WINDOW)))

        return F.array_distinct(F.transform(F.slice(found, F.lit(1), windows), least))

    def runs(plain: Column) -> Column:
        found = F.regexp_extract_all(plain, F.lit(PLACE), 1)
        return _bound(found, lambda x: F.when((F.size(x) > 0) | (plain == ""), x).otherwise(F.array(plain)))

    plain = F.trim(F.regexp_replace(text, r"\s+", " "))
    return _bound(_bound(_bound(plain, runs), hashes), chosen)


def written(found: Column) -> Column:
    """A fingerprint as text: hash and position (number of the place, from 0) of every choice."""

    def one(x: Column) -> Column:
        return F.concat(F.lower(F.hex(F.shiftright(x, 31))), F.lit(":"), F.lit(_LAST_PLACE) - x.bitwiseAND(F.lit(_LAST_PLACE)))

    return F.array_join(F.transform(found, one), " ")


def hashes_of(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda x: F.shiftright(x, 31)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of two sets that both have."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def _before(keys: DataFrame, low: int, high: int) -> DataFrame:
    """(key, before) of distinct keys between low and high; the last comes before the first."""
    if high - low < TOP:
        all_keys = Window.partitionBy(F.lit(0))
        before = F.coalesce(F.lag("key").over(all_keys.orderBy("key")), F.max("key").over(all_keys))
        return keys.select("key", before.alias("before"))
    group = F.shiftright("key", BUCKET_BITS)
    inside = keys.select("key", group.alias("group"), F.lag("key").over(Window.partitionBy(group).orderBy("key")).alias("before"))
    lasts = keys.groupBy(group.alias("key")).agg(F.max("key").alias("last"))
    groups = _before(lasts.select("key"), low >> BUCKET_BITS, high >> BUCKET_BITS)
    ends = groups.join(lasts.withColumnRenamed("key", "before"), "before").select(F.col("key").alias("group"), "last")
    met = inside.join(ends, "group")
    return met.select("key", F.coalesce("before", "last").alias("before"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and fingerprint of every row and of the next row by doc_id."""
    rows = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    low, high = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id")).agg(F.min("id"), F.max("id")).first()
    bucket = F.shiftright("id", BUCKET_BITS)
    rows = rows.withColumn("bucket", bucket)
    keys = docs.select(F.shiftright(F.coalesce("doc_id", F.lit(_NO_ID)), BUCKET_BITS).alias("key")).distinct()
    before = _before(keys, (low or 0) >> BUCKET_BITS, (high or 0) >> BUCKET_BITS)
    heads = rows.groupBy("bucket").agg(F.min(F.struct("id", "text")).alias("head"))
    guests = heads.join(before, heads.bucket == before.key).select("head.id", F.lit(None).cast("bigint").alias("doc_id"), "head.text", F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    together = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    in_order = Window.partitionBy("bucket").orderBy("guest", "id", "text")
    found = together.withColumn("next_text", F.lead("text").over(in_order)).withColumn("found", fingerprint(F.col("text")))
    found = found.withColumn("next_found", F.lead("found").over(in_order))
    return found.where(~F.col("guest")).select("doc_id", "text", "next_text", "found", "next_found")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    size = F.length("text")
    cut = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    found = with_next(docs).withColumn("edited", edited)
    found = found.withColumn("edited_found", fingerprint(F.col("edited")))
    found = found.select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("found")).alias("fingerprint"),
        written(F.col("edited_found")).alias("edited_fingerprint"),
        hashes_of(F.col("found")).alias("own"),
        hashes_of(F.col("edited_found")).alias("edited"),
        hashes_of(F.col("next_found")).alias("next"),
    )
    near_edited, near_next = likeness(F.col("own"), F.col("edited")), likeness(F.col("own"), F.col("next"))
    return found.withColumn("near_edited", near_edited).withColumn("near_next", near_next).drop("own", "edited", "next")
