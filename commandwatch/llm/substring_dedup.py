"""Operator 7: remove passages that an earlier document has, by relative Lempel-Ziv parsing.

The reference of a document is every document with a smaller doc_id. It is indexed by windows
of 13 words with the document and place where they stand first, in blocks: one block for each
range of hashes, each in a task of its own. A document is factored against all blocks from
left to right: a factor begins where the reference has the next 13 words, in its earliest
document, and grows word by word as long as the next window stands at the next place there.
Where it ends, or an earlier document takes over, the next window is looked up anew, also if
it lies across the boundary, so no copy is lost between two sources. Factors have 13 words at
least, so each is a duplicate span: its words go. Windows are told apart by 96 bits of two
independent hashes.

Documents are dealt by a hash into groups of bounded size. Three narrow exchanges stand
around the texts, which themselves are shuffled once:

1. Every window has an anchor, the least hash of a run of 5 words in it, so equal windows
   have equal anchors. Each group sends its distinct anchors; blocks answer those that more
   than one group has.
2. Each group sends its windows under such anchors, once, with the least doc_id it has for
   them and the place there; blocks answer the windows for which another group has a lesser one.
3. Each group parses its documents with the answers and its own windows.

A passage that very many documents share is sent once by a group, not once by a document.

Results: a null or empty text has no words and stays; so do texts of fewer than 13 words.
Rows with a null doc_id come after all others. Repeated rows of one doc_id don't remove each
other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .blocks import dealt, packed, shared_keys
from .spark_io import freed, freed_pair
from .words import mixed, runs, utf8, word_hashes

WINDOW, ANCHOR = 13, 5
DOCS_PER_GROUP, BYTES_PER_GROUP = 1_000, 32 << 20
LAST = np.iinfo(np.int64).max
FACTOR = ("start", "length", "source", "source_start")


def anchors(words: np.ndarray) -> np.ndarray:
    """The anchor of each window of a text."""
    short = runs(words, ANCHOR)
    width = WINDOW - ANCHOR + 1
    if len(short) < width:
        return np.zeros(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(short, width).min(1)


def _hashed(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """doc_id (null: the last) and word hashes of each text of a group."""
    for chunk in table.to_batches():
        ids = chunk.column("doc_id").to_pylist()
        for doc, text in zip(ids, chunk.column("text").to_pylist(), strict=True):
            yield LAST if doc is None else doc, word_hashes(utf8(text))


#: Where a window stands first, and further bits of its hash.
ENTRY = np.dtype([("doc", "<i8"), ("place", "<u4"), ("check", "<u4")])


def _entries(words: np.ndarray, doc: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and entry of each window of a document."""
    keys = runs(words, WINDOW)
    found = np.zeros(len(keys), ENTRY)
    found["doc"], found["place"] = doc, np.arange(len(keys))
    found["check"] = runs(mixed(words), WINDOW) & np.uint64(0xFFFFFFFF)
    return keys, found


def _least(windows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows, sorted, and the least entry of each; entries of a document in order."""
    keys = np.concatenate([x for x, _ in windows] or [np.zeros(0, np.uint64)])
    entries = np.concatenate([x for _, x in windows] or [np.zeros(0, ENTRY)])
    order = np.lexsort((entries["doc"], entries["check"], keys))
    keys, entries = keys[order], entries[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (entries["check"][1:] != entries["check"][:-1])
    return keys[first], entries[first]


def _places(keys: np.ndarray, entries: np.ndarray, known: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where each window stands among the known ones, which have them all."""
    at = np.searchsorted(known, keys)
    while len(other := np.flatnonzero(firsts["check"][at] != entries["check"])):
        at[other] += 1  # another window with the same first hash
    return at


def _sent_anchors(n_blocks: int):
    def work(table: pa.Table) -> pa.Table:
        found = [np.unique(anchors(words)) for _, words in _hashed(table)]
        keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        return dealt(keys, None, table.column("group")[0].as_py(), n_blocks)

    return work


def _sent_windows(n_blocks: int):
    def work(docs: pa.Table, answers: pa.Table) -> pa.Table:
        shared = np.sort(packed(answers, "keys", np.uint64))
        windows = []
        for doc, words in _hashed(docs) if len(shared) else ():
            marks = anchors(words)
            at = np.minimum(np.searchsorted(shared, marks), len(shared) - 1)
            wanted = shared[at] == marks
            if wanted.any():
                keys, entries = _entries(words, doc)
                windows.append((keys[wanted], entries[wanted]))
        group = docs.column("group")[0].as_py() if len(docs) else 0
        return dealt(*_least(windows), group, n_blocks)

    return work


def _lesser_owners(table: pa.Table) -> pa.Table:
    """For each group, its windows that another group has from a lesser document."""
    keys, entries = packed(table, "keys", np.uint64), packed(table, "values", ENTRY)
    sizes = [len(x) // 8 for x in table.column("keys").to_pylist()]
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((entries["doc"], entries["check"], keys))
    ordered, checks = keys[order], entries["check"][order]
    new = np.ones(len(keys), bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (checks[1:] != checks[:-1])
    least = np.empty(len(keys), ENTRY)
    least[order] = entries[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    lesser = least["doc"] < entries["doc"]
    keys, least, row = keys[lesser], least[lesser], row[lesser]
    numbers, starts = np.unique(row, return_index=True)
    groups = table.column("group").to_pylist()
    split = lambda x: [p.tobytes() for p in np.split(x, starts[1:])] if len(numbers) else []
    columns = [pa.array([groups[i] for i in numbers], pa.int64()), pa.array(split(keys), pa.binary()), pa.array(split(least), pa.binary())]
    return pa.table(columns, ["group", "keys", "values"])


def parsed(found: np.ndarray, doc: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The factors of a document, from the least entries of its windows: first and last window
    of each, and the entry that it begins with. A factor goes on while the next window is at
    the next place of its source."""
    copied = found["doc"] < doc
    on = copied[1:] & copied[:-1] & (found["doc"][1:] == found["doc"][:-1]) & (found["place"][1:] == found["place"][:-1] + 1)
    starts = copied.copy()
    starts[1:] &= ~on
    ends = copied.copy()
    ends[:-1] &= ~on
    return np.flatnonzero(starts), np.flatnonzero(ends), found[starts]


def covered(n_words: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The words of a text that lie in factors."""
    change = np.zeros(n_words + 1, np.int64)
    change[starts] += 1
    change[ends + WINDOW] -= 1
    return np.cumsum(change)[:-1] > 0


def _parse(docs: pa.Table, answers: pa.Table) -> pa.Table:
    hashed = list(_hashed(docs))
    windows = [_entries(words, doc) for doc, words in hashed]
    known, firsts = _least(windows)
    lesser, entries = packed(answers, "keys", np.uint64), packed(answers, "values", ENTRY)
    at = _places(lesser, entries, known, firsts)
    earlier = entries["doc"] < firsts["doc"][at]
    firsts[at[earlier]] = entries[earlier]
    rows: dict[str, list] = {"n_words": [], "n_removed": [], "n_factors": []}
    kept, factors = [], []
    for text, (doc, words), own in zip(docs.column("text").to_pylist(), hashed, windows, strict=True):
        found = utf8(text).split()
        starts, ends, sources = parsed(firsts[_places(*own, known, firsts)], doc)
        gone = covered(len(words), starts, ends)
        for column, value in zip(rows, (len(words), int(gone.sum()), len(starts)), strict=True):
            rows[column].append(value)
        kept.append(b" ".join(compress(found, ~gone) if len(starts) else found).decode())
        sizes = (ends - starts + WINDOW).tolist()
        parts = zip(starts.tolist(), sizes, sources["doc"].tolist(), sources["place"].tolist(), strict=True)
        factors.append([dict(zip(("start", "length", "source", "source_start"), x, strict=True)) for x in parts])
    result = docs.select(["row"])
    for name, values in rows.items():
        result = result.append_column(name, pa.array(values, pa.int64()))
    result = result.append_column("kept_text", pa.array(kept, pa.string()))
    return result.append_column("factors", pa.array(factors, pa.list_(pa.struct([(c, pa.int64()) for c in FACTOR]))))


def without_repeats(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns of every row as struct `row`, n_words, n_removed, n_factors, kept_text
    (the words left, joined by one space) and the factors: start and length in words, and the
    doc_id and place of their source."""
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_groups = max(1, -(-size["rows"] // DOCS_PER_GROUP), -(-(size["bytes"] or 0) // BYTES_PER_GROUP))
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)).alias("group")
    grouped = docs.select(group, "doc_id", "text", F.struct(*columns).alias("row"))
    by_group = grouped.groupBy("group")
    keys = "block bigint, group bigint, keys binary"
    sent = by_group.applyInArrow(freed(_sent_anchors(n_groups)), keys)
    shared = sent.groupBy("block").applyInArrow(freed(shared_keys), "group bigint, keys binary")
    windows = by_group.cogroup(shared.groupBy("group")).applyInArrow(freed_pair(_sent_windows(n_groups)), f"{keys}, values binary")
    lesser = windows.groupBy("block").applyInArrow(freed(_lesser_owners), "group bigint, keys binary, values binary")
    added = [StructField(c, LongType()) for c in ("n_words", "n_removed", "n_factors")]
    factor = ArrayType(StructType([StructField(c, LongType()) for c in FACTOR]))
    schema = StructType([grouped.schema["row"], *added, StructField("kept_text", StringType()), StructField("factors", factor)])
    return by_group.cogroup(lesser.groupBy("group")).applyInArrow(freed_pair(_parse), schema)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Number of words, of removed words, and digest of what is left of every text."""
    found = without_repeats(docs, "doc_id")
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "n_factors")


def unrepeated(docs: DataFrame) -> DataFrame:
    """All columns of the rows; a text that loses words becomes its words joined by a space."""
    found = without_repeats(docs, *docs.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    return found.select(*(text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def factors(docs: DataFrame) -> DataFrame:
    """doc_id and every factor of its text: start, length, source, source_start."""
    found = without_repeats(docs, "doc_id")
    return found.select("row.doc_id", F.explode("factors").alias("factor")).select("doc_id", "factor.*")
