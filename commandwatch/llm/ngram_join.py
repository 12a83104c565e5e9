"""Operator 13: documents joined by the Jaccard similarity of their n-grams, on prefix trees.

1. Every text becomes the set of its n-grams (A-Z lowered; the whole sequence if it has fewer
   words). Equal sets collapse to the least doc_id.
2. Documents without a partner go. Of two linked sets the least hashes share some (`Bounds`),
   so a document stays only if enough of its least hashes occur in another one; they are
   counted in blocks of the hash range. Of those that stay, all n-grams are counted. An
   n-gram that one document alone has is dropped, and so are documents left with too few.
3. N-grams are ordered by the number of documents, the same order for all. The rarest of a
   set, as many as a partner can't do without, are its entry points ("probe", and fewer of
   them, "index", towards partners that are as large or larger): linked sets meet in one.
4. Sets are stored in prefix trees, commonest n-grams first, one tree for a cell of documents.
   A probe walks a tree: what it has in common with a path is counted once for all sets below,
   and a subtree is left as soon as the n-grams that remain on either side can't reach the
   similarity any more.
5. Cells: two rounds in which a document meets the most central of the documents at its entry
   points that it shares most of them with, so that copies of one text don't meet one another;
   then, exactly, all that lie outside the largest component at an entry point meet the cells
   of the other components there. A cell tells one link for each probe and component, and
   large-star and small-star contract the links.

Cells and blocks have a bounded number of n-grams (one larger set is alone); an entry in a
block stands for a batch of documents, not for one. The ids that stay are broadcast only up
to `MAX_BROADCAST_IDS` rows, beyond that they are joined by a shuffle.

Results: a null or empty text, or one without words, has no n-grams and is linked with
nothing. Rows are resolved one by one, each by its own text, and sets with the same least
doc_id count as one document. Rows with a null doc_id link nothing; they follow the documents
with an equal set, without any their component is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import dealt, packed, summed_keys
from .components import components
from .spark_io import checkpointed, each_batch, encoded, freed, freed_pair, texts
from .words import runs, word_hashes

NGRAMS_PER_BLOCK = 2_000_000
#: So many blocks at least that most hashes of a document are alone in theirs: what the blocks
#: answer is then a row for each hash in common, at any size of the input.
LEAST_BLOCKS = 256
NGRAMS_PER_GROUP = 1_000_000
NGRAMS_PER_CELL = 250_000
MAX_BROADCAST_IDS = 1_000_000
ROUNDS = 2
STEP = 2_048


@dataclass(frozen=True)
class Bounds:
    """Words in an n-gram, percent of n-grams in common, and what follows for a set's size."""

    words: int = 5
    percent: int = 80
    #: Percent of a set that is looked at beyond what is needed to find one n-gram in common.
    more: int = 6

    def least_common(self, n: int) -> int:
        """N-grams that a set has in common with any partner, at least; also its least size."""
        return -(-self.percent * n // 100)

    def probe(self, n: int) -> int:
        """Of so many in a common order, one is a partner's too."""
        return n - self.least_common(n) + 1

    def sampled(self, n: int) -> int:
        return min(n, self.probe(n) + n * self.more // 100)

    def sampled_common(self, n: int) -> int:
        """So many of the sampled n-grams are also among a partner's, whatever its size."""
        least = self.least_common(n)
        return min(least * self.more // 100 + 1, self.least_common(least))

    def common(self, n: int, m: int) -> int:
        """N-grams that sets of these sizes need in common."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def index(self, n: int) -> int:
        """As `probe`, for partners of the same size or larger, which look with `probe`."""
        return n - self.common(n, n) + 1


def ngrams(data: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams."""
    words = word_hashes(data.lower())  # bytes: A-Z only
    return np.unique(runs(words, min(size, len(words)))) if len(words) else words


def digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def profiles(docs: DataFrame, like: Bounds) -> DataFrame:
    """Size and digest of the n-grams of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [ngrams(data, like.words) for data in encoded(batch)]
        columns = [pa.array([len(x) for x in found], pa.int64()), pa.array([digest(x) for x in found], pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "digest"])

    return each_batch(docs, work, "doc_id bigint, n bigint, digest binary")


# Documents that can have a partner ---------------------------------------------------------


def _split(values: np.ndarray, blocks: np.ndarray, n_blocks: int) -> list[bytes]:
    """Packed values for each block; the blocks rise."""
    return [part.tobytes() for part in np.split(values, np.searchsorted(blocks, np.arange(1, n_blocks)))]


def partnered(docs: DataFrame, like: Bounds, n_blocks: int) -> DataFrame:
    """(doc_id, shared): how many of a document's least hashes another document has, too.

    A batch sends each hash once, with its owner if only one of its documents has it; what
    several of them share needs no answer. Within a block 32 bits tell hashes apart; two that
    agree by chance keep a document, which later steps look at in full.
    """

    def sent(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, parts = [], []
        for doc, data in zip(batch.column("doc_id").to_pylist(), encoded(batch), strict=True):
            found = ngrams(data, like.words)
            if doc is not None and len(found):
                ids.append(doc)
                parts.append(found[: like.sampled(len(found))])
        if not ids:
            return pa.RecordBatch.from_pylist([], schema)
        own = np.array(ids, np.int64)
        keys, owners = np.concatenate(parts), np.repeat(np.arange(len(ids)), [len(x) for x in parts])
        block = (keys >> np.uint64(32)) % np.uint64(n_blocks)
        order = np.lexsort((keys, block))
        keys, owners, block = keys[order], owners[order], block[order]
        new = np.append(True, keys[1:] != keys[:-1])
        many = ~new | np.append(~new[1:], False)
        local, lone = np.bincount(owners[many], minlength=len(ids)), ~many
        short = keys.astype(np.uint32)
        columns = {
            "block": pa.array(range(n_blocks), pa.int64()),
            "lone": pa.array(_split(short[lone], block[lone], n_blocks), pa.binary()),
            "owners": pa.array(_split(own[owners[lone]], block[lone], n_blocks), pa.binary()),
            "many": pa.array(_split(short[many & new], block[many & new], n_blocks), pa.binary()),
            # One row of the batch also has what the batch knows by itself.
            "ids": pa.array([own[local > 0].tobytes(), *[b""] * (n_blocks - 1)], pa.binary()),
            "known": pa.array([local[local > 0].astype(np.int64).tobytes(), *[b""] * (n_blocks - 1)], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), schema=schema)

    def counted(table: pa.Table) -> pa.Table:
        lone, owners = packed(table, "lone", np.uint32), packed(table, "owners", np.int64)
        _, which, times = np.unique(np.concatenate([lone, packed(table, "many", np.uint32)]), return_inverse=True, return_counts=True)
        ids, shared = np.unique(owners[times[which[: len(lone)]] > 1], return_counts=True)
        ids, shared = np.append(ids, packed(table, "ids", np.int64)), np.append(shared, packed(table, "known", np.int64))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "shared": pa.array(shared, pa.int64())})

    names = ("lone", "owners", "many", "ids", "known")
    schema = pa.schema([("block", pa.int64()), *((name, pa.binary()) for name in names)])
    rows = each_batch(docs, sent, "block bigint, " + ", ".join(f"{name} binary" for name in names))
    by_block = rows.groupBy("block").applyInArrow(freed(counted), "doc_id bigint, shared bigint")
    return by_block.groupBy("doc_id").agg(F.sum("shared").alias("shared"))


def stored(docs: DataFrame, near: DataFrame, like: Bounds, n_groups: int) -> DataFrame:
    """id, n, `lone` (n-grams that no other of these has), the path (the others, commonest
    first), and the entry points with their places, the rarest first.

    Groups of documents send each n-gram and its number of documents once to the blocks of an
    index, which sum up those that more than one group has. Documents that have too few in
    common with all others together are left out.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: dict[tuple[int, bytes], bytes] = {}
        wanted = batch.column("digest").to_pylist()
        for doc, data, one in zip(batch.column("doc_id").to_pylist(), encoded(batch), wanted, strict=True):
            found = ngrams(data, like.words)
            if digest(found) == one:
                rows[doc, one] = found.tobytes()
        columns = [pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1] for k in rows], pa.binary()), pa.array(rows.values(), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "digest", "ngrams"])

    def distinct(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
        rows = dict(zip(zip(table.column("id").to_pylist(), table.column("digest").to_pylist(), strict=True), table.column("ngrams").to_pylist(), strict=True))
        return [k[0] for k in rows], [np.frombuffer(x, np.uint64) for x in rows.values()]

    def sent(table: pa.Table) -> pa.Table:
        keys, times = np.unique(np.concatenate(distinct(table)[1]), return_counts=True)
        return dealt(keys, times.astype(np.uint32), table.column("group")[0].as_py(), n_groups)

    def ranked(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, found = distinct(table)
        keys, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        times[np.searchsorted(keys, packed(answers, "keys", np.uint64))] = packed(answers, "values", np.uint32)
        rows = []
        for doc, own in zip(ids, found, strict=True):
            n, docs_with = len(own), times[np.searchsorted(keys, own)]
            order = np.lexsort((own, docs_with))
            lone = int((docs_with == 1).sum())
            if n - lone >= like.least_common(n):
                entries = order[lone : like.probe(n)]
                rows.append((doc, n, lone, own[order[lone:][::-1]].tobytes(), own[entries].view(np.int64), np.arange(lone, lone + len(entries), dtype=np.int32)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["id", "n", "lone", "path", "entries", "places"])

    wanted = near.select(F.col("id").alias("doc_id"), "digest")
    if near.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = each_batch(docs.join(wanted, "doc_id"), work, "id bigint, digest binary, ngrams binary")
    by_group = sets.withColumn("group", F.pmod(F.xxhash64("id", "digest"), F.lit(n_groups))).groupBy("group")
    entries = "keys binary, values binary"
    known = by_group.applyInArrow(freed(sent), f"block bigint, group bigint, {entries}")
    answers = known.groupBy("block").applyInArrow(freed(summed_keys), f"group bigint, {entries}")
    schema = "id bigint, n bigint, lone bigint, path binary, entries array<bigint>, places array<int>"
    return by_group.cogroup(answers.groupBy("group")).applyInArrow(freed_pair(ranked), schema)


# Prefix trees ------------------------------------------------------------------------------


class PrefixTree:
    """Sets of n-grams in one order as the paths of a tree.

    The paths lie in the order of the tree's leaves; a path begins with the part that it has in
    common with the one before it, so that every branch is stored and counted once.
    """

    def __init__(self, rows: list[tuple[int, int, int, bytes]]):
        """Rows are (id, component, size of the whole set, path)."""
        paths = [np.frombuffer(row[3], np.uint64) for row in rows]
        order = sorted(range(len(rows)), key=lambda i: paths[i].astype(">u8").tobytes())
        self.leaves = [(rows[i][0], rows[i][1], rows[i][2], paths[i]) for i in order]
        self.branch_at = [0] * len(order)
        for k in range(1, len(order)):
            one, two = self.leaves[k - 1][3], self.leaves[k][3]
            size = min(len(one), len(two))
            differing = np.flatnonzero(one[:size] != two[:size])
            self.branch_at[k] = int(differing[0]) if len(differing) else size

    def partners(self, own: int, component: int, n: int, path: np.ndarray, like: Bounds) -> list[int]:
        """Of each other component, one set that is similar enough to a probe, if there is any."""
        by_hash = np.argsort(path)
        hashes = path[by_hash]
        found, done = [], {component}
        deepest = max((len(leaf[3]) for leaf in self.leaves), default=0)
        common = np.zeros(deepest + 1, np.int64)  # with the first d n-grams of the path walked
        left = np.full(deepest + 1, len(path), np.int64)  # of the probe's, behind the last in common
        walked = 0  # so far are the two counts those of the path of this leaf
        for (doc, of, m, other), branch in zip(self.leaves, self.branch_at, strict=True):
            walked = min(walked, branch)
            if of in done or doc == own or like.percent * max(n, m) > 100 * min(n, m):
                continue
            needed = like.common(n, m)
            # Where the subtree was left before, the bound may fail for this leaf at once.
            while walked < len(other) and common[walked] + min(len(other) - walked, left[walked]) >= needed:
                part = other[walked : walked + STEP]
                places = np.minimum(np.searchsorted(hashes, part), len(hashes) - 1)
                hit = hashes[places] == part
                behind = np.where(hit, len(path) - 1 - by_hash[places], len(path))
                end = walked + len(part)
                common[walked + 1 : end + 1] = common[walked] + np.cumsum(hit)
                left[walked + 1 : end + 1] = np.minimum(np.minimum.accumulate(behind), left[walked])
                walked = end
            if walked >= len(other) and common[len(other)] >= needed:
                found.append(doc)
                done.add(of)
        return found


def met(members: DataFrame, probes: DataFrame, full: DataFrame, like: Bounds) -> DataFrame:
    """Links (a, b) between the probes (cell, id, component) of a cell and its members."""

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = ("id", "component", "n", "path")
        tree = PrefixTree(list(zip(*(left.column(c).to_pylist() for c in columns), strict=True)))
        found = []
        for doc, component, n, path in zip(*(right.column(c).to_pylist() for c in columns), strict=True):
            found += [(doc, other) for other in tree.partners(doc, component, n, np.frombuffer(path, np.uint64), like)]
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    paths = full.select("id", "n", "path")
    # Aliases make the columns of the two sides differ where one is made from the other.
    names = [F.col(c).alias(c) for c in ("cell", "id", "component", "n", "path")]
    rows = [side.join(paths, "id").select(*names).groupBy("cell") for side in (members, probes)]
    return rows[0].cogroup(rows[1]).applyInArrow(walk, "a bigint, b bigint")


# Cells -------------------------------------------------------------------------------------


def _active(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The entry points where more than one component meets, with the component of each row."""
    if labels is None:
        known = entries.withColumn("component", F.col("id"))
    else:
        known = checkpointed(entries.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")))
    ends = (F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("index").alias("any"))
    mixed = known.groupBy("ngram").agg(*ends).where("low < high and any").select("ngram")
    return checkpointed(known.join(checkpointed(mixed), "ngram", "left_semi"))


def _slices(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, id, n, ...) with a cell of a bounded number of n-grams for each key."""
    sizes = checkpointed(rows.groupBy(key).agg(F.ceil(F.sum("n") / NGRAMS_PER_CELL).alias("slices")))
    slice_ = F.pmod(F.xxhash64("id"), F.col("slices"))
    return rows.join(sizes, key).withColumn("cell", F.xxhash64(key, slice_)).drop("slices")


def _by_centre(known: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Each document in a cell of one centre: of the centres of its entry points that belong to
    other components, the one it meets most often. The centres are the probes.

    The first centre of an entry point is the document with the least share of n-grams of its
    own: of the copies of a text, the one that is nearest to all others.
    """
    by = F.col("lone") / F.col("n") if turn == 0 else F.xxhash64("id", F.lit(turn))
    first = F.min(F.struct(by.alias("by"), "id", "component")).alias("first")
    centres = checkpointed(known.where("index").groupBy("ngram").agg(first))
    centres = centres.select("ngram", F.col("first.id").alias("centre"), F.col("first.component").alias("other"))
    times = known.join(centres, "ngram").where("component <> other").groupBy("id", "component", "n", "centre", "other").count()
    best = times.groupBy("id", "component", "n").agg(F.max_by(F.struct("centre", "other"), F.struct("count", "centre")).alias("best"))
    members = checkpointed(_slices(best.select("id", "component", "n", "best.*"), "centre"))
    probes = members.select("cell", F.col("centre").alias("id"), F.col("other").alias("component")).distinct()
    return members.select("cell", "id", "component"), probes


def _remaining(known: DataFrame, like: Bounds) -> tuple[DataFrame, DataFrame]:
    """Every document outside the largest component of an entry point as a probe for the cells
    of the other components there, unless sizes and places rule all of a cell out."""
    sizes = known.groupBy("ngram", "component").agg(F.count("*").alias("size"))
    largest = checkpointed(sizes.groupBy("ngram").agg(F.max_by("component", F.struct("size", "component")).alias("largest")))
    stray = known.join(largest, "ngram").where("component <> largest").select("id").distinct()
    stray = checkpointed(stray)
    cells = checkpointed(_slices(known.select("id", "component", "n").distinct(), "component"))
    at = known.select("ngram", "id", "place", "index", "n", "component").join(cells.select("id", "cell"), "id")
    at = at.groupBy("ngram", "cell", "component").agg(
        F.min("place").alias("least_place"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.bool_or("index").alias("any")
    )
    probes = known.join(stray, "id", "left_semi").select("ngram", "id", "place", "index", "n", F.col("component").alias("own"))
    percent = F.lit(like.percent)
    sizes_fit = (100 * F.col("most_n") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("least_n"))
    needed = percent * (F.col("n") + F.col("least_n"))
    most = F.least(F.col("n") - F.col("place"), F.col("most_n") - F.col("least_place"))
    may = F.expr("own <> component") & (F.col("index") | F.col("any")) & sizes_fit & ((100 + percent) * most >= needed)
    pairs = probes.join(at, "ngram").where(may).select("cell", "id", F.col("own").alias("component")).distinct()
    # Many probes for one cell are dealt over copies of it.
    many = checkpointed(pairs.join(known.select("id", "n").distinct(), "id"))
    copies = checkpointed(many.groupBy("cell").agg(F.ceil(F.sum("n") / (8 * NGRAMS_PER_CELL)).alias("copies")))
    spread = lambda copy: F.xxhash64("cell", copy).alias("cell")
    dealt_probes = many.join(copies, "cell").select(spread(F.pmod(F.xxhash64("id"), F.col("copies"))), "id", "component")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    members = cells.join(copies, "cell").select("cell", "id", "component", each).select(spread(F.col("copy")), "id", "component")
    return members, dealt_probes


def _followed(labels: DataFrame) -> DataFrame:
    """Labels (id, component) followed to the component of the component.

    Between rounds it is enough to know some document that one is linked with in one or two
    steps; whatever is contracted too little is only looked at once more.
    """
    over = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
    met_ = labels.join(over, "component", "left")
    return met_.select("id", F.least("component", F.coalesce("further", "component")).alias("component"))


def joined(docs: DataFrame, like: Bounds = Bounds()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    docs = texts(docs)
    found = checkpointed(profiles(docs, like))
    originals = found.where("doc_id is not null and n > 0").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"))
    originals = checkpointed(originals)

    total = found.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(LEAST_BLOCKS, -(-like.sampled(total) // NGRAMS_PER_BLOCK))
    shared = partnered(docs, like, n_blocks).withColumnRenamed("doc_id", "id")
    least = F.ceil(F.col("n") * like.percent / 100 - 1e-9)
    enough = F.least(F.floor(least * like.more / 100 + 1e-9) + 1, F.ceil(least * like.percent / 100 - 1e-9))
    near = checkpointed(originals.join(shared, "id").where(F.col("shared") >= enough).select("id", "digest", "n"))
    n_groups = max(1, -(-(near.agg(F.sum("n")).first()[0] or 0) // NGRAMS_PER_GROUP))
    full = checkpointed(stored(docs, near, like, n_groups))

    each = F.explode(F.arrays_zip("entries", "places")).alias("at")
    entries = full.select("id", "n", "lone", each).select("id", "n", "lone", F.col("at.entries").alias("ngram"), F.col("at.places").alias("place"))
    index = F.col("n") - F.ceil(2 * like.percent * F.col("n") / (100 + like.percent) - 1e-9) + 1
    entries = checkpointed(entries.withColumn("index", F.col("place") < index))

    links, labels = None, None
    for turn in range(ROUNDS):
        known = _active(entries, labels)
        if known.isEmpty():
            break
        new = checkpointed(met(*_by_centre(known, turn), full, like))
        links = new if links is None else links.unionByName(new)
        labels = checkpointed(_followed(links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))))
    known = _active(entries, labels)
    if not known.isEmpty():
        new = met(*_remaining(known, like), full, like)
        links = new if links is None else links.unionByName(new)
    labels = None if links is None else components(links)

    groups = originals.select("digest", "id")
    if labels is not None:
        groups = groups.join(labels, "id", "left")
    else:
        groups = groups.withColumn("component", F.col("id"))
    groups = checkpointed(groups.select("digest", F.coalesce("component", "id").alias("component_id")))
    size: Column = F.col("n").alias("n_shingles")
    linked = found.where("n > 0").join(groups, "digest", "left").select("doc_id", size, "component_id")
    return linked.unionByName(found.where("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id")))
