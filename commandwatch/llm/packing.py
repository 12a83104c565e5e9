"""Operator 9: pack token sequences by online best fit with a bounded number of open bins.

Every document is encoded and closed with an end id; only documents longer than a sequence
are cut, into full pieces and one shorter last piece. The pieces are dealt over tasks by a
hash, a fixed number of documents to a task, and each task packs its pieces in one pass: a
piece goes into the open bin with the least free space that holds it, found in a bitset with
one bit for each amount of free space. If too many bins are open, the fullest closes. A task
holds the open bins and nothing else.

A task takes its pieces in waves of some thousand, each from long to short: best fit wastes
least on falling lengths, and a wave is short enough for all of its bins to stay open. Waves
and order come from a hash of the piece, so a task that runs again gives the same sequences.

Results: a null or empty text is one piece that holds the end id alone; repeated rows are
packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .spark_io import each_batch, texts

SEQUENCE = 2048
OPEN_BINS = 4096
DOCS_PER_TASK = 40_000
DOCS_PER_WAVE = 4_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class BestFit:
    """Open bins by free space; `put` gives the bin's number and the place in it."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.spaces = 0  # bit f: some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.n_bins = 0

    def put(self, length: int) -> tuple[int, int]:
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.n_bins
            self.n_bins += 1
        if left := free - length:
            if self.n_open >= self.most_open:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            self.bins[left].append(number)
            self.spaces |= 1 << left
            self.n_open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.spaces &= ~(1 << free)
        self.n_open -= 1
        return number


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """The pieces of every document: place among its ids, length, checksum."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
        for place, packed in encoder(path).encoded(batch.column("text").to_pylist()):
            found[place].append(packed)
        rows: list[tuple[int, int, int, int, int]] = []
        for doc, parts in zip(batch.column("doc_id").to_pylist(), found, strict=True):
            ids = b"".join([*parts, end_id.to_bytes(4, "little")])
            for k, at in enumerate(range(0, len(ids), 4 * sequence)):
                part = ids[at : at + 4 * sequence]
                rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
        columns = zip(*rows, strict=True)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return each_batch(texts(docs), work, PIECES)


def pack(found: DataFrame, n_tasks: int, n_waves: int = 1, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add sequence_id and offset to rows with a length of 1 to `sequence`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        bins = BestFit(sequence, open_bins)
        for batch in batches:
            places = np.array([bins.put(n) for n in batch.column("length").to_pylist()], np.int64).reshape(-1, 2)
            columns = [*batch.columns, pa.array(places[:, 0] + first), pa.array(places[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "sequence_id", "offset"])

    names = found.columns
    schema = ", ".join(f"`{name}` {kind}" for name, kind in found.dtypes)
    # Rows of equal order are equal, so that any of them may come first.
    order = F.xxhash64(*(F.col(c) for c in names))
    dealt = found.withColumn("order_", order).repartition(n_tasks, "order_")
    wave = F.pmod(F.shiftright("order_", 20), F.lit(n_waves))
    in_order = dealt.sortWithinPartitions(wave, F.desc("length"), "order_")
    return in_order.select(names).mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, docs_per_task: int = DOCS_PER_TASK, docs_per_wave: int = DOCS_PER_WAVE) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    n_docs = docs.count()
    n_tasks = max(1, -(-n_docs // docs_per_task))
    return pack(pieces(docs, path), n_tasks, max(1, -(-n_docs // (n_tasks * docs_per_wave))))
