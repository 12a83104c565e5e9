"""Kneser-Ney models of two classes, counted over any number of labelled texts.

`measured` makes of texts what `toxicity._counted` and `KneserNey.evidence` make of texts in
memory, for the model of all labelled texts and for three more, each without one fold of them,
as Spark jobs:

1. `chunked` writes all texts once, as chunks of a bounded number of words: their distinct
   words, and numbers for these.
2. A chunk sends its distinct pairs of words, each with the distinct words before it in
   labelled texts and the classes and folds that have them, to blocks of an index by the hash of
   the pair. A block counts each pair for each class and model, and answers with that.
3. Of each pair one chunk takes part in the sums by word (continuations, contexts). Chunks send
   these to blocks by the hash of the word, which add them up and answer all chunks.
4. Only sums go to the driver: numbers of counts of 1, 2, 3 and 4, from which the discounts
   are estimated. Then each chunk has all that the log ratios of its words need.

No task has more than a block or a chunk, packed, and what it unpacks of these at once; all
counts are kept. The jobs run in SLICES, each for
some of the blocks or chunks, and remove their shuffle files, so that the disk holds the chunks,
the answers, and what one slice sends. As the answers add up, each slice of blocks is smaller than
the one before.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import checkpointed, forget, freed, freed_pair, release, slices
from .words import bounds, mixed, utf8, word_hashes

FOLDS = 3
MODELS = FOLDS + 1  # without one fold each, and the whole
CHARS_PER_BLOCK = 12_000_000
WORDS_AT_ONCE = 1 << 20  # in a chunk, but for one long text
ROWS_AT_ONCE = 100_000
PAIRS_AT_ONCE = 1 << 16
KEYS_AT_ONCE = 1 << 16  # of a block, but for one key
SLICES = 4, 6, 16  # of blocks, of chunks that send sums, of chunks that end
ANSWERED = 0.26  # bytes answered for a byte sent by the chunks, in a trial
DISCOUNT = 0.75
PAIRS, WORDS, SUMS = range(3)
_SENT = "block bigint, chunk bigint, keys binary, values binary"
_SENT_ARROW = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("values", pa.binary())])
_ANSWERS = "kind int, chunk bigint, block bigint, values binary"
_ANSWERS_ARROW = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("block", pa.int64()), ("values", pa.binary())])
_CHUNKS = pa.schema([("chunk", pa.int64()), ("chars", pa.int64()), ("names", pa.binary()), ("codes", pa.binary()), ("rows", pa.binary())])
_MARKS = np.random.Generator(np.random.PCG64(2)).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TRIM = bytes(0x20 if k in b".,;:!?\"'()[]#*$%&|<>" else k for k in range(256))
#: By mask (three bits for the folds of each class), class and model: whether the model has it.
_HAS = np.array([[[(mask >> FOLDS * c & 7 & ~(1 << m)) > 0 for m in range(MODELS)] for c in (0, 1)] for mask in range(64)])
#: Numbers kept of a word: pairs that end in it; of pairs that begin with it their counts, and
#: how many have a count of 1, 2 and more, in each class and in both.
_PARTS = np.cumsum([2 * MODELS, 2 * MODELS, 3 * 2 * MODELS, 3 * MODELS])


def _plain(text: str | None) -> bytes:
    return utf8((text or "").lower()).translate(_TRIM)


def plain_words(text: str | None) -> np.ndarray:
    return word_hashes(_plain(text))


def words_of(found: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of texts, one text after the other, and the place of each word's text."""
    plain = [_plain(text) for text in found]
    data = b"\n".join(plain)
    starts, ends = bounds(data)
    return word_hashes(data, starts, ends), np.searchsorted(np.cumsum([len(x) + 1 for x in plain]), starts, "right")


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _STEP + second)


def looked_up(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted table, and which keys it has."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def discounts(n: np.ndarray) -> np.ndarray:
    """What to take from counts of 0, 1, 2 and more, from how many counts are 0 to 4."""
    off = np.array([0.0, *[DISCOUNT] * 3])
    if n[1:].all():
        y = n[1] / (n[1] + 2 * n[2])
        off[1:] = np.clip([k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)], 0.0, [1.0, 2.0, 3.0])
    return off


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)], schema=schema)


def _merged(keys: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct keys, in order, and all bits of each."""
    order = np.argsort(keys)
    if not len(order):
        return order, masks
    starts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    return order[starts], np.bitwise_or.reduceat(masks[order], starts)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, in order; a place of each; and for each place the number of its key."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return keys[new], order[new], number


def _planes(numbers: np.ndarray) -> bytes:
    """Columns of numbers of up to 32 bits, packed byte by byte, as most are small."""
    n, width = numbers.shape
    most = int(numbers.max()) if numbers.size else 0
    kind = np.dtype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
    data = np.empty((kind.itemsize, width, n), np.uint8)
    for k in range(width):
        data[:, k] = numbers[:, k].astype(kind).view(np.uint8).reshape(n, kind.itemsize).T
    return np.array([n, kind.itemsize], np.int64).tobytes() + pa.compress(pa.py_buffer(data), "zstd", asbytes=True)


def _of_planes(data: bytes, width: int) -> np.ndarray:
    n, size = np.frombuffer(data, np.int64, 2).tolist()
    found = np.frombuffer(pa.decompress(data[16:], n * size * width, "zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    found = found.reshape(size, width, n)
    numbers = np.empty((n, width), np.uint32)
    for column, planes in zip(numbers.T, found.transpose(1, 0, 2), strict=True):
        column[:] = planes[0]
        for k in range(1, size):
            column |= planes[k].astype(np.uint32) << np.uint32(8 * k)
    return numbers


def _parts(n: int) -> Iterator[slice]:
    return (slice(k, k + PAIRS_AT_ONCE) for k in range(0, n, PAIRS_AT_ONCE))


def _coded(numbers: np.ndarray) -> bytes:
    """Rows of numbers, of which many are alike, as the distinct ones and their places."""
    if not len(numbers):
        return np.int64(0).tobytes() + _planes(numbers)
    return _coded_rows(*_distinct_rows(numbers))


def _distinct_rows(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and for each row its place among them."""
    keys = np.empty(len(numbers), np.uint64)
    for part in _parts(len(numbers)):
        keys[part] = numbers[part].astype(np.uint64) @ _MARKS[: numbers.shape[1]]
    _, first, number = _distinct(keys)
    return numbers[first], number


def _distinct_of(parts: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """`_distinct_rows` of rows one after the other, from that of each of their parts."""
    rows, merged = _distinct_rows(np.concatenate([np.zeros((0, width), np.uint32), *(rows for rows, _ in parts)]))
    starts = np.cumsum([0, *(len(rows) for rows, _ in parts)])
    return rows, np.concatenate([np.zeros(0, np.int64), *(merged[first + own] for first, (_, own) in zip(starts.tolist(), parts, strict=False))])


def _coded_rows(rows: np.ndarray, number: np.ndarray) -> bytes:
    """The same of rows of which the distinct ones are known."""
    times = np.bincount(number, minlength=len(rows))
    used = np.flatnonzero(times)
    if 2 * len(used) > len(number):
        return np.int64(0).tobytes() + _planes(rows[number])
    used = used[np.argsort(-times[used], kind="stable")]  # small numbers for frequent rows
    rank = np.empty(len(rows), np.int64)
    rank[used] = np.arange(len(used))
    packed = _planes(rows[used])
    return np.int64(len(packed)).tobytes() + packed + _planes(rank[number][:, None])


def _rows_of_coded(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and the place of each coded row among them."""
    size = int(np.frombuffer(data, np.int64, 1)[0])
    if not size:
        rows = _of_planes(data[8:], width)
        return rows, np.arange(len(rows))
    return _of_planes(data[8 : 8 + size], width), _of_planes(data[8 + size :], 1)[:, 0]


def _of_coded(data: bytes, width: int) -> np.ndarray:
    rows, number = _rows_of_coded(data, width)
    return rows[number]


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as what each adds to the one before; the five low bytes are chance."""
    steps = np.diff(keys, prepend=np.uint64(0))
    high = _planes((steps >> np.uint64(40)).astype(np.uint32)[:, None])
    return np.int64(len(high)).tobytes() + high + steps.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    size = 8 + int(np.frombuffer(data, np.int64, 1)[0])
    high = _of_planes(data[8:size], 1)[:, 0].astype(np.uint64)
    return np.cumsum((high << np.uint64(40)) + _of_bytes(data[size:]), dtype=np.uint64)


def _of_bytes(data: bytes) -> np.ndarray:
    """Numbers of five bytes."""
    numbers = np.zeros((len(data) // 5, 8), np.uint8)
    numbers[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return numbers.view(np.uint64)[:, 0]


def _named(names: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted word hashes and how often each occurs."""
    packed = _packed(names)
    return np.int64(len(packed)).tobytes() + packed + _planes(counts[:, None])


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts.astype(np.int64), kind="stable")  # small numbers for frequent words


def _of_named(data: bytes) -> np.ndarray:
    """The word hashes in the order of their numbers."""
    size = 8 + int(np.frombuffer(data, np.int64, 1)[0])
    return _unpacked(data[8:size])[_by_count(_of_planes(data[size:], 1)[:, 0])]


def _slices_of_blocks(n_blocks: int, parts: int) -> np.ndarray:
    """The slice of each block: with the answers of those before, all take the same on the disk."""
    shares = np.cumsum((1 + ANSWERED) ** -np.arange(parts, dtype=float))
    return np.searchsorted(shares / shares[-1], (np.arange(n_blocks) + 0.5) / n_blocks, "right")


def _blocks(keys: np.ndarray, n_blocks: int) -> Iterator[tuple[int, slice]]:
    """The blocks of sorted hashes, which have a range each, and the places of each one's."""
    block = (keys >> np.uint64(32)) * np.uint64(n_blocks) >> np.uint64(32)
    numbers, starts = np.unique(block, return_index=True)
    for number, low, high in zip(numbers.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
        yield number, slice(low, high)


def _ranges(keys: list[np.ndarray]) -> Iterator[list[slice]]:
    """Ranges of keys of some KEYS_AT_ONCE each, over several sorted arrays: where each has its own."""
    n = -(-sum(map(len, keys)) // KEYS_AT_ONCE)
    some = np.sort(np.concatenate([own[:: max(n, 1)] for own in keys] or [np.zeros(0, np.uint64)]))
    limits = some[[len(some) * k // n for k in range(1, n)]]
    ends = [[0, *np.searchsorted(own, limits).tolist(), len(own)] for own in keys]
    for k in range(n):
        yield [slice(*at[k : k + 2]) for at in ends]


def _buffers(column: pa.ChunkedArray) -> list[pa.Buffer]:
    """Binary values where they lie."""
    return [value.as_buffer() for value in column]


def _sums(counts: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Of counts by row, and how often each row occurs: how many are 1, 2, 3, 4, how many 3 or
    more, and their sum."""
    return np.stack([times @ numbers for numbers in (*(counts == k for k in (1, 2, 3, 4)), counts >= 3, counts.astype(np.int64))]).astype(np.int64)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    if not len(order):
        return keys, values
    starts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    return keys[order[starts]], np.add.reduceat(values[order], starts, axis=0, dtype=np.uint32)


class Chunk:
    """The texts of a chunk: its words by number, the place of each word's text, and rows."""

    def __init__(self, table: pa.Table):
        self.number = table.column("chunk")[0].as_py()
        self.names = np.frombuffer(table.column("names")[0].as_py(), np.uint64)
        self.rows = pa.ipc.open_stream(table.column("rows")[0].as_py()).read_all()
        self.masks = self.rows.column("mask").to_numpy()  # one bit for class and fold; 0: without a label
        self._codes = table.column("codes")[0].as_py()

    @functools.cached_property
    def codes(self) -> np.ndarray:
        return _of_planes(self._codes, 1)[:, 0].astype(np.int32)

    @functools.cached_property
    def places(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows.num_rows, dtype=np.int32), self.rows.column("size").to_numpy())

    @functools.cached_property
    def right(self) -> np.ndarray:
        """Places of the words with a word before them in the same text."""
        return (np.flatnonzero(self.places[1:] == self.places[:-1]) + 1).astype(np.int32)

    @functools.cached_property
    def pairs(self) -> np.ndarray:
        """Those words with the words before them."""
        found = np.empty(len(self.right), np.uint64)
        for part in _parts(len(found)):
            right = self.right[part]
            found[part] = pair_keys(self.names[self.codes[right - 1]], self.names[self.codes[right]])
        return found

    @classmethod
    def stored(cls, table: pa.Table) -> Chunk:
        """A chunk as `chunked` has written it, with its words packed."""
        names = _of_named(table.column("names")[0].as_py()).tobytes()
        return cls(table.set_column(table.schema.get_field_index("names"), "names", pa.array([names], pa.binary())))

    def sent(self, n_blocks: int, part: int, parts: int) -> pa.Table:
        """Distinct pairs for the blocks of one slice, and the labelled words before them."""
        inside, chosen = np.empty(len(self.pairs), bool), _slices_of_blocks(n_blocks, parts) == part
        for some in _parts(len(inside)):
            inside[some] = chosen[(self.pairs[some] >> np.uint64(32)) * np.uint64(n_blocks) >> np.uint64(32)]
        right, pairs = self.right[inside], self.pairs[inside]
        del self.pairs  # each task asks for them once
        names, _, at = _distinct(pairs)
        # A pair counts once for each word before it: copies of a text count once.
        counted = np.flatnonzero((self.masks[self.places[right]] > 0) & (right > 1))
        counted = counted[self.places[right[counted] - 2] == self.places[right[counted]]]
        before, at = self.names[self.codes[right[counted] - 2]] >> np.uint64(24), at[counted]
        if len(names) >> 24:
            order = np.lexsort((before, at))
        else:
            order = np.argsort((at.astype(np.uint64) << np.uint64(40)) + before)
        before, at, bits = before[order], at[order], self.masks[self.places[right[counted[order]]]]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (before[1:] != before[:-1])
        if len(new):
            before, at, bits = before[new], at[new], np.bitwise_or.reduceat(bits, np.flatnonzero(new))
        each = np.bincount(at, minlength=len(names))
        ends = np.concatenate([[0], np.cumsum(each)])
        rows = []
        for number, own in _blocks(names, n_blocks):
            inner = slice(ends[own.start], ends[own.stop])
            parts = [_planes(each[own, None]), _planes(bits[inner, None])]
            sizes = np.array([len(x) for x in parts], np.int64)
            rows.append((number, self.number, _packed(names[own]), sizes.tobytes() + b"".join(parts) + before[inner].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()))
        return _rows(rows, _SENT_ARROW)

    def words_sent(self, answers: pa.Table, n_blocks: int) -> pa.Table:
        """Of each word the sums over the pairs that fall to this chunk, and its classes and folds."""
        first = _distinct(self.pairs)[1]
        del self.pairs  # each task asks for them once
        counts = _answered(answers, PAIRS, np.zeros((len(first), 2 * MODELS + 1), np.uint32))
        own = np.flatnonzero(counts[:, -1])
        counts, right = counts[own, :-1], self.right[first[own]]
        del first, own
        n, order = len(self.names), np.argsort(self.names)
        rank = np.empty(n, np.int32)
        rank[order] = np.arange(n, dtype=np.int32)
        left, right = rank[self.codes[right - 1]], rank[self.codes[right]]
        values, both = np.zeros((n, _PARTS[-1] + 1), np.uint32), counts[:, :MODELS] + counts[:, MODELS:]
        for k in range(2 * MODELS):
            values[:, k] = np.bincount(right[counts[:, k] > 0], minlength=n)
            values[:, _PARTS[0] + k] = np.bincount(left, weights=counts[:, k], minlength=n)
        for first, numbers in ((_PARTS[1], counts), (_PARTS[2], both)):
            for level, of_level in enumerate((numbers == 1, numbers == 2, numbers >= 3)):
                for k, column in enumerate(of_level.T):
                    values[:, first + level * numbers.shape[1] + k] = np.bincount(left[column], minlength=n)
        of_words = self.masks[self.places]
        for bit in np.unique(self.masks[self.masks > 0]).tolist():
            values[rank[self.codes[of_words == bit]], -1] |= np.uint32(bit)
        names = self.names[order]
        return _rows([(number, self.number, _packed(names[own]), _coded(values[own])) for number, own in _blocks(names, n_blocks)], _SENT_ARROW)

    def words_asked(self, n_blocks: int) -> pa.Table:
        names = np.sort(self.names)
        return _rows([(number, self.number, _packed(names[own]), None) for number, own in _blocks(names, n_blocks)], _SENT_ARROW)

    def ratios(self, answers: pa.Table, weighing: list[Weighing]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """By model and some rows: both, the log ratios of their words after the ones before, and the
        place of each word's row among them. The last model is for all rows, others for their folds."""
        inverse = _distinct(self.pairs)[2]
        del self.pairs  # each task asks for them once
        pair = np.full(len(self.codes), -1, np.int32)
        pair[self.right] = inverse
        pairs = np.zeros((int(inverse.max(initial=-1)) + 1, 2 * MODELS + 1), np.uint32)
        del inverse
        pairs = _answered(answers, PAIRS, pairs)
        values = np.zeros((len(self.names), _PARTS[-1]), np.uint32)
        values = _answered(answers, WORDS, values, np.argsort(self.names))
        ends, contexts, levels, both = np.split(values, _PARTS[:-1], axis=1)
        ends, contexts = ends.reshape(-1, 2, MODELS), contexts.reshape(-1, 2, MODELS)
        levels, both = levels.reshape(-1, 3, 2, MODELS), both.reshape(-1, 3, MODELS)
        for m, weigh in enumerate(weighing):
            known = (ends[:, 0, m] | ends[:, 1, m] | contexts[:, 0, m] | contexts[:, 1, m]) > 0
            of_words = weigh.of_words(ends[..., m], contexts[..., m], levels[..., m], both[..., m])
            of_known = np.where(known, _ratio(of_words[:, :2].astype(float)), weigh.unseen_ratio)
            of_leaving = _ratio(of_words[:, 4:6].astype(float))
            counts = pairs[:, [m, MODELS + m]]
            counted = (counts[:, 0] | counts[:, 1]) > 0
            for some, here in self.some_rows():
                chosen = np.ones(some.stop - some.start, bool) if m == FOLDS else self.masks[some] & (1 << m | 1 << FOLDS + m) > 0
                if not chosen.any():
                    continue
                at = self.places[here] - some.start
                inside = chosen[at]
                codes, pair_of = self.codes[here][inside], pair[here][inside]
                total = of_known[codes]
                right = np.flatnonzero(pair_of >= 0)
                after = right[known[codes[right - 1]]]
                total[after] += of_leaving[codes[after - 1]]
                seen = right[counted[pair_of[right]]]
                for part in (seen[k : k + PAIRS_AT_ONCE] for k in range(0, len(seen), PAIRS_AT_ONCE)):
                    total[part] = weigh.of_pairs(counts[pair_of[part]].astype(np.int64), of_words[codes[part - 1]], of_words[codes[part]])
                yield m, some.start + np.flatnonzero(chosen), total, (np.cumsum(chosen) - 1)[at[inside]]

    def some_rows(self) -> Iterator[tuple[slice, slice]]:
        """Rows of some PAIRS_AT_ONCE words together, a longer one alone, and where their words are."""
        ends = np.cumsum(self.rows.column("size").to_numpy())
        row = word = 0
        while row < len(ends):
            last = max(row + 1, int(np.searchsorted(ends, word + PAIRS_AT_ONCE, "right")))
            yield slice(row, last), slice(word, int(ends[last - 1]))
            row, word = last, int(ends[last - 1])


def _answered(answers: pa.Table, kind: int, into: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Puts what the blocks answered, in the order of what was sent, into rows, or into those that
    `order` names."""
    kinds, blocks, first = answers.column("kind").to_pylist(), answers.column("block").to_pylist(), 0
    for k in sorted((k for k in range(len(kinds)) if kinds[k] == kind), key=blocks.__getitem__):
        found = _of_coded(answers.column("values")[k].as_buffer(), into.shape[1])
        own = slice(first, first + len(found))
        into[own if order is None else order[own]] = found
        first += len(found)
    assert first == len(into), "some blocks have not answered"
    return into


def _pair_block(table: pa.Table) -> pa.Table:
    """The counts of a block's pairs, for each chunk that sent some, and sums."""
    order = np.argsort(table.column("chunk").to_numpy(), kind="stable").tolist()
    block, chunks = table.column("block")[0].as_py(), [table.column("chunk")[k].as_py() for k in order]
    asked, sent = [], []
    for k in order:
        asked.append(_unpacked(table.column("keys")[k].as_buffer()))
        data = table.column("values")[k].as_buffer()
        size, more = np.frombuffer(data, np.int64, 2).tolist()
        ends = np.concatenate([[0], np.cumsum(_of_planes(data[16 : 16 + size], 1)[:, 0], dtype=np.int64)]).astype(np.int32)
        sent.append((ends, _of_planes(data[16 + size : 16 + size + more], 1)[:, 0].astype(np.uint8), data[16 + size + more :]))
    found, rows = [np.zeros(0, np.uint64)], []
    for at in _ranges(asked):
        of, before, masks = [], [], []
        for keys, (ends, bits, words), own in zip(asked, sent, at, strict=True):
            low, high = int(ends[own.start]), int(ends[own.stop])
            of.append(np.repeat(keys[own], np.diff(ends[own.start : own.stop + 1])))
            before.append(_of_bytes(words[5 * low : 5 * high]))
            masks.append(bits[low:high])
        of = np.concatenate(of)
        first, bits = _merged(pair_keys(np.concatenate(before), of), np.concatenate(masks))
        pairs, counts = _summed(of[first], _HAS[bits].reshape(len(bits), 2 * MODELS))
        found.append(pairs)
        rows.append(_distinct_rows(counts))
    del sent
    pairs, (counts, alike) = np.concatenate(found), _distinct_of(rows, 2 * MODELS)
    del found, rows
    both, times = counts[:, :MODELS] + counts[:, MODELS:], np.bincount(alike, minlength=len(counts))
    rows = [(SUMS, None, PAIRS, np.concatenate([_sums(counts, times), _sums(both, times)], 1).tobytes())]
    #: None, or some of the counts, for a pair that a chunk has had already, and for one that is free.
    possible = np.zeros((len(counts) + 1, 2, 2 * MODELS + 1), np.uint32)
    possible[1:, :, :-1], possible[:, 1, -1] = counts[:, None], 1
    possible = possible.reshape(-1, 2 * MODELS + 1)
    free = np.ones(len(pairs), bool)
    for chunk, keys in zip(chunks, asked, strict=True):
        at, there = looked_up(pairs, keys)
        at, number = at[there], np.zeros(len(keys), np.int64)
        number[there] = 2 * (alike[at] + 1) + free[at]
        free[at] = False
        rows.append((PAIRS, chunk, block, _coded_rows(possible, number)))
    return _rows(rows, _ANSWERS_ARROW)


def _added(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The distinct words of some rows, their sums, and their classes and folds, range by range."""
    width = _PARTS[-1] + 1
    asked = [_unpacked(x) for x in _buffers(table.column("keys"))]
    sent = [_rows_of_coded(x, width) for x in _buffers(table.column("values"))]
    for at in _ranges(asked):
        keys = np.concatenate([own[part] for own, part in zip(asked, at, strict=True)])
        values = np.concatenate([rows[number[part]] for (rows, number), part in zip(sent, at, strict=True)])
        _, bits = _merged(keys, values[:, -1])
        yield *_summed(keys, values[:, :-1]), bits


def _word_sums(table: pa.Table) -> pa.Table:
    """The rows of a block's words, added up."""
    found, parts = [np.zeros(0, np.uint64)], []
    for words, values, bits in _added(table):
        found.append(words)
        parts.append(_distinct_rows(np.column_stack([values, bits])))
    coded = _coded_rows(*_distinct_of(parts, _PARTS[-1] + 1))
    return _rows([(table.column("block")[0].as_py(), None, _packed(np.concatenate(found)), coded)], _SENT_ARROW)


def _word_totals(table: pa.Table) -> pa.Table:
    """The rows of a block's words, all added up, and sums over them."""
    found, parts, of_bits = [np.zeros(0, np.uint64)], [], np.zeros(64, np.int64)
    for words, values, bits in _added(table):
        found.append(words)
        parts.append(_distinct_rows(values))
        of_bits += np.bincount(bits, minlength=64)
    values, alike = _distinct_of(parts, _PARTS[-1])
    times = np.bincount(alike, minlength=len(values))
    sums = np.concatenate([_sums(values[:, : _PARTS[0]], times).ravel(), of_bits @ _HAS.any(1)]).astype(np.int64)
    return _rows([(table.column("block")[0].as_py(), WORDS, _packed(np.concatenate(found)), _coded_rows(values, alike)), (None, SUMS, None, sums.tobytes())], _SENT_ARROW)


def _word_answers(asked: pa.Table, totals: pa.Table) -> pa.Table:
    """The sums of a block's words, for each chunk that asked for some."""
    if not asked.num_rows:
        return _rows([], _ANSWERS_ARROW)
    block, words = asked.column("block")[0].as_py(), _unpacked(totals.column("keys")[0].as_py())
    rows, number = _rows_of_coded(totals.column("values")[0].as_py(), _PARTS[-1])
    sent = zip(asked.column("chunk").to_pylist(), asked.column("keys").to_pylist(), strict=True)
    return _rows([(WORDS, chunk, block, _coded_rows(rows, number[np.searchsorted(words, _unpacked(keys))])) for chunk, keys in sent], _ANSWERS_ARROW)


@dataclass
class Weighing:
    """What one model takes from the counts, and what that leaves for the words."""

    off_ends: np.ndarray  # by class
    off_pairs: np.ndarray  # by class
    off_both: np.ndarray
    totals: np.ndarray
    rest: np.ndarray  # by class: the share of the backoff
    uniform: float
    shared: float

    @property
    def unseen_ratio(self) -> float:
        least = np.log(np.maximum(self.rest, 1e-9))
        return float(least[1] - least[0])

    def of_words(self, ends: np.ndarray, contexts: np.ndarray, levels: np.ndarray, both: np.ndarray) -> np.ndarray:
        """By word: its likelihood, context and backoff in each class, context and backoff in both."""
        ends, contexts = ends.astype(float), contexts.astype(float)
        off = np.stack([self.off_ends[c][np.minimum(ends[:, c], 3).astype(int)] for c in (0, 1)], 1)
        shared = (off.sum(1) + self.uniform) / self.shared
        likely = (ends - off) / self.totals + self.rest * shared[:, None]
        kept = contexts - np.einsum("wkc,ck->wc", levels, self.off_pairs[:, 1:])
        leave = 1 - kept / np.maximum(contexts, 1)
        of_left = contexts.sum(1)
        leave_both = 1 - (of_left - np.einsum("wk,k->w", both, self.off_both[1:])) / np.maximum(of_left, 1)
        return np.column_stack([likely, np.maximum(contexts, 1), leave, np.maximum(of_left, 1), leave_both]).astype(np.float32)

    def of_pairs(self, counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Log ratios of pairs with these counts and words."""
        likely = right[:, :2].astype(float)
        context, leave, of_left, leave_both = left[:, 2:4].astype(float), left[:, 4:6].astype(float), left[:, 6].astype(float), left[:, 7].astype(float)
        both = counts.sum(1)
        together = (both - self.off_both[np.minimum(both, 3)]) / of_left
        own = np.stack([counts[:, c] - self.off_pairs[c][np.minimum(counts[:, c], 3)] for c in (0, 1)], 1) / context
        return _ratio(own + leave * (together[:, None] + leave_both[:, None] * likely))


def _ratio(likely: np.ndarray) -> np.ndarray:
    logs = np.log(np.maximum(likely, 1e-30))
    return logs[:, 1] - logs[:, 0]


def _weighing(pairs: np.ndarray, ends: np.ndarray, n_words: int, m: int) -> Weighing:
    def off(n: np.ndarray) -> np.ndarray:
        return discounts(np.array([0, *n[:4]], float))

    by_class = pairs[:, : 2 * MODELS].reshape(6, 2, MODELS)[:, :, m]
    own = ends.reshape(6, 2, MODELS)[:, :, m].astype(float)
    off_ends = np.stack([off(own[:, c]) for c in (0, 1)])
    taken = np.array([off_ends[c][1:] @ own[[0, 1, 4], c] for c in (0, 1)])
    totals = np.maximum(own[5], 1)
    return Weighing(
        off_ends,
        np.stack([off(by_class[:, c]) for c in (0, 1)]),
        off(pairs[:, 2 * MODELS + m]),
        totals,
        1 - (own[5] - taken) / totals,
        1 / max(n_words, 1),
        max(taken.sum() + n_words / max(n_words, 1), 1.0),
    )


def chunked(rows: DataFrame, asking: bool = False) -> DataFrame:
    """Chunks of texts: doc_id, key, text, label (0, 1 or null) and fold (0 to FOLDS - 1).
    Those that ask about labelled texts of others have numbers below 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        number, hashes, tables, size = TaskContext.get().partitionId() << 32, [], [], 0

        def chunk() -> pa.RecordBatch:
            chars, words = sum(n for _, n in hashes), np.concatenate([h for h, _ in hashes])
            hashes.clear()
            names, _, codes = _distinct(words)
            del words
            counts = np.bincount(codes, minlength=len(names))
            order = _by_count(counts)
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            sink = pa.BufferOutputStream()
            table = pa.concat_tables(tables)
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
                writer.write_table(table)
            row = (-1 - number if asking else number, chars, _named(names, counts), _planes(rank[codes][:, None]), sink.getvalue().to_pybytes())
            return _rows([row], _CHUNKS).to_batches()[0]

        for batch in (part for whole in batches for part in slices(whole)):
            found = batch.column("text").to_pylist()
            words, places = words_of(found)
            hashes.append((words, sum(len(t or "") for t in found)))
            mask = [0 if y is None else 1 << FOLDS * y + f for y, f in zip(batch.column("label").to_pylist(), batch.column("fold").to_pylist(), strict=True)]
            table = pa.Table.from_batches([batch]).drop_columns(["text", "fold"])
            table = table.append_column("size", pa.array(np.bincount(places, minlength=len(found)), pa.int64()))
            tables.append(table.append_column("mask", pa.array(mask, pa.uint8())))
            size += len(words)
            if size >= WORDS_AT_ONCE or sum(t.num_rows for t in tables) >= ROWS_AT_ONCE:
                yield chunk()
                number, tables, size = number + 1, [], 0
        if tables:
            yield chunk()
        release()

    rows = rows.select("doc_id", "key", "text", F.col("label").cast("int"), F.col("fold").cast("int"))
    return checkpointed(rows.mapInArrow(work, "chunk bigint, chars bigint, names binary, codes binary, rows binary"))


def _each_chunk(chunks: DataFrame, work: Callable[[Chunk], pa.Table], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for k in range(batch.num_rows):
                yield from work(Chunk.stored(pa.Table.from_batches([batch.slice(k, 1)]))).to_batches()
        release()

    return chunks.mapInArrow(run, schema)


def _united(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def measured(chunks: DataFrame, measure: Callable[[np.ndarray, np.ndarray, int], np.ndarray], names: tuple[str, ...], doc_id: str) -> DataFrame:
    """doc_id, key, size and label of the rows of chunks (if some ask: of these), and what
    `measure` makes of their log ratios: by the model of all, and (apart_) by that without the
    row's fold."""
    chars, least = chunks.agg(F.sum("chars"), F.min("chunk")).first()
    n_blocks = -(-(chars or 0) // CHARS_PER_BLOCK) or 1
    of_blocks, of_sums, of_ends = (min(n, n_blocks) for n in SLICES)
    number = F.when(F.col("chunk") < 0, -1 - F.col("chunk")).otherwise(F.col("chunk"))
    slice_ = F.shiftright(number, 32) + number % (1 << 32)

    def pairs(part: int) -> DataFrame:
        sent = _each_chunk(chunks, lambda chunk: chunk.sent(n_blocks, part, of_blocks), _SENT)
        return checkpointed(sent.groupBy("block").applyInArrow(freed(_pair_block), _ANSWERS))

    def words(part: int) -> DataFrame:
        own = chunks.where(slice_ % of_sums == part).groupBy("chunk").cogroup(of_pairs.where((slice_ % of_sums == part) & (F.col("kind") != SUMS)).groupBy("chunk"))
        sent = own.applyInArrow(freed_pair(lambda chunk, answers: Chunk.stored(chunk).words_sent(answers, n_blocks)), _SENT)
        return checkpointed(sent.groupBy("block").applyInArrow(freed(_word_sums), _SENT))

    of_pairs = _united([pairs(part) for part in range(of_blocks)])
    added = _united([words(part) for part in range(of_sums)])
    totals = checkpointed(added.groupBy("block").applyInArrow(freed(_word_totals), _SENT))
    del added
    sums = {PAIRS: np.zeros((6, 3 * MODELS), np.int64), WORDS: np.zeros(6 * 2 * MODELS + MODELS, np.int64)}
    of_words = totals.where(F.col("chunk") == SUMS).select(F.lit(WORDS).alias("block"), "values")
    for row in of_pairs.where(F.col("kind") == SUMS).select("block", "values").unionByName(of_words).collect():
        sums[row["block"]] += np.frombuffer(row["values"], np.int64).reshape(sums[row["block"]].shape)
    ends, n_words = sums[WORDS][:-MODELS].reshape(6, 2 * MODELS), sums[WORDS][-MODELS:]
    weighing = [_weighing(sums[PAIRS], ends, int(n_words[m]), m) for m in range(MODELS)]

    def finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk.stored(chunk)
        values = np.zeros((2, chunk.rows.num_rows, len(names)))
        for m, rows, ratios, places in chunk.ratios(answers, weighing):
            values[int(m < FOLDS), rows] = measure(ratios, places, len(rows))
        columns = [pa.array(column) for model in values for column in model.T]
        return pa.table([*(chunk.rows.column(c) for c in ("doc_id", "key", "size", "label")), *columns], names=["doc_id", "key", "size", "label", *names, *(f"apart_{c}" for c in names)])

    schema = ", ".join([f"doc_id {doc_id}", "key bigint, size bigint, label int", *(f"{c} double" for c in names), *(f"apart_{c} double" for c in names)])
    asking = F.col("chunk") < 0 if (least or 0) < 0 else F.lit(True)

    def finished(part: int) -> DataFrame:
        own = chunks.where((slice_ % of_ends == part) & asking)
        asked = _each_chunk(own, lambda chunk: chunk.words_asked(n_blocks), _SENT)
        of_words = asked.groupBy("block").cogroup(totals.where(F.col("chunk") == WORDS).groupBy("block")).applyInArrow(freed_pair(_word_answers), _ANSWERS)
        answers = of_pairs.where((F.col("kind") != SUMS) & (slice_ % of_ends == part) & asking).unionByName(of_words)
        return checkpointed(own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(freed_pair(finish), schema))

    return _united([finished(part) for part in range(of_ends)])
