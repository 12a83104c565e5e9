"""Operator 11: fill-in-the-middle texts by a piece table.

A document is a list of descriptors (buffer, start, end) over two kinds of buffers that never
change: its own text, and the sentinels. Cutting a document splits its descriptor, an
arrangement permutes the parts and puts sentinel descriptors between them, and the inverse
permutation restores the order. Nothing is copied until a text is written out; digests read
the descriptors one after the other, so beside the text itself they need constant memory.

A text is cut behind whole tokens (a word with the white space before it, or white space at
the end). Places and forms come from a digest of the seed and the doc_id, so a task that
runs again gives the same result. Places in a long text are found chunk by chunk.

Results: a null text counts as empty; an empty text, or one that holds a sentinel, stays as
it is (form "plain"). A null doc_id is hashed as if it had no digits. Repeated rows are
transformed alike; an empty table gives no rows. Columns other than doc_id and text are left
alone, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import each_batch, encoded, texts

# The sentinels, and where each form has them.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Parts in the order of the output: each sentinel, and the part of the text behind it.
FORMS = {
    "plain": ((b"", 0), (b"", 1), (b"", 2)),
    "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}
CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Choice:
    """How often documents are transformed, how often suffix first, and the seed."""

    percent: int = 50
    suffix_first_percent: int = 80
    seed: int = 42


Piece = tuple[bytes, int, int]


def _chunks(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The text chunk by chunk: the place of each, and where in it words end.

    A word ends at its last byte; the byte behind a chunk is looked at, too.
    """
    for at in range(0, len(data), CHUNK):
        space = _SPACE[np.frombuffer(data, np.uint8, min(CHUNK + 1, len(data) - at), at)]
        if len(space) <= CHUNK:
            space = np.append(space, True)
        yield at, np.flatnonzero(~space[:-1] & space[1:]) + (at + 1)


def n_tokens(data: bytes) -> int:
    """Words, and one more if white space ends the text."""
    return sum(len(ends) for _, ends in _chunks(data)) + (bool(data) and bool(_SPACE[data[-1]]))


def places(data: bytes, counts: Iterable[int]) -> list[int]:
    """The bytes behind the first so many tokens, for rising counts."""
    wanted, found, before = list(counts), [], 0
    while wanted and not wanted[0]:
        found.append(wanted.pop(0))
    for _, ends in _chunks(data):
        while wanted and wanted[0] <= before + len(ends):
            found.append(int(ends[wanted.pop(0) - before - 1]))
        if not wanted:
            break
        before += len(ends)
    return found + [len(data)] * len(wanted)  # behind the white space at the end


def characters(data: bytes, start: int, end: int) -> int:
    """Code points of a part."""
    total = 0
    for at in range(start, end, CHUNK):
        part = np.frombuffer(data, np.uint8, min(CHUNK, end - at), at)
        total += int(np.count_nonzero((part & 0xC0) != 0x80))
    return total


def split(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and behind a place; the one that holds it becomes two."""
    left: list[Piece] = []
    for k, (buffer, start, end) in enumerate(pieces):
        if at < end - start:
            cut = start + at
            return [*left, (buffer, start, cut)], [(buffer, cut, end), *pieces[k + 1 :]]
        left.append((buffer, start, end))
        at -= end - start
    return left, []


def arranged(parts: list[list[Piece]], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of a form, behind their sentinels."""
    found: list[Piece] = []
    for sentinel, part in FORMS[form]:
        found += [(sentinel, 0, len(sentinel)), *parts[part]]
    return found


def restored(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output that give its text back: the sentinels are cut out, in the
    order of the form, and the parts put back in theirs.

    The text holds no sentinel, and none arises where a part and a sentinel meet, as one
    begins with its only "<"; so the first find is the right one.
    """
    rest: list[Piece] = [(output, 0, len(output))]
    parts: list[list[Piece]] = [[], [], []]
    at, before = 0, None
    for sentinel, part in FORMS[form]:
        place = output.index(sentinel, at)
        if before is not None:
            parts[before], rest = split(rest, place - at)
        _, rest = split(rest, len(sentinel))
        at, before = place + len(sentinel), part
    parts[before] = rest
    return [piece for part in parts for piece in part]


def written(pieces: Iterable[Piece]) -> bytes:
    return b"".join(memoryview(buffer)[start:end] for buffer, start, end in pieces)


def digest(pieces: Iterable[Piece]) -> str:
    """The digest of a text, descriptor by descriptor."""
    state = hashlib.sha256()
    for buffer, start, end in pieces:
        state.update(memoryview(buffer)[start:end])
    return state.hexdigest()


def chosen(doc_id: int | None, data: bytes, n: int, choice: Choice) -> tuple[str, int, int]:
    """Form of a document, and the numbers of tokens behind which it is cut."""
    key = f"{choice.seed}:{'' if doc_id is None else doc_id}".encode()
    h1, h2, h3, h4 = (int.from_bytes(hashlib.sha256(key).digest()[k : k + 4]) for k in range(0, 16, 4))
    if not data or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= choice.percent:
        return "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < choice.suffix_first_percent else "psm"), low, high


def cut(doc_id: int | None, data: bytes, choice: Choice) -> tuple[int, str, list[int], list[Piece]]:
    """Tokens, form, the places of the two cuts, and the descriptors of the output."""
    n = n_tokens(data)
    form, low, high = chosen(doc_id, data, n, choice)
    whole: list[Piece] = [(data, 0, len(data))]
    if form == "plain":
        return n, form, [], whole
    ends = places(data, (low, high))
    prefix, rest = split(whole, ends[0])
    middle, suffix = split(rest, ends[1] - ends[0])
    return n, form, ends, arranged([prefix, middle, suffix], form)


def fill_in_middle(docs: DataFrame, choice: Choice = Choice()) -> DataFrame:
    """doc_id, the arranged text, and its form."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [cut(doc, data, choice) for doc, data in zip(batch.column("doc_id").to_pylist(), encoded(batch), strict=True)]
        columns = [pa.array([written(x[3]) for x in found], pa.binary()).view(pa.string()), pa.array([x[1] for x in found], pa.string())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "text", "form"])

    return each_batch(texts(docs), work, "doc_id bigint, text string, form string")


def plain_texts(arranged_docs: DataFrame) -> DataFrame:
    """doc_id and the text as it was, from rows of `fill_in_middle`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        forms = batch.column("form").to_pylist()
        found = [data if form == "plain" else written(restored(data, form)) for data, form in zip(encoded(batch), forms, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary()).view(pa.string())], ["doc_id", "text"])

    return each_batch(texts(arranged_docs, F.coalesce("form", F.lit("plain")).alias("form")), work, "doc_id bigint, text string")


DIGESTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"


def arrangement_digests(docs: DataFrame, choice: Choice = Choice()) -> DataFrame:
    """Form, sizes of the parts, digest of the output, and of the text rebuilt from it."""

    def row(doc_id: int | None, data: bytes) -> tuple:
        n, form, ends, pieces = cut(doc_id, data, choice)
        if form == "plain":
            same = digest(pieces)
            return doc_id, n, form, None, None, same, same
        sizes = characters(data, 0, ends[0]), characters(data, ends[0], ends[1])
        output = written(pieces)
        return doc_id, n, form, *sizes, digest(pieces), digest(restored(output, form))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [row(doc, data) for doc, data in zip(batch.column("doc_id").to_pylist(), encoded(batch), strict=True)]
        kinds = {"doc_id": pa.int64(), "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output_sha256": pa.string(), "restored_sha256": pa.string()}
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
        return pa.RecordBatch.from_arrays(columns, list(kinds))

    return each_batch(texts(docs), work, DIGESTS)
