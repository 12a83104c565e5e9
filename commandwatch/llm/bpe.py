"""Byte-pair encoding as a streaming transducer, and its decoder.

The merge list is applied lowest rank first. How far the end of a text can reach back into
the tokens before it is bounded by the merge list alone (`sufficient_lookahead`), so a long
word is read through a window of fixed size: tokens that end at least the lookahead before
the end of the window can't change any more and are emitted, and reading goes on behind
them. Memory depends on the merge list, never on the length of a word.

Texts are read in segments cut at white space, which no pre-token and no normal form crosses.
The short pre-tokens of a group of segments that are not known yet are merged together, all
words of a length at once. A memo of bounded bytes keeps the ids of pre-tokens, in two
generations, so that what was used of late stays.

Decoding is a state machine that is fed ids piece by piece. It holds whether a token came
before or, in byte mode, the bytes of an unfinished character, which may be spread over tokens.

Results: a null text counts as empty; an empty text has no ids and decodes to "". Ids that
the vocabulary doesn't have raise KeyError.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import regex

from .spark_io import shared

WORD_END = "</w>"
#: Bytes of the memo, both generations; characters that are read together; bytes of a short
#: pre-token; and unknown ones from which on it is worth to merge them together.
MEMO_BYTES = 48 << 20
GROUP = 1 << 21
SHORT = 48
TOGETHER = 64
ID_BITS = 17
#: White space at which a text may be cut.
AT_BLANK = re.compile("[ \t\n\r\x0b\x0c]")
_LETTERS, _NUMBERS, _BLANKS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"
#: The pre-tokens of texts of Latin-1 characters, and of any others.
NEAR_WORDS = re.compile(f"[{_LETTERS}]+|{_SUFFIXES}|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+").findall
WORDS = regex.compile(rf"\p{{L}}+|{_SUFFIXES}|\p{{N}}|[^\p{{White_Space}}\p{{L}}\p{{N}}]+").findall
NO_MERGE = 1 << 62
_ENCODERS: dict[str, Encoder] = shared({})


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Symbols behind a token boundary after which no continuation can move it.

    A difference at the end of a text moves left by the left part of a merge at most, and a
    later merge carries it on only if its right part begins with that left part. The longest
    such chain, in rank order, bounds the reach.
    """
    reach: dict[str, int] = {}
    longest = 0
    for left, right in merges:
        carried = max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        here = len(left) + carried
        reach[left] = max(reach.get(left, 0), here)
        longest = max(longest, here)
    return longest


class Memo:
    """Packed ids by pre-token, in two generations: when the younger one is full, it becomes
    the older one, whose entries come back when they are asked for again."""

    def __init__(self, most_bytes: int = MEMO_BYTES):
        self.most_bytes, self.size = most_bytes // 2, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, words: list[str], packed: list[bytes]) -> None:
        self.young.update(zip(words, packed, strict=True))
        # Two objects, and their place in the table.
        self.size += 200 * len(words) + sum(map(len, words)) + sum(map(len, packed))

    def unknown(self, words: set[str]) -> set[str]:
        """The words that aren't known; those known are young now."""
        missing = words.difference(self.young)
        back = list(missing.intersection(self.old))
        self.put(back, list(map(self.old.__getitem__, back)))
        return missing.difference(back)

    def trim(self) -> None:
        if self.size > self.most_bytes:
            self.young, self.old, self.size = {}, self.young, 0


class Encoder:
    """Texts to packed ids (little-endian, 32 bits), and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + WORD_END] for c in alphabet]
        # Rank and product in one number, so that the least number is the next merge.
        self.pairs = {vocab[a] << ID_BITS | vocab[b]: rank << ID_BITS | vocab[a + b] for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.symbols = {i: len(t.removesuffix(WORD_END)) for t, i in vocab.items()}
        self.lookahead = sufficient_lookahead(merges)
        self.window = 2 * self.lookahead + 2 * max(self.symbols.values())
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        back = {c: b for b, c in enumerate(alphabet)}
        self.bytes = {i: bytes(back[c] for c in t.removesuffix(WORD_END)) + b" " * t.endswith(WORD_END) for t, i in vocab.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}

        self.memo = Memo()
        # The same for many pre-tokens at once: the pairs in order, and the symbols as arrays.
        pairs = sorted(self.pairs.items())
        self.pair_keys, self.pair_values = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.inner_ids, self.last_ids = np.array(self.inner, np.int64), np.array(self.last, np.int64)

    def learn(self, words: Iterable[str]) -> None:
        """Put the ids of pre-tokens into the memo."""
        by_size: dict[int, list[str]] = {}
        for word in words:
            by_size.setdefault(len(word) if word.isascii() else len(word.encode("utf-8", "surrogatepass")), []).append(word)
        for size, same in by_size.items():
            if size > SHORT or len(same) < TOGETHER:
                found = [list(self.stream(word.encode("utf-8", "surrogatepass"))) for word in same]
                self.memo.put(same, [struct.pack(f"<{len(ids)}I", *ids) for ids in found])
            else:
                data = "".join(same).encode("utf-8", "surrogatepass")
                symbols = np.frombuffer(data, np.uint8).reshape(-1, size)
                for places, ids in self.merged_together(symbols):
                    width, packed = 4 * ids.shape[1], ids.astype("<u4").tobytes()
                    self.memo.put([same[k] for k in places.tolist()], [packed[k : k + width] for k in range(0, len(packed), width)])

    def _merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and product in one number for each pair, or NO_MERGE."""
        keys = left << ID_BITS | right
        places = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[places] == keys, self.pair_values[places], NO_MERGE)

    def merged_together(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Apply the merges to pre-tokens of one size, a row each: row numbers and their ids.

        In each step every row merges its leftmost pair of lowest rank, so that all rows that
        go on stay of one size; those without a pair are done.
        """
        ids = self.inner_ids[symbols]
        ids[:, -1] = self.last_ids[symbols[:, -1]]
        rows = np.arange(len(ids))
        found = self._merges(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if not found.shape[1]:
                yield rows, ids
                return
            at = found.argmin(1)
            least = np.take_along_axis(found, at[:, None], 1)[:, 0]
            goes = least != NO_MERGE
            if not goes.all():
                yield rows[~goes], ids[~goes]
                rows, ids, found, at, least = rows[goes], ids[goes], found[goes], at[goes], least[goes]
                if not len(rows):
                    return
            number, width = np.arange(len(rows)), ids.shape[1] - 1
            columns = np.arange(width)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
            ids[number, at] = least & ((1 << ID_BITS) - 1)
            columns = np.arange(width - 1)
            found = np.take_along_axis(found, columns + (columns >= at[:, None]), 1)
            has = np.flatnonzero(at > 0)
            found[has, at[has] - 1] = self._merges(ids[has, at[has] - 1], ids[has, at[has]])
            has = np.flatnonzero(at < width - 1)
            found[has, at[has]] = self._merges(ids[has, at[has]], ids[has, at[has] + 1])

    def stream(self, data: bytes) -> Iterator[int]:
        """Ids of one pre-token, emitted as soon as they are stable."""
        at = 0
        while len(data) - at > self.window:
            stable = self.window - self.lookahead
            end = 0
            for token in self.merged([self.inner[b] for b in data[at : at + self.window]]):
                end += self.symbols[token]
                if end > stable:
                    end -= self.symbols[token]
                    break
                yield token
            at += end
        rest = data[at:]
        if rest:
            yield from self.merged([*(self.inner[b] for b in rest[:-1]), self.last[rest[-1]]])

    def merged(self, ids: list[int]) -> list[int]:
        """Apply the merges to symbols, lowest rank first, then leftmost."""
        if len(ids) > 48:
            return self.merged_by_heap(ids)
        find, none, product = self.pairs.get, 1 << 62, (1 << ID_BITS) - 1
        found = [find(a << ID_BITS | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while found and (least := min(found)) != none:
            i = found.index(least)
            del found[i], ids[i]
            ids[i] = new = least & product
            if i:
                found[i - 1] = find(ids[i - 1] << ID_BITS | new, none)
            if i < len(found):
                found[i] = find(new << ID_BITS | ids[i + 1], none)
        return ids

    def merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same for many symbols, in n log n steps."""
        n, find, product = len(ids), self.pairs.get, (1 << ID_BITS) - 1
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(found, i) for i in range(n - 1) if (found := find(ids[i] << ID_BITS | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            found, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or find(ids[i] << ID_BITS | ids[j]) != found:
                continue
            ids[i], ids[j], after[i] = found & product, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (found := find(ids[a] << ID_BITS | ids[b])) is not None:
                    heapq.heappush(heap, (found, a))
        return [x for x in ids if x >= 0]

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text in its normal form."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # Sigma is lowered by itself, without a look at the end of the word.
            return WORDS(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        return NEAR_WORDS(text.lower())  # always in normal form

    def _segments(self, text: str) -> Iterator[str | int]:
        """Parts of a text of some GROUP characters, and the ids of special tokens between them."""
        at = 0
        ends = [(m.start(), m.end()) for m in self.at_special.finditer(text)] if "<|" in text else []
        for end, further in [*ends, (len(text), len(text))]:
            while at < end:
                found = AT_BLANK.search(text, at + GROUP, end) if end - at > GROUP else None
                stop = found.start() if found else end
                yield text[at:stop]
                at = stop
            if further > end:
                yield self.special[text[end:further]]
            at = further

    def encoded(self, texts: Iterable[str | None]) -> Iterator[tuple[int, bytes]]:
        """Packed ids of texts: the place of the text, and one of its pieces, in their order."""
        waiting: list[tuple[int, list[str] | bytes]] = []
        size = 0
        for place, text in enumerate(texts):
            for part in self._segments(text or ""):
                if isinstance(part, int):
                    waiting.append((place, struct.pack("<I", part)))
                    continue
                if size and size + len(part) > GROUP:
                    yield from self._looked_up(waiting)
                    waiting, size = [], 0
                waiting.append((place, self.words(part)))
                size += len(part)
        yield from self._looked_up(waiting)

    def _looked_up(self, waiting: list[tuple[int, list[str] | bytes]]) -> Iterator[tuple[int, bytes]]:
        words = set().union(*(x for _, x in waiting if isinstance(x, list)))
        self.learn(self.memo.unknown(words))
        known = self.memo.young.__getitem__
        for place, part in waiting:
            yield place, b"".join(map(known, part)) if isinstance(part, list) else part
        self.memo.trim()

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a text; strings of special tokens become their ids."""
        return b"".join(packed for _, packed in self.encoded([text]))

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary's own strings, a space between two, as without a decoder."""
        return Decoder(self).feed(ids)


class Decoder:
    """Ids to text, fed piece by piece.

    By itself the text are the vocabulary's own strings with a space between two; `as_bytes`
    gives the bytes of the tokens, word ends as spaces.
    """

    def __init__(self, machine: Encoder, as_bytes: bool = False):
        self.tokens, self.bytes = machine.tokens, machine.bytes
        self.unfinished = codecs.getincrementaldecoder("utf-8")("replace") if as_bytes else None
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        if self.unfinished is not None:
            return self.unfinished.decode(b"".join(map(self.bytes.__getitem__, ids)))
        strings = list(map(self.tokens.__getitem__, ids))
        if not strings:
            return ""
        text = " ".join(strings)
        if self.begun:
            return " " + text
        self.begun = True
        return text

    def end(self) -> str:
        """What is left at the end, of an unfinished character."""
        return "" if self.unfinished is None else self.unfinished.decode(b"", final=True)


def encoder(path: str) -> Encoder:
    """One encoder for each file in a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
