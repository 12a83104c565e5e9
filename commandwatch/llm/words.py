"""Words of a text, their hashes, and hashes of runs of words, with numpy on UTF-8 bytes.

A word is a maximal run of bytes other than ASCII white space (space, tab to carriage
return), which on UTF-8 is the same as on characters. Hashes are 64 bits wide, the same in
every process. Texts are read in chunks cut at white space, so that scratch memory follows
the chunk and the longest word.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers at least of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 12)
        for k, base in enumerate((_BASE, _UNBASE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, in bytes."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def _hashed(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
    """One hash for each word of a text."""
    if starts is None:
        starts, ends = bounds(data)
    if len(data) <= CHUNK or not len(starts):
        return _hashed(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    found, first = [], 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + CHUNK, "right")))
        part = data[low : int(ends[last - 1])]
        found.append(_hashed(part, starts[first:last] - low, ends[first:last] - low))
        first = last
    return np.concatenate(found)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for each run of k words, by its first word; none if there are fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + hashes[j : j + n]
    return mixed(total)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")
