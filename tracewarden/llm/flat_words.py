"""Words of many texts at once: boundaries and 64-bit hashes on the flat UTF-8 bytes of a column.

Texts are taken in pieces of a few megabytes (one text at least), so a run of very long texts
stays small in memory. A word's hash is a polynomial over its bytes, read off running sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
_STRIDE = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(21).integers(1, 2 ** 63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(within) -> np.ndarray:
    """Membership of each byte value."""
    return np.array([within(b) for b in range(256)])


SPACE_WORDS = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LINES = byte_set(lambda b: b != 0x0A)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base ** (0 .. n - 1) modulo 2 ** 64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, _STRIDE + 1), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:n]


class Spans:
    """Runs of member bytes in texts laid end to end; no run crosses from one text to the next."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, members: np.ndarray):
        inside = members[data]
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        begin[heads], last[tails] = inside[heads], inside[tails]
        self.data, self.offsets, self.inside = data, offsets, inside
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
        # runs of text i: first[i] up to first[i + 1]
        self.first = np.searchsorted(self.starts, offsets)

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def owner(self) -> np.ndarray:
        """The text of each run."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        out = np.zeros(len(self.starts), np.uint64)
        at, back = 0, pow(_ODD, -1, 1 << 64)
        while at < len(out):
            low = self.starts[at]
            upto = max(at + 1, int(np.searchsorted(self.ends, low + _STRIDE, "right")))
            part = self.data[low:self.ends[upto - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTES[part] * _powers(len(part), _ODD), out=sums[1:])
            begin, end = self.starts[at:upto] - low, self.ends[at:upto] - low
            out[at:upto] = (sums[end] - sums[begin]) * _powers(len(part) + 1, back)[begin] + end.astype(np.uint64) - begin.astype(np.uint64)
            at = upto
        return mix(out)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k runs from each place on, and whether they lie in one text."""
        n = max(0, len(self.starts) - k + 1)
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(_ODD) + self.hashes[i:n + i]
        return mix(out), self.owner[:n] == self.owner[k - 1:n + k - 1]

    def per_text(self, flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sum of flags between each two bounds."""
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, places, values = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[pa.Array]:
    """Consecutive parts of the column with about that many bytes each."""
    _, offsets = flat(column)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield column.slice(at, upto - at)
        at = upto
