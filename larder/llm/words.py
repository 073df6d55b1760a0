"""Words, word hashes and hashes of consecutive words, over a batch of texts at a time.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; these bytes never occur inside
a longer UTF-8 sequence, so bytes and code points give the same words. Hashes are 64-bit sums of
random values per byte times powers of an odd multiplier, mixed at the end; `lane` picks one of
several independent functions, and two lanes together serve as 128-bit keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
#: Bytes of text that are handled at once; bounds the temporary arrays.
SLICE_BYTES = 1 << 20


@lru_cache(None)
def _values(lane: int) -> np.ndarray:
    out = np.random.Generator(np.random.PCG64(1000 + lane)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out[_SPACE] = 0
    return out


@lru_cache(None)
def _odd(lane: int) -> int:
    return int(np.random.Generator(np.random.PCG64(2000 + lane)).integers(1 << 62, 1 << 63)) | 1


@lru_cache(4)
def _powers(lane: int, size: int) -> np.ndarray:
    out = np.full(size, _odd(lane), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: byte spans, and for text i the words first[i] to first[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
        self.data, self.offsets, self.between = data, offsets, between
        if len(data) == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        word = ~between[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = word
        before[offsets] = False
        self.starts = np.flatnonzero(word & ~before[:-1])
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = word
        after[offsets] = False
        self.ends = np.flatnonzero(word & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def _terms(self, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the first word on: each byte's place in its word, its part of the word's hash, and where words begin."""
        begin = self.starts[0]
        at = np.arange(begin, len(self.data)) - np.repeat(self.starts, np.diff(np.append(self.starts, len(self.data))))
        size = max(1024, 1 << int(at.max() + 1).bit_length())
        values = _values(lane)[self.data[begin:]] * _powers(lane, size)[at]
        if self.between is not _SPACE:
            values[self.between[self.data[begin:]]] = 0
        return at, values, self.starts - begin

    def hashes(self, lane: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        if len(self.starts) == 0:
            return np.zeros(0, np.uint64)
        _, values, begins = self._terms(lane)
        return mixed(np.add.reduceat(values, begins))

    def with_prefixes(self, lane: int, prefixes: tuple[int, ...]) -> dict[int | None, np.ndarray]:
        """Hashes of the words (at None) and of their first bytes, by how many."""
        if len(self.starts) == 0:
            return dict.fromkeys((None, *prefixes), np.zeros(0, np.uint64))
        at, values, begins = self._terms(lane)
        out = {None: mixed(np.add.reduceat(values, begins))}
        for p in sorted(prefixes, reverse=True):
            values[at >= p] = 0
            out[p] = mixed(mixed(np.add.reduceat(values, begins)) + np.uint64(p))
        return out

    def runs(self, hashes: np.ndarray, length: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The first word of every run of `length` words of one text, and the runs' hashes."""
        n = len(hashes) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        odd = np.uint64(_odd(100 + lane))
        out = hashes[:n].copy()
        for k in range(1, length):
            out *= odd
            out += hashes[k : k + n]
        room = np.ones(n, bool)
        for a, b in zip(self.first[:-1], self.first[1:]):  # not over the end of a text
            room[max(a, b - length + 1) : b] = False
        at = np.flatnonzero(room)
        return at, mixed(out[at])


def slices(texts: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES, between: np.ndarray = _SPACE) -> Iterator[tuple[int, Words]]:
    """(index of the first text, words) of consecutive texts of about `size` bytes; nulls are empty."""
    row = 0
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if len(chunk) == 0:
            continue
        if chunk.null_count:
            chunk = chunk.fill_null("")
        chunk = chunk.cast(pa.large_binary())
        _, ends, data = chunk.buffers()
        offsets = np.frombuffer(ends, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(chunk):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
            yield row + i, Words(whole[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], between)
            i = j
        row += len(chunk)
