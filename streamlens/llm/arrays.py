"""Texts as flat arrays: words, their hashes and n-gram hashes, without a loop over rows.

Hashes are fixed 64-bit functions of the bytes, the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection."""
    values = values ^ (values >> U64(33))
    values = values * U64(0xFF51AFD7ED558CCD)
    values ^= values >> U64(33)
    values *= U64(0xC4CEB9FE1A85EC53)
    values ^= values >> U64(33)
    return values


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, U64(base), dtype=U64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHash:
    """Polynomial hashes of any slice of a sequence, from prefix sums modulo 2^64."""

    def __init__(self, base: int):
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.empty(0, dtype=U64)

    def _grow(self, count: int) -> None:
        if len(self._up) < count:
            size = max(count, 2 * len(self._up))
            self._up, self._down = _powers(self._base, size), _powers(self._inverse, size)

    def of(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        sums = np.empty(len(values) + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(values * self._up[: len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self._down[starts])


_BYTES = PrefixHash(0xD1342543DE82EF95)
_WORDS = PrefixHash(0xA0761D6478BD642F)
_BYTE_CODES = mix((np.arange(1, 257, dtype=U64) * U64(_GOLDEN)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_CODES = _BYTE_CODES[_LOWER]
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U64)
# Longer words are hashed by prefix sums, so that their length never counts steps.
LONG_WORD = 64


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the row offsets into them; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or not len(texts):
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by one sort; ``np.unique`` hashes integers first, which takes longer."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    new = values[1:] != values[:-1]
    return values if new.all() else values[np.append(True, new)]


@dataclass
class Words:
    """The words of consecutive rows; ``bounds[i]:bounds[i + 1]`` are those of row i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        codes = (_LOWER_CODES if lower else _BYTE_CODES)[self.data]
        return _BYTES.of(codes, self.starts, self.ends)

    def quick_hashes(self, lower: bool = False) -> np.ndarray:
        """Other hashes than those of ``hashes``, in less time: eight bytes of all words at once."""
        data = np.zeros(len(self.data) + 8, dtype=np.uint8)
        data[:-8] = _LOWER[self.data] if lower else self.data
        eight = np.ndarray((len(self.data) + 1,), "<u8", data, strides=(1,))
        length = self.ends - self.starts
        found = mix((eight[self.starts] & _FIRST_BYTES[np.minimum(length, 8)]) ^ (length.astype(U64) * U64(_GOLDEN)))
        at, more = 8, np.flatnonzero(length > 8)
        while len(more) and at < LONG_WORD:
            some = eight[self.starts[more] + at] & _FIRST_BYTES[np.minimum(length[more] - at, 8)]
            found[more] = mix(found[more] * U64(0xD1342543DE82EF95) ^ some)
            at += 8
            more = more[length[more] > at]
        if len(more):
            found[more] = mix(_BYTES.of(_BYTE_CODES[data[:-8]], self.starts[more], self.ends[more]) ^ U64(LONG_WORD))
        return found


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each slice of bytes."""
    return _BYTES.of(_BYTE_CODES[data], starts, ends)


def _in_words(data: np.ndarray) -> np.ndarray:
    """Whether a byte is not white space, which is 0x20 and 0x09 to 0x0D."""
    return (data != 0x20) & ((data - np.uint8(0x09)) > 0x0D - 0x09)


def split_words(texts: pa.Array) -> Words:
    """Maximal runs of anything but white space, row by row."""
    data, offsets = flat_bytes(texts)
    if not len(data):
        none = np.empty(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64))
    inside = _in_words(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window of ``size`` items that lies in one row, and its row."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(rows)) - first[rows] + bounds[:-1][rows], rows


def sequence_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each slice of a sequence of word hashes."""
    return _WORDS.of(words, starts, ends)


def sliced(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = flat_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
