"""Words of whole texts as NumPy arrays: boundaries, hashes and hashes of word windows.

Words are runs of bytes other than space and 0x09-0x0D. All functions work on a block of
texts at once, so the cost is a few array passes per byte and no Python step per word.
Hashes have 64 bits; a window's hash comes from two prefix sums, whatever its length.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def powers(base: np.uint64, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse, modulo 2**64, for i below ``count``."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) < count:
        size = max(1 << 12, 1 << int(count - 1).bit_length())
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        known = tuple(
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64))))
            for x in (base, inverse)
        )
        _POWERS[int(base)] = known
    return known[0][:count], known[1][:count]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span; equal sequences have equal hashes."""
    forth, back = powers(base, len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * forth[:-1], out=sums[1:])
    length = (end - start).astype(np.uint64)
    return mix64((sums[end] - sums[start]) * back[start] + length * np.uint64(0xE7037ED1A0B428DB))


@dataclass
class Block:
    """Words of the texts in rows ``first_row`` on; ``first[d]:first[d + 1]`` are those of text d."""

    first_row: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word (within the block) of every window of ``length`` words."""
        count = np.maximum(self.counts - length + 1, 0)
        text = np.repeat(np.arange(self.texts), count)
        before = np.cumsum(count) - count
        word = np.arange(len(text)) - before[text] + self.first[:-1][text]
        return span_hashes(self.hashes, word, word + length, _WORD_BASE), text, word

    def whole(self) -> np.ndarray:
        """A hash of each text's word sequence."""
        return span_hashes(self.hashes, self.first[:-1], self.first[1:], _WORD_BASE)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def row_blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``size`` bytes, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


def blocks(column: pa.Array, lower: bool, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's rows in order, cut into blocks of whole texts."""
    data, offsets = raw_bytes(column)
    for row, stop in row_blocks(offsets, size):
        part = data[offsets[row] : offsets[stop]]
        yield word_block(part, offsets[row : stop + 1] - offsets[row], lower, row)


def word_block(data: np.ndarray, offsets: np.ndarray, lower: bool, first_row: int = 0) -> Block:
    if lower:
        data = _LOWER[data]
    inside = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # a text starts or ends before this byte
    cut[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:-1]
    closes[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = span_hashes(_BYTE_VALUES[data], start, end, _BYTE_BASE)
    return Block(first_row, data, start, end, np.searchsorted(start, offsets), hashes)


def as_longs(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def release() -> None:
    """Give memory that is not in use back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def released(batches: Iterator) -> Iterator:
    """The batches; when a task is done, its worker gives unused memory back, as it may live through many stages."""
    yield from batches
    _POWERS.clear()
    gc.collect()
    release()
