"""Words of Arrow text columns as NumPy arrays: places, documents and 64-bit hashes, without a Python object per word.

A word is a maximal run of bytes other than space and \\x09-\\x0D, which in UTF-8 is the regular expression
``[^\\x20\\x09-\\x0D]+`` over characters. Hashes are polynomial (Rabin-Karp) sums modulo 2^64 over mixed symbols,
so that the hash of any range is the difference of two prefix sums times a power of the inverse base.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, dtype=bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def grow(b: int) -> np.ndarray:
                steps = np.full(max(n, SLICE_BYTES + 1), b, dtype=np.uint64)
                steps[0] = 1
                return np.cumprod(steps)

            self.up, self.down = grow(self.base), grow(self.inverse)
        return self.up[:n], self.down[:n]

    def ranges(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of symbols[start:end] for each range."""
        up, down = self.to(len(symbols) + 1)
        sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * up[:-1], out=sums[1:])
        return (sums[ends] - sums[starts]) * down[starts]


BYTES, WORDS = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)
BYTE_SYMBOLS = mix(np.arange(256), 11)
LOWER_SYMBOLS = BYTE_SYMBOLS.copy()
LOWER_SYMBOLS[65:91] = BYTE_SYMBOLS[97:123]


@dataclass
class Words:
    """Words of the documents ``first`` .. ``first + docs`` of a batch."""

    first: int
    bounds: np.ndarray  # byte offsets of the documents in data, one more than documents
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # of each word, counted from first

    @property
    def docs(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.docs)

    def hashes(self, lower: bool = False) -> np.ndarray:
        symbols = (LOWER_SYMBOLS if lower else BYTE_SYMBOLS)[self.data]
        return mix(BYTES.ranges(symbols, self.starts, self.ends))

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of each k consecutive words of one document."""
        first = np.arange(max(0, len(hashes) - k + 1))
        if k > 1 and len(first):
            first = first[self.doc[: len(first)] == self.doc[k - 1 :]]
        return first, mix(WORDS.ranges(hashes, first, first + k), k)


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    if not large and column.type != pa.string():
        column = column.cast(pa.string())
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return bounds, np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of the column in slices of whole documents of about ``size`` bytes; a longer document is a slice alone."""
    offsets, data = texts(column)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield words_of(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def words_of(data: np.ndarray, bounds: np.ndarray, first: int = 0) -> Words:
    word = ~SPACES[data]
    start, end = word.copy(), word.copy()
    if len(data):
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        inner = bounds[(bounds > 0) & (bounds < len(data))]
        start[inner] = word[inner]
        end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(first, bounds, data, starts, ends, np.searchsorted(bounds, starts, side="right") - 1)


def release() -> None:
    """Give freed memory back to the system: idle Python workers stay alive beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then memory is released."""
    try:
        yield from batches
    finally:
        release()


def tidied(table: pa.Table) -> pa.Table:
    """The table, after memory is released."""
    release()
    return table


def planes(x: np.ndarray) -> bytes:
    """Bytes of a whole-number array, all first bytes before all second bytes: small numbers then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).reshape(-1)
