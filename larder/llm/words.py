"""Words of many texts at once, as numpy arrays over the bytes of an Arrow string column.

A word is a run of bytes other than space and the controls 9 to 13.  Hashes are 64 bits wide and are the same in
every process.  All arrays are of the size of one slice of texts (`slices`), not of a whole partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every output bit depends on every input bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class _Table:
    """Powers of an odd number modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.values = base, _powers(base, 1024)

    def upto(self, count: int) -> np.ndarray:
        if count > len(self.values):
            self.values = _powers(self.base, max(count, 2 * len(self.values)))
        return self.values[:count]


_BYTE_UP, _BYTE_DOWN = (_Table(b) for b in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)))
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_UP = [_Table(b) for b in _BASES]
_DOWN = [_Table(pow(b, -1, 1 << 64)) for b in _BASES]
_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_LOWER_VALUE = _BYTE_VALUE[LOWER]


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as large_string without nulls (a null text is an empty one)."""
    col = batch.column(batch.schema.get_field_index(name))
    col = col.cast(pa.large_string())
    return col.fill_null("") if col.null_count else col


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text starts (one more entry than texts)."""
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together, or one longer text."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """The words of a slice of texts: `start` and `end` (bytes), `first` (word index at which each text starts).

    `cut` marks bytes before which a word ends even though it goes on.
    """

    def __init__(self, body: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None, cut: np.ndarray | None = None):
        self.body, self.off = body, off
        inside = ~SEPARATOR[body] if inside is None else inside
        fresh = np.ones(len(body) + 1, bool)  # no word goes on from the byte before
        fresh[1:-1] = ~inside[:-1]
        fresh[off] = True
        if cut is not None:
            fresh[:-1] |= cut
        self.start = np.flatnonzero(inside & fresh[:-1])
        last = inside.copy()
        last[:-1] &= fresh[1:-1] | ~inside[1:]
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, off)

    def hashes(self, lower: bool = False) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, U64)
        value = (_LOWER_VALUE if lower else _BYTE_VALUE)[self.body]
        value *= _BYTE_UP.upto(len(value))
        total = np.zeros(len(value) + 1, U64)
        np.cumsum(value, out=total[1:])
        length = (self.end - self.start).astype(U64)
        return mix((total[self.end] - total[self.start]) * _BYTE_DOWN.upto(len(value))[self.start] + length)

    def text_of(self) -> np.ndarray:
        """The text (0, 1, ...) of each word."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.first))


def shingles(word: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of each run of `width` consecutive entries, also across texts; len(word) - width + 1 entries."""
    n = len(word)
    if n < width:
        return np.zeros(0, U64)
    total = np.zeros(n + 1, U64)
    np.cumsum((mix(word ^ U64(0xA24BAED4963EE407)) if which else word) * _UP[which].upto(n), out=total[1:])
    return mix((total[width:] - total[:-width]) * _DOWN[which].upto(n - width + 1))


def run_inside(first: np.ndarray, width: int) -> np.ndarray:
    """Mask over the runs of `width` words: those that lie in one text."""
    n = int(first[-1])
    if n < width:
        return np.zeros(0, bool)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return left[: n - width + 1] >= width


def covered(mask: np.ndarray, width: int, total: int) -> np.ndarray:
    """Words that lie in a marked run of `width` words."""
    step = np.zeros(total + 1, np.int64)
    at = np.flatnonzero(mask)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return np.cumsum(step[:-1]) > 0
