"""Words of whole Arrow text columns as numpy arrays: places, hashes, bytes.

A word is a maximal run of ASCII digits, ASCII letters (A-Z lower-cased) and
characters beyond ASCII, that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing.
In UTF-8 every byte of a character beyond ASCII is 0x80 or more, so the rule is
applied byte by byte without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; only a single longer text makes a larger slice.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 16
_BASE = 0x9E3779B97F4A7C15


class Words(NamedTuple):
    low: np.ndarray  # lower-cased bytes of the slice, 0 between words
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row of the slice each word is in
    hash: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""

    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    column: pa.Array, most: int = SLICE_BYTES, most_rows: int = SLICE_ROWS
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows holding about ``most`` bytes."""

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = utf8(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        stop = min(max(stop, row + 1), row + most_rows, rows)
        part = offsets[row : stop + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = stop


def _word_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


WORD_BYTES = _word_table()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""

    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of byte ranges from running polynomial sums; keeps the powers between calls."""

    def __init__(self) -> None:
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        back = pow(_BASE, -1, 1 << 64)
        self.powers = np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        self.backs = np.cumprod(np.full(n, back, np.uint64), dtype=np.uint64)

    def ranges(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.uint64)
        k = 0
        while k < len(start):
            first = start[k]
            stop = max(int(np.searchsorted(end, first + (1 << 18), side="right")), k + 1)
            last = int(end[stop - 1])
            if last - first > len(self.powers):
                self._grow(int(last - first))
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(low[first:last] * self.powers[: last - first], dtype=np.uint64, out=sums[1:])
            a, b = start[k:stop] - first, end[k:stop] - first
            out[k:stop] = mix((sums[b] - sums[a]) * self.backs[a])
            k = stop
        return out


def words_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> Words:
    """Words of a slice. Texts are told apart by ``offsets`` alone, without a separator."""

    low = WORD_BYTES[data]
    if not len(low):
        none = np.zeros(0, np.int64)
        return Words(low, none, none, none, np.zeros(0, np.uint64))
    inside = low != 0
    before = np.zeros(len(low), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(low), bool)
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(low))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(low, start, end, doc, hasher.ranges(low, start, end))


def counts_by_doc(doc: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(doc, minlength=rows).astype(np.int64)
