"""Words and shingles of whole Arrow columns of text as 64-bit hashes, a few numpy passes over the bytes at a time.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES | 32, _BYTES).astype(np.uint8)
IS_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_VALUE[IS_SPACE] = 0
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full((1 << 12) - 1, _ODD), dtype=np.uint64)])
END = mix(np.array([0x656E64], np.uint64))[0]  # the token that closes a text


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each text begins; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at.astype(np.int64)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts of its texts with the end) of runs of whole texts of about ``limit`` bytes."""
    data, at = column_bytes(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = int(np.searchsorted(at, at[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


@dataclass
class Words:
    hashes: np.ndarray  # uint64 of each word
    bounds: np.ndarray  # first word of each text, and the end
    stems: tuple[np.ndarray, ...] = ()  # uint64 of each word's first bytes; a short word's own hash

    def of(self, text: int) -> np.ndarray:
        return self.hashes[self.bounds[text]:self.bounds[text + 1]]


def words(data: np.ndarray, starts: np.ndarray, stems: tuple[int, ...] = ()) -> Words:
    """Words of consecutive texts; ``starts`` holds their first bytes and the end, ``stems`` lengths in bytes."""
    nothing = np.zeros(0, np.uint64)
    if len(data) == 0:
        return Words(nothing, np.zeros(len(starts), np.int64), (nothing,) * len(stems))
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = starts[:-1][starts[:-1] < len(data)]
    begins[first] = inside[first]
    at = np.flatnonzero(begins)
    bounds = np.searchsorted(at, starts).astype(np.int64)
    if len(at) == 0:
        return Words(nothing, bounds, (nothing,) * len(stems))
    lead = int(at[0])
    spans = np.diff(np.append(at, len(data)))
    place = np.arange(len(data) - lead, dtype=np.int64)
    place -= np.repeat(at - lead, spans)
    values = _VALUE[LOWER[data[lead:]]]
    values *= _POWERS[place & (len(_POWERS) - 1)]
    cut = tuple(mix(np.add.reduceat(np.where(place < n, values, np.uint64(0)), at - lead)) for n in stems)
    return Words(mix(np.add.reduceat(values, at - lead)), bounds, cut)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; the last ``size - 1`` words begin none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _ODD
        out += hashes[k:n + k]
    return mix(out)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of a text in the order of signed longs; with fewer words than ``size``, the whole text as one;
    empty without words."""
    if len(hashes) == 0:
        return hashes
    if len(hashes) < size:
        return runs(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(runs(hashes, size).view(np.int64)).view(np.uint64)


class HashTable:
    """uint64 keys to values by linear probing, as plain arrays that broadcast well; a key of zero counts as one."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, values.dtype)
        keys = np.maximum(keys, np.uint64(1))
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.keys[at] == 0
            place, who = np.unique(at[free], return_index=True)
            took = left[free][who]
            self.keys[place], self.values[place] = keys[took], values[took]
            stay = np.ones(len(left), bool)
            stay[np.flatnonzero(free)[who]] = False
            left, at = left[stay], (at[stay] + 1) & self.mask

    def plain(self) -> tuple:
        """What a broadcast carries; executors need no class of this package to read it."""
        return self.shift, self.mask, self.keys, self.values

    @classmethod
    def of(cls, plain: tuple) -> HashTable:
        table = cls.__new__(cls)
        table.shift, table.mask, table.keys, table.values = plain
        return table

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, and whether it is there."""
        at = self._home(keys)
        there = self.keys[at]
        hit = there == keys
        open_ = np.flatnonzero(~hit & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            there = self.keys[at[open_]]
            same = there == keys[open_]
            hit[open_[same]] = True
            open_ = open_[~same & (there != 0)]
        return at, hit
