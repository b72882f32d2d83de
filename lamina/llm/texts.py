"""Vectorised words and hashes over the UTF-8 buffers of Arrow columns.

Everything here works on a slice of an Arrow batch at a time, some MB of text,
so the memory of a task is bounded by that or by its longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WINDOW_BYTES = 1 << 18  # of text whose words and windows are hashed at once: some arrays of 8 bytes a byte of it
_ODD = np.uint64(0x9E3779B97F4A7C15)
_P = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each byte.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _grown_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_P, _INV):
        a = np.full(n + 1, base, dtype=np.uint64)
        a[0] = 1
        out.append(np.cumprod(a, out=a))
    return out[0], out[1]


_kept_powers = lru_cache(maxsize=1)(_grown_powers)
_KEPT = 1 << 19


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n + 1 powers. A worker keeps 8 MB of them; longer ones are made for a long text and go with it."""
    return _kept_powers(_KEPT) if n <= _KEPT else _grown_powers(n)


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit codes, in constant time each."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _powers(len(codes))
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The length goes in too, so a stretch of zeros is no empty one."""
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _ODD)

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all stretches of `length`."""
        n = max(0, len(self.sums) - length)
        h = (self.sums[length:] - self.sums[:n]) * self.down[:n]
        return mix(h + np.full(1, length, np.uint64) * _ODD)


@dataclass
class Slice:
    """Some rows of a batch: `data[offsets[i]:offsets[i + 1]]` is the text of row first + i."""

    first: int
    offsets: np.ndarray
    data: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string or binary column into slices of about `size` bytes, no row cut in two. Null: no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    null = np.asarray(column.is_null()) if column.null_count else np.zeros(n, bool)
    column = column.cast(pa.large_binary())  # stretches of bytes may begin or end inside a character
    column = column.fill_null(b"") if column.null_count else column
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(what, dtype=np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        own = offsets[first: last + 1]
        yield Slice(first, own - own[0], data[own[0]: own[-1]], null[first:last])
        first = last


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low: high + 1] = True
    return table


#: Words are what stands between blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def word_bounds(part: Slice, blanks: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words; `first[i]` is the index of row i's first word."""
    n = len(part.data)
    solid = np.zeros(n + 2, bool)
    np.logical_not(blanks[part.data], out=solid[1:-1])
    begins = solid[1:-1] & ~solid[:-2]
    stops = solid[1:-1] & ~solid[2:]
    edge = part.offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]  # a row's edge ends a word as a blank does
    begins[edge] |= solid[1:-1][edge]
    stops[edge - 1] |= solid[1:-1][edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, part.offsets)


def word_codes(part: Slice, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word; `lower` folds A-Z."""
    codes = BYTE_CODES[LOWER] if lower else BYTE_CODES
    return Rolling(codes[part.data])(starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class HashIndex:
    """64-bit keys to row numbers, filled and asked in whole arrays (open addressing)."""

    def __init__(self, room: int = 1 << 12):
        self._clear(room)

    def _clear(self, room: int) -> None:
        self.bits = max(4, int(room - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Keys are distinct and not in the index yet."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            there = self.rows >= 0
            keys = np.concatenate([self.keys[there], keys])
            rows = np.concatenate([self.rows[there], rows])
            self._clear(4 * len(keys))
        self.used += len(keys)
        slot, last = self._slot(keys), len(self.keys) - 1
        rows = rows.astype(np.int32)
        while len(keys):
            free = self.rows[slot] < 0
            self.rows[slot[free]] = rows[free]  # of several for one slot the last one stays
            won = free & (self.rows[slot] == rows)
            self.keys[slot[won]] = keys[won]
            keys, rows, slot = keys[~won], rows[~won], (slot[~won] + 1) & last

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, or -1."""
        last, slot = len(self.keys) - 1, self._slot(keys)
        out = self.rows[slot]
        todo = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        at = slot[todo]
        out[todo] = -1
        while len(todo):
            at = (at + 1) & last
            row = self.rows[at]
            hit = (self.keys[at] == keys[todo]) & (row >= 0)
            out[todo[hit]] = row[hit]
            more = ~hit & (row >= 0)
            todo, at = todo[more], at[more]
        return out


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    """A list column from flat values and the length of each row's list."""
    where = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=where[1:])
    return pa.ListArray.from_arrays(pa.array(where), pa.array(values, type=kind))
