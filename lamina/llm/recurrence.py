"""Where do windows of `length` symbols recur? Shared by the substring operators.

Symbols are words or bytes, each with a 64-bit code. In each window of `length`
symbols the smallest of its hashed `gram`s is its anchor (the first, in a tie).
Equal windows have equal anchors. Neighbouring windows with one anchor are a run,
about 2 / (length - gram + 2) of all positions. A run's `spot` is its
anchor's hash, its `shape` the hash of the whole stretch that its windows cover.

Runs of one spot and one shape are equal in all their windows. Only runs of a spot
with several shapes, at the edges of shared passages, are compared
window by window, one run for each shape.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from lamina.llm.texts import Rolling, sliding_min

_HIGH = np.uint64(0xFFFFFFFF00000000)


@dataclass
class Runs:
    row: np.ndarray  # index of the document
    start: np.ndarray  # first window's first symbol, counted in the document
    windows: np.ndarray  # number of windows
    spot: np.ndarray
    shape: np.ndarray


def runs(codes: np.ndarray, first: np.ndarray, length: int, gram: int) -> Runs:
    """Runs of documents whose symbols are `codes[first[i]:first[i + 1]]`."""
    n = len(codes) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64))
    rolling = Rolling(codes)
    grams = rolling.windows(gram)
    placed = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(placed, length - gram + 1) & ~_HIGH).astype(np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    inside = np.arange(n) + length <= first[1:][row]
    begins = inside.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (row[1:] != row[:-1])
    stops = inside.copy()
    stops[:-1] &= begins[1:] | ~inside[1:]
    a, b = np.flatnonzero(begins), np.flatnonzero(stops)
    return Runs(row[a], a - first[row[a]], b - a + 1, grams[anchor[a]], rolling(a, b + length))
