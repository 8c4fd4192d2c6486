"""Span hashes of byte texts and the sampled suffixes (anchors) of their windows."""

from __future__ import annotations

import numpy as np

from .common import M1, byte_table, mix, powers

BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 1 << 64)
PLACE = 24  # bits of a hash that give way to the place in a piece


class Rolling:
    """Hashes of any span of a byte array from one pass of prefix sums."""

    def __init__(self, raw: np.ndarray, seed: int = 11):
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(byte_table(seed)[raw] * powers(BASE, len(raw)), out=self.total[1:])
        self.shift = powers(BACK, len(raw) + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.shift[starts] + (ends - starts).astype(np.uint64) * M1)

    def all_of(self, width: int) -> np.ndarray:
        """Hash of each span of ``width`` bytes."""
        n = len(self.total) - width
        return mix((self.total[width:] - self.total[:n]) * self.shift[:n] + M1 * np.array([width], np.uint64)) if n > 0 else np.zeros(0, np.uint64)


def smallest(code: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash (its upper bits; the last of equal ones) in each ``width`` hashes, of at most 2**PLACE."""
    n = len(code) - width + 1
    place = np.uint64((1 << PLACE) - 1)
    low = (code & ~place) | (place - np.arange(len(code), dtype=np.uint64))
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[width - span : width - span + n])
    return (place - (low & place)).astype(np.int64)


def anchors(raw: np.ndarray, borders: np.ndarray, depth: int, digit: int, rolling: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of ``depth`` bytes inside a text: runs of windows with the same anchor.

    A window's anchor is its ``digit``-byte string of smallest hash (the last of equal ones), so equal windows have equal
    anchors at equal places. Returns anchor, first window, last window, digit hash of each run.
    """
    code = rolling.all_of(digit)
    width = depth - digit + 1
    n = len(raw) - depth + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    at = np.empty(n, np.int64)
    step = (1 << PLACE) - width + 1  # a piece's digits, those of its last window included, have places of PLACE bits
    for a in range(0, n, step):
        many = min(step, n - a)
        at[a : a + many] = a + smallest(code[a : a + many + width - 1], width)
    fits = np.ones(n, bool)  # windows that end inside their text
    for edge in borders[1:-1]:
        fits[max(0, edge - depth + 1) : edge] = False
    windows = np.flatnonzero(fits)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    at = at[windows]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    return at[first], windows[first], windows[last], code[at[first]]
