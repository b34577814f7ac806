"""Vectorised work on UTF-8 bytes: words, fingerprints, windows' least members."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240601)
#: A 64-bit value for each byte, and odd multipliers.
BYTE_VALUE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
ODD = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(ODD[0])
BASE_INVERSE = pow(BASE, -1, 2**64)

#: Bytes that separate words: blank and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        made = []
        for base in (BASE, BASE_INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _POWERS = made[0], made[1]
    return _POWERS[0][:n], _POWERS[1][:n]


class Prints:
    """Fingerprints of any stretch of a value sequence, each from two prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers, self.inverse = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of ``[start, end)``; equal stretches give equal prints wherever they stand."""
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * ODD[1])


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def words(raw: np.ndarray, at: np.ndarray, separators: np.ndarray = SPACE):
    """Start and end of every word, and the text it belongs to. ``at``: texts' offsets."""
    inside = ~separators[raw]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def word_prints(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Prints(BYTE_VALUE[raw]).of(start, end)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least value (the first of equal ones) in each window of ``width``."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best[:n]
