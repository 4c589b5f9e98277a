"""Words, shingles and their hashes for whole batches of texts at once, in NumPy.

A word is a run of bytes other than space and \\t-\\r, with A-Z in lower case; other letters stay as they are.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 0x1234567) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((_BASE, _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of its text."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1]
    begins = begins[begins < offsets[1:]]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[begins[1:] - 1] = solid[begins[1:] - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice: differences of prefix sums of a polynomial, so no slice is cut out."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * down[starts]
    return mixed(value)


def shingles(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words inside a text, and the index of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    with np.errstate(over="ignore"):
        total = np.zeros(len(at), np.uint64)
        for k in range(size):
            total = mixed(total * _BASE + words[at + k])
    return total, at


def run_hashes(value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the values from each `first` to each `last`, in order: differences of prefix sums of a polynomial."""
    up, down = _powers(len(value) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mixed(value, 400) * up[: len(value)], out=sums[1:])
        return mixed((sums[last + 1] - sums[first]) * down[first], 401)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start byte, end byte and text index of each word."""
    starts, ends, doc = spans(data, offsets)
    return hashes(LOWER[data], starts, ends), starts, ends, doc
