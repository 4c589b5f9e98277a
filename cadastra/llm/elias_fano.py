"""Elias-Fano coding of ascending integers: near-minimal space, with select in constant time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 64


@dataclass(frozen=True)
class EliasFano:
    """n ascending values below 2 ** 63: `width` low bits each, and the high parts in unary.

    The k-th value has its bit in `high` at (value >> width) + k. `samples` holds the bit of every 64th value, so
    `select` looks at one stretch of `high` only.
    """

    n: int
    width: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        if values[0] < 0 or (np.diff(values) < 0).any():
            raise ValueError("values must ascend from 0 on")
        width = max(0, int(values[-1] // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        at = (values >> width) + np.arange(n)
        unary = np.zeros(int(at[-1]) + 1, np.uint8)
        unary[at] = 1
        return cls(n, width, low, np.packbits(unary, bitorder="little").tobytes(), at[::SAMPLE].astype("<u4").tobytes())

    def _low(self, first: int, count: int) -> np.ndarray:
        if not self.width:
            return np.zeros(count, np.int64)
        a, b = first * self.width, (first + count) * self.width
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8)[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]
        return bits.reshape(count, self.width).astype(np.int64) @ (np.int64(1) << np.arange(self.width, dtype=np.int64))

    def all(self) -> np.ndarray:
        """Every value."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        return ((ones - np.arange(self.n)) << self.width) | self._low(0, self.n)

    def select(self, k: int) -> int:
        """The k-th value, from 0 on."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        marks = np.frombuffer(self.samples, "<u4")
        first = int(marks[k // SAMPLE])
        last = int(marks[k // SAMPLE + 1]) if k // SAMPLE + 1 < len(marks) else len(self.high) * 8
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[first // 8 : -(-last // 8)], bitorder="little")[first % 8 :]
        at = first + int(np.flatnonzero(bits)[k % SAMPLE])
        return ((at - k) << self.width) | int(self._low(k, 1)[0])
