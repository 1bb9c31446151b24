"""A wavelet matrix over whole numbers: how many, which and the next value in a range, for many queries at once."""

from __future__ import annotations

import numpy as np

_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class _Bits:
    """A bit row with the number of ones before any place, 1.5 bits a bit."""

    def __init__(self, bits: np.ndarray):
        raw = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(raw)] = raw
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & _BELOW[at & 63])


class WaveletMatrix:
    def __init__(self, values: np.ndarray):
        """``values``: non-negative whole numbers, in the order that ranges refer to."""
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.rows, self.zeros = [], []
        for k in range(self.bits - 1, -1, -1):
            one = (values >> k & 1).astype(bool)
            self.rows.append(_Bits(one))
            self.zeros.append(len(values) - int(one.sum()))
            values = np.concatenate([values[~one], values[one]])

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range [left, right) are less than x (x within the bits of the values)."""
        count = np.zeros(len(x), np.int64)
        for i, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            one = (x >> (self.bits - 1 - i) & 1).astype(bool)
            l1, r1 = row.ones(left), row.ones(right)
            l0, r0 = left - l1, right - r1
            count += np.where(one, r0 - l0, 0)
            left, right = np.where(one, zeros + l1, l0), np.where(one, zeros + r1, r0)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th least value (from 0) of each range."""
        out = np.zeros(len(k), np.int64)
        for i, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            l1, r1 = row.ones(left), row.ones(right)
            l0, r0 = left - l1, right - r1
            one = k >= r0 - l0
            k = np.where(one, k - (r0 - l0), k)
            out |= one.astype(np.int64) << (self.bits - 1 - i)
            left, right = np.where(one, zeros + l1, l0), np.where(one, zeros + r1, r0)
        return out

    def successor(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value >= x in each range, or -1."""
        inside = x < 1 << self.bits
        skipped = np.where(inside, self.below(left, right, np.where(inside, x, 0)), right - left)
        there = skipped < right - left
        return np.where(there, self.nth(left, right, np.where(there, skipped, 0)), -1)
