"""Content-defined anchors for repeated byte windows, vectorised.

Every window of ``window`` bytes is represented by its anchor: the start of
the q-gram in it with the least hash (leftmost of equals).  Equal windows
have equal anchors at equal offsets.  Successive windows with the same anchor
make a *block*; a block's bytes run from its first window's start to its last
window's end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from shopcube.llm.shingles import mix

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_POS = np.uint64((1 << 31) - 1)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, .. modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


class Fingerprints:
    """Hashes of any substrings of ``data`` (64 bits; equal strings, equal hashes)."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=self.sums[1:], dtype=np.uint64)
        self.back = powers(_BACK, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def grams(self, q: int) -> np.ndarray:
        """Hash of every substring of ``q`` bytes."""
        n = len(self.sums) - q
        return mix((self.sums[q:] - self.sums[:n]) * self.back[:n] + np.uint64(q)) if n > 0 else np.zeros(0, np.uint64)


@dataclass
class Blocks:
    """Blocks of some texts: byte of the first window, number of windows, anchor byte, hash of the
    anchor's q-gram, hash of the block's bytes."""
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray
    content: np.ndarray


def blocks(data: np.ndarray, offsets: np.ndarray, prints: Fingerprints, q: int, window: int) -> Blocks:
    none = np.zeros(0, np.int64)
    long_ = np.diff(offsets) >= window
    if not long_.any():
        return Blocks(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    grams = prints.grams(q)
    # order by 33 bits of the hash, then by position; leftmost least in each run of `span` positions
    order = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
    span, width, least = window - q + 1, 1, order
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        gap = span - width
        least = np.minimum(least[:-gap], least[gap:])
    valid = np.zeros(len(data) + 1, np.int8)
    lo, hi = offsets[:-1][long_], offsets[1:][long_] - window + 1
    np.add.at(valid, lo, 1)
    np.add.at(valid, hi, -1)
    at = np.flatnonzero(np.cumsum(valid[:len(least)]))
    anchor = (least[at] & _POS).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, anchor = at[first], anchor[first]
    return Blocks(start, count, anchor, grams[anchor],
                  prints.of(start, start + count - 1 + window))
