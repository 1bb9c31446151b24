"""Word places in Arrow texts, shared by the operators that work on whole words."""

from __future__ import annotations

import numpy as np


def word_spans(outside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, first word of each text and the end) of the words of some texts.

    ``outside``: for each byte, whether it belongs to no word; ``off``: first
    byte of each text and the end.  Words do not cross texts.
    """
    n = len(outside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = ~outside
    start[1:] &= outside[:-1] | edge[1:n]
    end = ~outside
    end[:-1] &= outside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, off)


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the words one after the other, offsets)."""
    size = ends - starts
    to = np.concatenate([[0], np.cumsum(size)])
    if not len(starts):
        return data[:0], to
    place = np.arange(int(to[-1])) + np.repeat(starts - to[:-1], size)
    return data[place], to


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the words, each followed by a space, offsets)."""
    size = ends - starts + 1
    to = np.concatenate([[0], np.cumsum(size)])
    if not len(starts):
        return data[:0], to
    place = np.arange(int(to[-1])) + np.repeat(starts - to[:-1], size)
    out = data[np.minimum(place, len(data) - 1)]
    out[to[1:] - 1] = 0x20
    return out, to
