"""Word shingles of Arrow texts as 64-bit hashes, vectorised."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from shopcube.llm.words import text_buffers

K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end); words lose the case of A-Z."""
    data, off = text_buffers(arr)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    first = np.zeros(len(data), bool)
    first[off[:-1][off[:-1] < len(data)]] = True
    start = ~blank
    start[1:] &= blank[:-1] | first[1:]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    letters = data[~blank]
    upper = (letters >= 0x41) & (letters <= 0x5A)
    letters = letters + (upper.astype(np.uint8) << 5)
    kept_before = np.concatenate([[0], np.cumsum(~blank, dtype=np.int64)])
    ends = np.append(kept_before[starts], len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    d = words.dictionary_encode()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, d.dictionary.to_pylist()), np.uint64, len(d.dictionary))
    return known[d.indices.to_numpy()], np.searchsorted(starts, off)


def shingle_sets(arr: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, first one of each text and the end).

    A text of fewer words than ``width`` (one at least) is one shingle.
    """
    h, bounds = word_hashes(arr)
    n = np.diff(bounds)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    ends = np.cumsum(count)
    out = np.empty(int(count.sum()), np.uint64)
    if len(h) >= width:
        x = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            x = mix(x * K1 + h[k:len(h) - width + 1 + k] * K2)
    for i, (a, b, e, c) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), ends.tolist(), count.tolist())):
        if not c:
            continue
        if b - a >= width:
            s = x[a:b - width + 1].copy()
            s.sort()
            out[e - c:e] = s
        else:
            y = np.full(1, np.uint64(b - a), np.uint64)
            for k in range(a, b):
                y = mix(y * K1 + h[k:k + 1] * K2)
            out[e - c] = y[0]
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[(ends - count)[count > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[np.concatenate([[0], ends])]


def sketch(sets: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketches: texts x ``size`` coordinates (all ones for empty sets).

    In round i every element throws one value into a hashed bin; values of
    an earlier round are always lower.  From round ``size`` on, the bin is
    the round's number, so each coordinate fills after 2 * size rounds at
    most; a text leaves when its bins are full, which takes one or two
    rounds for large sets.
    """
    n = np.diff(bounds)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(n), size), empty, np.uint64)
    flat = out.reshape(-1)
    live = np.flatnonzero(n)
    doc = np.repeat(np.arange(len(n)), n)
    element = sets
    for i in range(2 * size):
        if not len(live):
            break
        h = mix(element * K2 + np.uint64((i + 1) * int(K1) & (1 << 64) - 1))
        bins = (h % np.uint64(size)).astype(np.int64) if i < size else np.int64(i - size)
        value = (np.uint64(i) << np.uint64(52)) | (mix(h) >> np.uint64(12))
        np.minimum.at(flat, doc * size + bins, value)
        full = (out[live] != empty).all(axis=1)
        if full.any():
            live = live[~full]
            left = np.zeros(len(n), bool)
            left[live] = True
            stay = left[doc]
            doc, element = doc[stay], element[stay]
    return out
