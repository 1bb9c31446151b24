"""CRC-32 of words and word pairs of Arrow texts, vectorised.

The checksum of two strings in a row follows from the checksums of both: the
first is pushed through as many zero bytes as the second has, which is linear
in its bits, and added to the second.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from shopcube.llm.spans import packed, word_spans
from shopcube.llm.words import text_buffers

_TABLES = 64             # lengths whose shift is kept as tables; longer words take a call each
_shift: dict[int, np.ndarray] = {}


def shift_table(n: int) -> np.ndarray:
    """4 x 256 checksums: what each byte of a checksum becomes behind ``n`` more zero bytes."""
    if n not in _shift:
        zero = bytes(n)
        base = zlib.crc32(zero)
        bit = [zlib.crc32(zero, 1 << k) ^ base for k in range(32)]
        table = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for k in range(8):
                has = (np.arange(256) >> k & 1).astype(bool)
                table[byte, has] ^= np.uint32(bit[8 * byte + k])
        _shift[n] = table
    return _shift[n]


class Features:
    """The words of some texts with their checksums.

    ``bounds``: first word of each text and the end; ``crc``: checksum of each
    word; ``pair``: checksum of each word, a space and the next word;
    ``paired``: whether the next word stands in the same text.
    """

    def __init__(self, arr: pa.Array):
        data, off = text_buffers(arr)
        low = data + (((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) << 5)
        outside = (data < 0x30) | ((data >= 0x3A) & (data <= 0x60) & (low == data)) | ((data >= 0x7B) & (data <= 0x7F))
        starts, ends, self.bounds = word_spans(outside, off)
        raw, to = packed(low, starts, ends)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(to), pa.py_buffer(raw)])
        d = words.dictionary_encode()
        known = d.dictionary.to_pylist()
        ids = d.indices.to_numpy()
        of_word = np.fromiter(map(zlib.crc32, known), np.uint32, len(known))
        spaced = np.fromiter((zlib.crc32(b" ", int(c)) for c in of_word), np.uint32, len(known))
        size = np.fromiter(map(len, known), np.int64, len(known))
        self.crc = of_word[ids] if len(ids) else np.zeros(0, np.uint32)
        n = len(ids)
        self.paired = np.ones(max(n - 1, 0), bool)
        inner = self.bounds[(self.bounds > 0) & (self.bounds < n)]
        self.paired[inner - 1] = False
        self.pair = np.zeros(max(n - 1, 0), np.uint32)
        if n > 1:
            before, after = spaced[ids[:-1]], size[ids[1:]]
            slot = np.minimum(after, _TABLES)
            tables = np.stack([shift_table(k) for k in range(_TABLES)] + [np.zeros((4, 256), np.uint32)])
            for byte in range(4):
                self.pair ^= tables[slot, byte, (before >> np.uint32(8 * byte)) & np.uint32(255)]
            self.pair ^= self.crc[1:]
            for i in np.flatnonzero((after >= _TABLES) & self.paired).tolist():
                self.pair[i] = zlib.crc32(known[ids[i + 1]], int(before[i]))

    def buckets(self, n: int) -> np.ndarray:
        """The bucket of every feature."""
        return np.concatenate([self.crc, self.pair[self.paired]]) % np.uint32(n)

    def sums(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, sum of ``value`` of their buckets) of each text."""
        n = np.uint32(len(value))
        words = np.concatenate([[0], np.cumsum(value[self.crc % n], dtype=np.int64)])
        pairs = np.concatenate([[0], np.cumsum(np.where(self.paired, value[self.pair % n], 0), dtype=np.int64)])
        a, b = self.bounds[:-1], self.bounds[1:]
        some = b > a
        last = np.where(some, b - 1, a)       # pairs of a text start at all its words but the last
        cut = lambda x, i: x[np.minimum(i, len(x) - 1)]
        count = np.where(some, 2 * (b - a) - 1, 0)
        return count, words[b] - words[a] + np.where(some, cut(pairs, last) - cut(pairs, a), 0)
