"""Arrow text column -> pre-token words, vectorised with numpy.

The byte-level pre-token pattern (contractions, `` ?letters``, `` ?digits``,
`` ?others``, white space with the last blank left for the next word) is
evaluated as rules on neighbouring character classes, so a batch needs a
fixed number of array passes and no per-character Python.  Texts are then
worked on through their *distinct* words, which are some 15 times fewer
than the running words of a batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

OTHER, LETTER, DIGIT, SPACE, CONT = 0, 1, 2, 3, 4
CHUNK_BYTES = 4 << 20          # texts are worked on in pieces of about this size


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    chars = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    table = np.zeros(0x110000, np.uint8)
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, chars):
            a, b = ord(m.group()[0]), ord(m.group()[-1]) + 1
            table[a:b] = cls
    return table


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets from 0) of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_string(arr.type) and not pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.large_binary())
    arr = arr.fill_null(b"") if pa.types.is_large_binary(arr.type) else arr.fill_null("")
    n = len(arr)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES):
    """Slices of a string array of about ``limit`` bytes (one row at least): (first row, slice)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    _, off = text_buffers(arr)
    i, n = 0, len(arr)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, arr.slice(i, j - i)
        i = j


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, code point) of each character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[at].astype(np.int32)
    wide = np.flatnonzero(cp >= 0x80)
    if len(wide):
        pos, lead = at[wide], cp[wide]
        end = len(data) - 1
        b1 = (data[np.minimum(pos + 1, end)] & 0x3F).astype(np.int32)
        b2 = (data[np.minimum(pos + 2, end)] & 0x3F).astype(np.int32)
        b3 = (data[np.minimum(pos + 3, end)] & 0x3F).astype(np.int32)
        two = ((lead & 0x1F) << 6) | b1
        three = ((lead & 0x0F) << 12) | (b1 << 6) | b2
        four = ((lead & 0x07) << 18) | (b1 << 12) | (b2 << 6) | b3
        cp[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, np.minimum(four, 0x10FFFF)))
    return at, cp


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of the character each byte belongs to."""
    cls = class_table()[np.arange(256)][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        sub = data[lead]
        end = len(data) - 1
        b1 = (data[np.minimum(lead + 1, end)] & 0x3F).astype(np.int32)
        b2 = (data[np.minimum(lead + 2, end)] & 0x3F).astype(np.int32)
        b3 = (data[np.minimum(lead + 3, end)] & 0x3F).astype(np.int32)
        s = sub.astype(np.int32)
        cp = np.where(s < 0xE0, ((s & 0x1F) << 6) | b1,
                      np.where(s < 0xF0, ((s & 0x0F) << 12) | (b1 << 6) | b2,
                               np.minimum(((s & 0x07) << 18) | (b1 << 12) | (b2 << 6) | b3, 0x10FFFF)))
        c = class_table()[cp]
        cls[lead] = c
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            m = sub >= least
            cls[np.minimum(lead[m] + k, end)] = c[m]
    return cls


_TWO = {(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))}


def word_starts(data: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Start bytes of all pre-tokens; ``segments`` are the starts of non-empty pieces that are split alone."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cls = byte_classes(data)
    head = (data & 0xC0) != 0x80
    first = np.zeros(n + 1, bool)
    first[segments] = True
    first[n] = True
    prev = np.empty(n, np.uint8)
    prev[0] = 255
    prev[1:] = cls[:-1]
    start = cls != prev
    # after a blank, a word starts at the blank; other white space stands alone
    blank = np.zeros(n, bool)
    blank[1:] = data[:-1] == 0x20
    start &= ~(blank & (cls != SPACE))
    # the last white space of a run before a word is split off
    space = np.flatnonzero((cls == SPACE) & (prev == SPACE) & head)
    if len(space):
        b = data[space]
        nxt = space + np.where(b < 0x80, 1, np.where(b < 0xE0, 2, 3))
        inside = nxt < n
        nx = np.minimum(nxt, n - 1)
        last = inside & ~first[nxt] & (cls[nx] != SPACE)
        start[space[last]] = True
    start |= first[:n]
    start &= head
    # contractions: a quote that starts a pre-token takes s, t, m, d, re, ve or ll along
    quote = np.flatnonzero((data == 0x27) & start)
    if len(quote):
        quote = quote[(quote + 1 < n)]
        quote = quote[~first[quote + 1]]
        one = np.isin(data[quote + 1], np.frombuffer(b"stmd", np.uint8))
        q2 = quote[~one]
        q2 = q2[(q2 + 2 < n)]
        q2 = q2[~first[q2 + 2]]
        a, b = data[q2 + 1], data[q2 + 2]
        two = np.zeros(len(q2), bool)
        for x, y in _TWO:
            two |= (a == x) & (b == y)
        q1, q2 = quote[one], q2[two]
        start[q1 + 1] = False
        start[q2 + 1] = False
        for e in (q1 + 2, q2 + 3):
            start[e[e < n]] = True
    return np.flatnonzero(start)


class Words:
    """The pre-tokens of some texts through their distinct words.

    ``ids``: index into ``distinct`` of each running word; ``bounds``: first
    running word of each text (one more entry than texts); ``distinct``:
    Arrow binary array.
    """

    def __init__(self, arr: pa.Array, special: bytes | None = None):
        data, off = text_buffers(arr)
        self.data, self.offsets = data, off
        seg = off[:-1][off[1:] > off[:-1]]
        cut = np.zeros(0, np.int64)
        if special and len(data):
            raw, found, at = data.tobytes(), [], 0
            while (at := raw.find(special, at)) >= 0:
                doc = np.searchsorted(off, at, "right")
                if at + len(special) <= off[doc]:
                    found.append(at)
                    at += len(special)
                else:
                    at += 1
            if found:
                cut = np.array(found, np.int64)
                ends = cut + len(special)
                seg = np.union1d(seg, np.concatenate([cut, ends[ends < len(data)]]))
        starts = word_starts(data, seg)
        if len(cut):   # a special string is one word
            k = np.searchsorted(cut, starts, "right") - 1
            inner = (k >= 0) & (starts > cut[np.maximum(k, 0)]) & (starts < cut[np.maximum(k, 0)] + len(special))
            starts = starts[~inner]
        self.starts = starts
        self.bounds = np.searchsorted(starts, off)
        if len(starts):
            ends = np.append(starts, len(data)).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(starts),
                                          [None, pa.py_buffer(ends), pa.py_buffer(data)])
            d = words.dictionary_encode()
            self.ids = d.indices.to_numpy()
            self.distinct = d.dictionary
        else:
            self.ids = np.zeros(0, np.int32)
            self.distinct = pa.array([], pa.binary())
        self.special = special

    def per_text(self, value_of_word: np.ndarray) -> np.ndarray:
        """Sum over each text of a value that each distinct word has."""
        total = np.concatenate([[0], np.cumsum(value_of_word[self.ids], dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[s:s+n]`` for each (s, n)."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return values[shift + np.arange(total)]
