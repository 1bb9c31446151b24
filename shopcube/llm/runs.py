"""Operator 13: runs of repeated words by internal pattern matching.

A run is a stretch of words with smallest period q and at least four
repetitions that no neighbouring word extends.  The words of a batch of texts
form one suffix array (symbols of different texts differ).  Blocks of length
b = 4, 8, 16, .. stand at every multiple of b / 2.  A run with b / 2 < q <= b
(q <= 4 for b = 4) holds such a block and its copy q words later, and the
block, which holds a whole period, does not occur in between.  So the next
occurrence of the block, asked of a wavelet matrix over the suffix array's
range of the block, gives q.  Occurrences at equal distances form a
progression: one candidate stretch, extended to both sides word by word.

The suffix array is refined by doubling the compared length, for suffixes
that are not told apart yet only, and up to half of the longest text: no
longer block is asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.spans import packed, spaced, word_spans
from shopcube.llm.wavelet import WaveletMatrix
from shopcube.llm.words import chunks, text_buffers

LEAST = 6                # words of a run
TIMES = 4                # repetitions of a run
SHORTEST = 4             # words of the shortest block
RUNS = "array<struct<start: long, length: long, period: long>>"


def planted_source(n: int, key: int) -> tuple[int, int] | None:
    """(a, p): from word a on, word i of a text is its word a + (i - a) % p; None for texts left as they are."""
    h = zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def suffix_levels(symbol: np.ndarray, end: np.ndarray, longest: int):
    """(suffix array, levels): the suffixes refined by doubling, and the ranges met on the way.

    ``end``: for each place the end of its text; equal symbols stand in one
    text.  A level is (b, places, left, right): places whose first b symbols
    occur more than once, and the range of the array that starts with them.
    """
    n = len(symbol)
    order = np.argsort(symbol, kind="stable")
    s = symbol[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, size)
    open_ = np.flatnonzero(np.repeat(size, size) > 1)
    b, levels = 1, []
    while len(open_) and 2 * b <= longest:
        place = order[open_]
        after = place + b
        second = np.where(after < end[place], rank[np.minimum(after, n - 1)], -1)
        both = rank[place] * (n + 1) + second + 1
        by = np.argsort(both, kind="stable")
        place, both = place[by], both[by]
        order[open_] = place
        at = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        size = np.diff(np.append(at, len(both)))
        left, size = np.repeat(open_[at], size), np.repeat(size, size)
        rank[place] = left
        more = size > 1
        open_ = open_[more]
        b *= 2
        if b >= SHORTEST:
            levels.append((b, place[more], left[more], left[more] + size[more]))
    return order, levels


def stretches(symbol: np.ndarray, begin: np.ndarray, end: np.ndarray, longest: int):
    """(start, end, period) of stretches that the blocks propose, one for each progression."""
    order, levels = suffix_levels(symbol, end, longest)
    none = np.zeros(0, np.int64)
    if not levels or not len(levels[0][1]):
        return none, none, none
    # ranges of longer blocks lie within those of the shortest: the rest of the array is not needed
    mark = np.zeros(len(order) + 1, np.int64)
    mark[np.unique(levels[0][2])] += 1
    mark[np.unique(levels[0][3])] -= 1
    used = np.cumsum(mark[:-1]) > 0
    new_place = np.concatenate([[0], np.cumsum(used)])
    tree = WaveletMatrix(order[used])
    found = []
    for b, place, left, right in levels:
        ask = ((place - begin[place]) % (b // 2) == 0) & (place + b <= end[place])
        i, l, r = place[ask], new_place[left[ask]], new_place[right[ask]]
        if not len(i):
            continue
        then = tree.successor(l, r, i + 1)
        d = then - i
        ok = (then >= 0) & (d <= b)
        found.append((d[ok], i[ok], i[ok] + d[ok] + b))
    if not found:
        return none, none, none
    d, i, e = (np.concatenate([f[k] for f in found]) for k in range(3))
    by = np.lexsort((i, d))
    d, i, e = d[by], i[by], e[by]
    if not len(d):
        return none, none, none
    # stretches of one period that share a whole period are one
    reach = np.maximum.accumulate((d << 32) + e) - (d << 32)
    fresh = np.append(True, (d[1:] != d[:-1]) | (i[1:] > reach[:-1] - d[1:]))
    at = np.flatnonzero(fresh)
    return i[at], np.maximum.reduceat(e, at), d[at]


def extended(symbol: np.ndarray, begin: np.ndarray, end: np.ndarray, s: np.ndarray, e: np.ndarray, d: np.ndarray):
    """The longest stretches of period ``d`` around [s, e)."""
    s, e, lo, hi = s.copy(), e.copy(), begin[s], end[s]
    for side in (-1, 1):
        live, width = np.arange(len(s)), 32
        while len(live):
            step = np.arange(width)
            if side < 0:
                at = s[live, None] - 1 - step
                room = at >= lo[live, None]
                same = symbol[np.maximum(at, 0)] == symbol[np.maximum(at, 0) + d[live, None]]
            else:
                at = e[live, None] + step
                room = at < hi[live, None]
                at = np.minimum(at, len(symbol) - 1)
                same = symbol[at] == symbol[at - d[live, None]]
            go = np.logical_and.accumulate(room & same, axis=1).sum(axis=1)
            if side < 0:
                s[live] -= go
            else:
                e[live] += go
            live = live[go == width]
            width = min(width * 2, max(32, (1 << 20) // max(len(live), 1)))
    return s, e


def find_runs(symbol: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period; ``bounds``: first place of each text and the end."""
    size = np.diff(bounds)
    begin, end = np.repeat(bounds[:-1], size), np.repeat(bounds[1:], size)
    longest = max(SHORTEST, int(size.max()) // 2) if len(size) else 0
    s, e, d = stretches(symbol, begin, end, longest)
    if len(s):
        s, e = extended(symbol, begin, end, s, e, d)
    keep = e - s >= np.maximum(LEAST, TIMES * d)
    if not keep.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    s, d, e = np.unique(np.stack([s[keep], d[keep], e[keep]]), axis=1)
    return s, e, d


def runs_of_texts(texts: pa.Array, keys: list | None) -> dict:
    """n_words, runs and collapsed of each text; ``keys``: with planted repetitions by these ids."""
    data, off = text_buffers(texts)
    starts, ends, bounds = word_spans((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)), off)
    size = np.diff(bounds)
    if keys is not None:
        source = np.arange(len(starts))
        for k, (b, n) in enumerate(zip(bounds[:-1].tolist(), size.tolist())):
            if n and keys[k] is not None and (rule := planted_source(n, keys[k])):
                a, p = rule
                source[b + a:b + n] = b + a + np.arange(n - a) % p
        starts, ends = starts[source], ends[source]
    raw, to = packed(data, starts, ends)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(raw)])
    d = words.dictionary_encode()
    symbol = np.repeat(np.arange(len(size)), size) * max(len(d.dictionary), 1) + d.indices.to_numpy().astype(np.int64)
    s, e, q = find_runs(symbol, bounds)

    text_of = np.searchsorted(bounds, s, "right") - 1
    items = pa.StructArray.from_arrays([pa.array(s - bounds[text_of]), pa.array(e - s), pa.array(q)],
                                       names=["start", "length", "period"])
    first = np.searchsorted(text_of, np.arange(len(size) + 1))
    mark = np.zeros(len(starts) + 1, np.int64)
    np.add.at(mark, s + q, 1)
    np.add.at(mark, e, -1)
    kept = np.cumsum(mark[:-1]) == 0
    out, place = spaced(data, starts[kept], ends[kept])
    last = place[np.searchsorted(np.flatnonzero(kept), bounds)]
    view = memoryview(out)
    collapsed = [view[a:max(a, b - 1)] for a, b in zip(last[:-1].tolist(), last[1:].tolist())]
    return {"n_words": pa.array(size, pa.int64()), "runs": pa.ListArray.from_arrays(pa.array(first, pa.int32()), items),
            "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string())}


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """Per row of ``docs``: key, n_words, runs (start, length, period; by start, then period) and collapsed.

    Words are the stretches without blanks (``[^\\x20\\x09-\\x0D]+``), case
    kept.  ``collapsed`` holds the words that no run contains after its first
    period, joined by one space.  With ``planted``, the words of some rows are
    first replaced by repetitions that follow from the key
    (``planted_source``); a row without key stays as it is.

    A null, empty or blank text has no words, no runs and an empty
    ``collapsed``; repeated rows give repeated results; an empty table gives
    an empty result; extra columns of any name are not read.  A text is
    worked on whole, whatever its length.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    out = T.StructType([T.StructField(key, source.schema["key"].dataType),
                        *T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                own = batch.column(0).slice(at, len(part))
                made = runs_of_texts(part, own.to_pylist() if planted else None)
                yield pa.RecordBatch.from_arrays([own, made["n_words"], made["runs"], made["collapsed"]], names=out.names)

    return source.mapInArrow(run, out)


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: key, n_runs, the run of greatest length / period, and digests of the runs and the words kept."""
    better = F.expr("""reduce(runs, cast(null as struct<start: long, length: long, period: long>),
        (m, r) -> case when m is null or r.length * m.period > m.length * r.period then r else m end)""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return (found.select(F.col(f"`{key}`").alias("key"), F.size("runs").cast("long").alias("n_runs"), better.alias("m"),
                         F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").alias("lines"), "collapsed")
            .select(F.col("key").alias(key), "n_runs", "m.start", "m.length", "m.period",
                    F.expr("1000 * m.length div m.period").alias("exponent_milli"),
                    F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
