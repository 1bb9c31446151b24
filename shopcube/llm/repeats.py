"""Operator 2: removal of repeated byte strings by bucket refinement over sampled suffixes.

A suffix array of all positions is not needed to find repeated windows of a
fixed length: it is enough to sort the sampled suffixes (anchors) that the
windows choose themselves.  The refinement goes from coarse to fine buckets:

1. anchors fall into buckets by their q-gram; a bucket of one is done;
2. blocks (successive windows of one anchor) with equal bytes are repeated as
   a whole; only one block of each content goes on;
3. a bucket that a task should not hold is split over all executors: the
   range of window offsets is halved, a half's bucket is the bucket before
   and the bytes that all its windows share; halves alone in their bucket
   are dropped, halves equal in all bytes are repeated;
4. within a bucket, every place of the blocks gets the bucket of its 8 bytes.
   Buckets are refined by sorting on the buckets of later offsets, and the
   new buckets are used in the same way again: 16, 32, 64, 128 and at last
   200 bytes, the window.  These steps compare bytes, not hashes.

Only blocks of buckets with several contents are ever compared by bytes.
Two blocks of one bucket (64-bit hash of its q-gram) count as equal when
their 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.anchors import Fingerprints, blocks
from shopcube.llm.batches import map_rows
from shopcube.llm.components import _stored, discard
from shopcube.llm.words import text_buffers

WINDOW = 200             # bytes of a repeated string
GRAM = 64                # bytes of the q-gram that opens a bucket
RANGE = 256              # a power of two above the number of places that an anchor can have in a window
FIRST = 8                # bytes of the first q-grams inside a bucket
PIECE = 1 << 20          # bytes that are worked on at a time
FIT = 512                # blocks of a bucket that one task refines; larger ones are split over all executors first
BLOCK = "array<struct<start: long, n: int, off: int, gram: long, content: long>>"


def digest(texts: pa.Array) -> list[str]:
    data, off = text_buffers(texts)
    view = memoryview(data)
    at = off.tolist()
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]


def pieces(off: np.ndarray, limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Ranges of texts, at most about ``limit`` bytes each: (first text, first byte, offsets in bytes).

    A longer text is cut into ranges whose windows follow on each other.
    """
    i, n = 0, len(off) - 1
    while i < n:
        size = int(off[i + 1] - off[i])
        if size > limit:
            for a in range(0, size - WINDOW + 1, limit):
                yield i, int(off[i]) + a, np.array([0, min(limit + WINDOW - 1, size - a)])
            i += 1
        else:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield i, int(off[i]), off[i:j + 1] - off[i]
            i = j


def text_blocks(rows: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_bytes, sha, tid (60 bits of sha) and the blocks of its text."""
    def work(texts: pa.Array) -> dict:
        data, off = text_buffers(texts)
        sha, parts = digest(texts), []
        for first, byte, own in pieces(off, PIECE):
            piece = data[byte:byte + int(own[-1])]
            b = blocks(piece, own, Fingerprints(piece), GRAM, WINDOW)
            doc = first + np.searchsorted(own, b.start, "right") - 1
            parts.append((doc, b.start + byte - off[doc], b.windows, b.anchor - b.start, b.gram, b.content))
        doc, start, n, at, gram, content = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 6
        bounds = np.searchsorted(doc, np.arange(len(off)))
        items = pa.StructArray.from_arrays(
            [pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array(at, pa.int32()),
             pa.array(gram.view(np.int64)), pa.array(content.view(np.int64))],
            names=["start", "n", "off", "gram", "content"])
        return {"n_bytes": pa.array(np.diff(off), pa.int64()), "sha": pa.array(sha, pa.string()),
                "tid": pa.array([int(s[:15], 16) for s in sha], pa.int64()),
                "blocks": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items)}

    return map_rows(rows, ["doc_id"], "text", work, f"n_bytes long, sha string, tid long, blocks {BLOCK}")


def refine(data: np.ndarray, begin: np.ndarray, n: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, window) of the windows whose bytes occur more than once among some blocks.

    Bucket-pointer refinement over all places of the blocks: the buckets of
    q-grams are sorted on the bucket of the place q later, which makes
    buckets of 2q-grams, and so on up to whole windows, whose two halves are
    the buckets of their own place and of a later one.  Places alone in a
    bucket are not sorted again.  ``begin``: first byte of each block and the
    end; ``once``: blocks that are reported.
    """
    size = len(data)
    if size < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = np.zeros(size, np.uint64)
    for k in range(FIRST):
        gram[:size - k] |= data[k:].astype(np.uint64) << np.uint64(8 * k)
    end = np.repeat(begin[1:], np.diff(begin))
    pointer, open_ = np.arange(size), np.flatnonzero(np.arange(size) + FIRST <= end)
    q = FIRST
    open_ = _rebucket(pointer, open_, gram[open_])
    while q < WINDOW:
        step = min(q, WINDOW - q)
        open_ = open_[open_ + q + step <= end[open_]]
        # the pointers of this round are all read before any of them is replaced
        pair = pointer[open_] * size + pointer[open_ + step]
        pointer = pointer.copy()
        open_ = _rebucket(pointer, open_, pair)
        q += step
    block = np.searchsorted(begin, open_, "right") - 1
    window = open_ - begin[block]
    told = once[block] & (window < n[block])
    return block[told], window[told]


def _rebucket(pointer: np.ndarray, places: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Give places of equal ``key`` one pointer; returns those that share it, the others point to themselves."""
    order = np.argsort(key)
    sorted_ = key[order]
    at = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(at, len(key)))
    placed = places[order]
    pointer[placed] = np.repeat(placed[at], size)
    return placed[np.repeat(size, size) > 1]


CONTEXT = ["k1", "k2", "low", "once", "n", "off", "doc_id", "tid", "start", "bytes"]


def task_spans(contexts: DataFrame) -> DataFrame:
    """(doc_id, tid, start, end) of the repeated windows of buckets that fit a task; rows come bucket by bucket."""
    cols = ["k1", "k2", "once", "n", "doc_id", "tid", "start", "bytes"]
    out = T.StructType([contexts.schema["doc_id"], *T.StructType.fromDDL("tid long, start long, `end` long").fields])

    def work(t: pa.Table) -> pa.RecordBatch:
        once, n, start = (t.column(i).to_numpy() for i in (2, 3, 6))
        data, at = text_buffers(t.column(7))
        block, window = refine(data, at, n, once.astype(bool))
        order = np.lexsort((window, block))
        block, window = block[order], window[order]
        # windows in a row make one span
        first = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (window[1:] != window[:-1] + 1))) \
            if len(block) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(block)) - 1 if len(first) else first
        b = block[first]
        return pa.RecordBatch.from_arrays(
            [t.column(4).combine_chunks().take(pa.array(b)), t.column(5).combine_chunks().take(pa.array(b)),
             pa.array(start[b] + window[first]), pa.array(start[b] + window[last] + WINDOW)], names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            waiting.append(b)
            rows += b.num_rows
            if rows < 8_000:
                continue
            t = pa.Table.from_batches(waiting)
            k = [t.column(i).to_numpy() for i in (0, 1)]
            new = np.append(True, (k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]))
            cut = int(np.flatnonzero(new)[-1])                                  # the last bucket may go on
            if cut:
                yield work(t.slice(0, cut))
            waiting = t.slice(cut).to_batches()
            rows = t.num_rows - cut
        if rows:
            yield work(pa.Table.from_batches(waiting))

    return contexts.select(cols).repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(run, out)


def halves(contexts: DataFrame, size: int) -> DataFrame:
    """Blocks whose windows have their anchors at ``low`` .. ``low + size - 1``, cut in two; at most two rows for each.

    A half's bucket (k1, k2) follows from the bucket before and the bytes
    that all its windows share; (c1, c2) from all its bytes.
    """
    half = size // 2
    out = T.StructType([*contexts.select(CONTEXT).schema.fields, *T.StructType.fromDDL("c1 long, c2 long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                k1, k2, low, _, n, off, _, _, start = (part.column(i).to_pylist() for i in range(9))
                rows, made = [], []
                for i, raw in enumerate(part.column(9)):
                    raw = memoryview(raw.as_buffer())
                    for x in (low[i], low[i] + half):
                        least, most = max(x, off[i] - n[i] + 1), min(x + half - 1, off[i])
                        if least > most:
                            continue
                        j, m, a = off[i] - most, most - least + 1, off[i]
                        shared = raw[a - x:a - min(x + half - 1, WINDOW - GRAM) + WINDOW]
                        bucket = xxhash.xxh3_128(struct.pack("<qqq", k1[i], k2[i], x))
                        bucket.update(shared)
                        key = bucket.digest()
                        body = raw[j:j + m - 1 + WINDOW]
                        content = xxhash.xxh3_128(key + struct.pack("<qq", m, most))
                        content.update(body)
                        rows.append(i)
                        made.append((*struct.unpack("<qq", key), x, m, most, start[i] + j, bytes(body),
                                     *struct.unpack("<qq", content.digest())))
                x1, x2, lo, m, o, st, body, c1, c2 = zip(*made) if made else [()] * 9
                same = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x1, pa.int64()), pa.array(x2, pa.int64()), pa.array(lo, pa.int32()), part.column(3).take(same),
                     pa.array(m, pa.int32()), pa.array(o, pa.int32()), part.column(6).take(same), part.column(7).take(same),
                     pa.array(st, pa.int64()), pa.array(body, pa.binary()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64())],
                    names=out.names)

    return contexts.select(CONTEXT).mapInArrow(run, out)


def bucket_spans(contexts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, tid, start, end) of the repeated windows of all buckets, and tables to discard afterwards.

    ``m`` of ``contexts``: blocks of the bucket.

    Buckets that no task should hold are refined over all executors first:
    the range of window offsets is halved, halves alone in their bucket go,
    halves equal in all bytes are repeated and one of them goes on.  After
    eight rounds a half is a single window.
    """
    size, live, spans, tables = RANGE, contexts, None, []
    while True:
        found = task_spans(live.where(F.col("m") <= FIT))
        spans = found if spans is None else spans.unionByName(found)
        large = live.where(F.col("m") > FIT)
        if size == 1 or not large.limit(1).count():
            return _stored(spans.distinct(), "repeat-found"), tables
        each = _stored(halves(large, size), "repeat-halves")
        size //= 2
        key, content = ["k1", "k2", "low"], ["k1", "k2", "c1", "c2"]
        kept = [c for c in CONTEXT if c not in (*key, "once")]
        contents = _stored(each.groupBy(*key, "c1", "c2").agg(
            F.count("*").alias("times"), F.max("once").alias("some"), F.first(F.struct(*kept)).alias("r")), "repeat-contents")
        again = each.where("once").join(contents.where("times > 1").select(content), content)
        again = _stored(again.select("doc_id", "tid", "start", (F.col("start") + F.col("n") - 1 + WINDOW).alias("end")),
                        "repeat-found")
        spans = spans.unionByName(again)
        once = F.col("some") & (F.col("times") == 1)
        wanted = contents.groupBy("k1", "k2").agg(F.count("*").alias("m"), F.max(once).alias("open")).where("m > 1 AND open")
        live = _stored(contents.select(*key, once.alias("once"), "r.*").join(wanted.select("k1", "k2", "m"), ["k1", "k2"])
                       .select(*CONTEXT, "m"), "repeat-contexts")
        discard(each, contents)
        tables += [live, again]


def repeated_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, tid, s): the repeated byte ranges of each text that has any.

    ``rows``: doc_id, tid, text; ``found``: the stored result of ``text_blocks``.
    """
    each = found.select("doc_id", "tid", F.inline("blocks"))
    first = lambda *names: [F.first(c).alias(c) for c in names]
    contents = _stored(each.groupBy("gram", "content").agg(F.count("*").alias("c"), *first(
        "doc_id", "tid", "start", "n", "off")), "repeat-contents")
    shared = _stored(contents.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1"), "repeat-buckets")

    # blocks that occur again as a whole
    again = _stored(contents.where("c > 1").select("gram", "content"), "repeat-blocks")
    whole = each.join(again, ["gram", "content"]).select(
        "doc_id", "tid", "start", (F.col("start") + F.col("n") - 1 + WINDOW).alias("end")).distinct()

    # one block of each content of a shared bucket, with its bytes
    one = contents.join(shared, "gram")
    marks = one.groupBy("doc_id", "tid").agg(F.collect_list(F.struct(
        "gram", "m", (F.col("c") == 1).alias("once"), "n", "off", "start")).alias("marks"))   # of one text
    joined = _same_text(rows.select("doc_id", "tid", "text"), marks)
    inner = joined.select("doc_id", "tid", F.col("text").cast("binary").alias("raw"), F.explode("marks").alias("x"))
    contexts = inner.select(
        F.col("x.gram").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).alias("low"), "x.once", "x.n", "x.off",
        "doc_id", "tid", "x.start", F.expr(f"substring(raw, cast(x.start + 1 as int), x.n - 1 + {WINDOW})").alias("bytes"), "x.m")
    contexts = _stored(contexts.dropDuplicates(["k1", "doc_id", "tid", "start"]), "repeat-contexts")

    parts, tables = bucket_spans(contexts)
    # all spans of one text meet: their number is bounded by its length
    spans = whole.unionByName(parts).distinct().groupBy("doc_id", "tid").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))
    spans = _stored(spans, "repeat-spans")
    discard(contents, shared, again, contexts, parts, *tables)
    return spans


def _same_text(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on key and text: hashes need to tell apart only the texts that share a key."""
    o = other.withColumnsRenamed({"doc_id": "__doc", "tid": "__tid"})
    return rows.join(o, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("tid") == F.col("__tid")), how).drop("__doc", "__tid")


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of sorted (start, end) pairs."""
    out: list[list[int]] = []
    for s in spans:
        a, b = s["start"], s["end"]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   texts: bool = True) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256.

    With ``texts``, also ``kept`` (the bytes left), ``kept_text`` (the same
    as text; of a character cut in part nothing stays) and ``spans`` (the
    removed byte ranges).  ``keep`` names further columns to carry along,
    under their own names.  A null text counts as
    empty; texts shorter than the window lose nothing; repeated rows lose
    all their windows, as they repeat each other; an empty table gives an
    empty result.  Positions are judged on the input.
    """
    keep = [c for c in (keep or []) if c != key]
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
                       .alias("text"), *[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)])
    rows = rows.withColumn("tid", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("long"))
    found = _stored(text_blocks(rows.select("doc_id", "text")), "repeat-texts")
    spans = repeated_spans(rows, found)
    discard(found)
    joined = _same_text(rows, spans, "left")
    names = ["doc_id", "text", "s", *[f"keep_{i}" for i in range(len(keep))]]
    ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    made = [("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("n_spans", "long", pa.int64()),
            ("kept_sha256", "string", pa.string())]
    if texts:
        made += [("kept", "binary", pa.binary()), ("kept_text", "string", pa.string()),
                 ("spans", "array<struct<`start`: long, `end`: long>>", ranges)]
    out = T.StructType([*joined.select("doc_id", *names[3:]).schema.fields,
                        *T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind, _ in made)).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column(1))
            view, rows_ = memoryview(data), []
            for i, s in enumerate(b.column(2).to_pylist()):
                raw = view[off[i]:off[i + 1]]
                cut, at, kept = merged(s or []), 0, []
                for x, y in cut:
                    kept.append(raw[at:x])
                    at = y
                kept = b"".join([*kept, raw[at:]])
                row = [len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()]
                if texts:
                    row += [kept, kept.decode("utf-8", "ignore"), [{"start": x, "end": y} for x, y in cut]]
                rows_.append(row)
            cols = list(zip(*rows_)) or [()] * len(made)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[3:], *(pa.array(c, kind) for c, (_, _, kind) in zip(cols, made))], names=out.names)

    done = joined.select(names).mapInArrow(run, out)
    return done.select(F.col("doc_id").alias(key), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
                       *[name for name, _, _ in made])
