"""Operator 3: packing documents into sequences by cutting-stock column generation.

A document's ids are cut into whole sequences and a rest.  The histogram of
rests (in classes of ``UNIT`` ids, rounded up) goes into a linear program
over patterns, i.e. ways to fill a sequence; a knapsack program prices new
patterns.  Whole-numbered pattern counts are handed to documents by their
rank in their class, so the plan is of the size of the histogram while the
documents stay distributed.  What rounding leaves over is laid end to end
and cut freely; the last sequence is cut at powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopcube.llm.batches import map_rows
from shopcube.llm.bpe_codec import encode_batch
from shopcube.llm.components import _stored, discard
from shopcube.session import scratch_path

SEQUENCE = 2048          # ids in a sequence
UNIT = 4                 # ids in a step of the length histogram
GAP = 1e-3               # column generation ends this near to the best possible number of sequences
ROUNDS = 4000            # and after so many patterns in any case
END_ID = 1
RANKED_ROWS = 4096       # about so many pieces are ranked together


# -- the plan: driver work on the length histogram -------------------------

def price(duals: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable filling of one sequence: (value, how often each size is taken)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = int(np.searchsorted(sizes, c, "right"))
        if k:
            gain = duals[:k] + best[c - sizes[:k]]
            i = int(gain.argmax())
            if gain[i] > best[c] + 1e-12:
                best[c], pick[c] = gain[i], i
    taken, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            taken[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), taken


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Column generation: (patterns as columns, how often each is used, fractional).

    Revised simplex on the covering program; starts from one pattern for
    each size and ends when no pattern can save ``GAP`` of the sequences.
    """
    m = len(sizes)
    fit = capacity // sizes
    basis = np.diag(fit).astype(np.float64)
    inverse, cost = np.diag(1.0 / fit), np.ones(m)
    x = demand / fit
    for _ in range(ROUNDS):
        duals = cost @ inverse
        low = int(duals.argmin())
        if duals[low] < -1e-9:                    # giving one piece too many is worth it
            column, c = np.zeros(m), 0.0
            column[low] = -1.0
        else:
            value, taken = price(np.maximum(duals, 0), sizes, capacity)
            if value <= 1 + GAP:
                break
            column, c = taken.astype(np.float64), 1.0
        step = inverse @ column
        able = step > 1e-9
        if not able.any():
            break
        ratio = np.full(m, np.inf)
        ratio[able] = x[able] / step[able]
        out = int(ratio.argmin())
        theta = max(ratio[out], 0.0)
        x -= theta * step
        x[out] = theta
        np.maximum(x, 0, out=x)
        basis[:, out], cost[out] = column, c
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    real = cost > 0
    return basis[:, real].astype(np.int64), x[real]


class Plan:
    """Which sequence and slot the piece of a given class and rank gets.

    For each class: ``first`` ranks of its runs, and of each run the first
    sequence, the pieces a sequence takes, and the slot of the first one.
    Pieces beyond the runs are left over (``leftover``: class -> count).
    """

    def __init__(self, demand: dict[int, int], capacity: int):
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {}
        self.leftover: dict[int, int] = {}
        self.sequences = 0
        sizes = np.array(sorted(c for c, n in demand.items() if n and c < capacity), np.int64)
        used = {c: 0 for c in demand}
        whole = demand.get(capacity, 0)
        if whole:
            self._add(capacity, used, 1, whole, 0)
            self.sequences += whole
        if len(sizes):
            need = np.array([demand[c] for c in sizes.tolist()], np.int64)
            columns, x = patterns(sizes, need.astype(np.float64), capacity)
            times, left = np.floor(x + 1e-9).astype(np.int64), need.copy()
            for j in np.argsort(-x).tolist():
                self._use(columns[:, j], int(times[j]), sizes, left, used)
            for j in np.argsort(-(x - times)).tolist():   # then once more wherever the pieces suffice
                if x[j] - times[j] > 1e-9 and (columns[:, j] <= left).all():
                    self._use(columns[:, j], 1, sizes, left, used)
            self.leftover = {int(c): int(n) for c, n in zip(sizes, left) if n}
        self.used = used

    def _add(self, c: int, used: dict, each: int, times: int, slot: int) -> None:
        self.runs.setdefault(c, []).append((used[c], self.sequences, each, slot))
        used[c] += each * times

    def _use(self, column, times, sizes, left, used) -> None:
        held = np.flatnonzero(column)
        if len(held):
            times = min(times, int((left[held] // column[held]).min()))
        if times <= 0 or not len(held):
            return
        slot = 0
        for i in held.tolist():
            each = int(column[i])
            self._add(int(sizes[i]), used, each, times, slot)
            slot += each
            left[i] -= each * times
        self.sequences += times

    def place(self, c: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, slot) of the pieces of class ``c`` with these ranks; -1 for left-over ones."""
        runs = np.array(self.runs.get(c, []), np.int64).reshape(-1, 4)
        seq, slot = np.full(len(ranks), -1, np.int64), np.zeros(len(ranks), np.int64)
        ok = ranks < self.used.get(c, 0)
        if len(runs) and ok.any():
            r = runs[np.searchsorted(runs[:, 0], ranks[ok], "right") - 1]
            k = ranks[ok] - r[:, 0]
            seq[ok], slot[ok] = r[:, 1] + k // r[:, 2], r[:, 3] + k % r[:, 2]
        return seq, slot


# -- the documents: Spark work ----------------------------------------------

def pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ids with ``END_ID`` as whole sequences and a rest: key, doc_tokens, doc_crc32, pieces."""
    def work(texts: pa.Array) -> dict:
        ids, bounds = encode_batch(texts, path, by_library=True)
        n = np.diff(bounds) + 1
        ids = np.insert(ids, bounds[1:], END_ID)
        ends, rows, crcs = np.cumsum(n), [], []
        for a, b in zip((ends - n).tolist(), ends.tolist()):
            rows.append([{"start": s - a, "length": min(b, s + SEQUENCE) - s,
                          "ids_crc32": zlib.crc32(ids[s:min(b, s + SEQUENCE)])} for s in range(a, b, SEQUENCE)])
            crcs.append(zlib.crc32(ids[a:b]))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
        return {"doc_tokens": pa.array(n, pa.int64()), "doc_crc32": pa.array(crcs, pa.int64()),
                "pieces": pa.array(rows, kind)}

    found = map_rows(docs, [key], text, work, "doc_tokens long, doc_crc32 long, "
                     "pieces array<struct<start: long, length: long, ids_crc32: long>>")
    return found.select(F.col(key).alias("doc_id"), "doc_tokens", "doc_crc32", F.inline("pieces"))


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all of ``docs`` into sequences of at most 2048 ids.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  A null text counts as empty and still has its end
    id; repeated rows are packed each for itself; an empty table gives an
    empty result; a text of any length is cut into whole sequences.
    """
    spark = docs.sparkSession
    capacity = SEQUENCE // UNIT
    folder = scratch_path(spark, "packing-pieces")
    (pieces(docs, path, key, text)
     .withColumn("class", F.ceil(F.col("length") / UNIT).cast("int"))
     .withColumn("spread", F.xxhash64("doc_id", "start", "doc_crc32", F.rand(7))).write.parquet(folder))
    staged = spark.read.parquet(folder)
    demand = {r["class"]: r.n for r in staged.groupBy("class").agg(F.count("*").alias("n")).collect()}  # <= 512 rows
    plan = Plan(demand, capacity)
    placed = _placed(spark, _ranked(staged, sum(demand.values())), plan)
    placed = _stored(placed, "packing-placed")
    staged.stored_at = folder
    discard(staged)

    # several pieces share a sequence: their offsets are running sums in slot order
    whole = placed.where("sequence_id >= 0")
    w = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = (whole.where(F.col("class") == capacity).withColumn("offset", F.lit(0).cast("long"))
             .unionByName(whole.where(F.col("class") < capacity)
                          .withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0).cast("long")))))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not plan.leftover:
        return whole.select(columns)
    # at most one pattern's pieces for each class are left over
    rest = placed.where("sequence_id < 0").orderBy(F.desc("length"), "doc_id", "start", "spread").collect()
    return whole.select(columns).unionByName(_cut(spark, docs, path, key, text, rest, plan.sequences).select(columns))


def _ranked(staged: DataFrame, n: int) -> DataFrame:
    """``rank`` of each piece in its class, from counts of small buckets, so that no class meets in one task."""
    b = max(1, -(-n // RANKED_ROWS))
    rows = staged.withColumn("bucket", F.pmod("spread", F.lit(b)))
    counts = rows.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    # running sums over the buckets of a class, in two steps of about sqrt(buckets) each
    step = max(1, int(b ** 0.5))
    counts = counts.withColumn("group", F.floor(F.col("bucket") / step))
    groups = counts.groupBy("class", "group").agg(F.sum("n").alias("g"))
    over = Window.partitionBy("class").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("class", "group", F.coalesce(F.sum("g").over(over), F.lit(0)).alias("base"))
    within = Window.partitionBy("class", "group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    first = counts.join(groups, ["class", "group"]).select("class", "bucket", (F.col("base") + F.col("inside")).alias("first"))
    order = Window.partitionBy("class", "bucket").orderBy("spread", "doc_id", "start")
    return (rows.withColumn("k", F.row_number().over(order) - 1).join(first, ["class", "bucket"])
            .withColumn("rank", F.col("first") + F.col("k")).drop("k", "first", "bucket"))


def _placed(spark: SparkSession, ranked: DataFrame, plan: Plan) -> DataFrame:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "doc_crc32", "spread", "class", "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, rank = b.column(7).to_numpy(), b.column(8).to_numpy()
            seq, slot = np.empty(len(cls), np.int64), np.empty(len(cls), np.int64)
            for c in np.unique(cls).tolist():
                at = cls == c
                seq[at], slot[at] = plan.place(c, rank[at])
            yield pa.RecordBatch.from_arrays([*b.columns[:8], pa.array(seq), pa.array(slot)],
                                             names=[*names[:8], "sequence_id", "slot"])

    return ranked.select(names).mapInArrow(
        run, ranked.select(names[:8]).schema.add("sequence_id", "long").add("slot", "long"))


def power_cuts(total: int) -> list[int]:
    """Lengths of the sequences for ``total`` ids laid end to end: whole ones, then powers of two."""
    out, rest = [SEQUENCE] * (total // SEQUENCE), total % SEQUENCE
    return out + [1 << k for k in range(SEQUENCE.bit_length(), -1, -1) if rest >> k & 1]


def _cut(spark, docs: DataFrame, path: str, key: str, text: str, rest: list, first: int) -> DataFrame:
    """Lay the left-over pieces end to end, cut them where a sequence is full, and sum their ids anew."""
    room = power_cuts(sum(r.length for r in rest))
    made, k, used = [], 0, 0
    for uid, r in enumerate(rest):
        done = 0
        while done < r.length:
            n = min(r.length - done, room[k] - used)
            made.append((uid, r.doc_id, r.doc_tokens, r.doc_crc32, r.start + done, n,
                         r.ids_crc32 if n == r.length else None, first + k, used))
            done, used = done + n, used + n
            if used == room[k]:
                k, used = k + 1, 0
    rows = spark.createDataFrame(made, "uid int, doc_id long, doc_tokens long, doc_crc32 long, start long, "
                                       "length long, ids_crc32 long, sequence_id long, offset long")
    kept, split = rows.where("ids_crc32 IS NOT NULL"), rows.where("ids_crc32 IS NULL")
    wanted: dict = {}
    for _, doc, n, crc, start, length, known, _, _ in made:
        if known is None:
            wanted.setdefault((n, crc), set()).add((start, length))
    if not wanted:
        return kept
    ask = split.select("doc_id").distinct()                 # at most two cuts for each sequence of the remainder
    found = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = found.join(F.broadcast(ask), found.doc_id.eqNullSafe(ask.doc_id), "left_semi")

    def work(texts: pa.Array) -> dict:
        ids, bounds = encode_batch(texts, path, by_library=True)
        out, tokens, crcs = [], [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = np.append(ids[a:b], np.int32(END_ID))
            n, crc = len(own), zlib.crc32(own)
            tokens.append(n)
            crcs.append(crc)
            out.append([{"start": s, "length": m, "crc": zlib.crc32(own[s:s + m])}
                        for s, m in sorted(wanted.get((n, crc), ()))])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))
        return {"doc_tokens": pa.array(tokens, pa.int64()), "doc_crc32": pa.array(crcs, pa.int64()),
                "cuts": pa.array(out, kind)}

    sums = map_rows(found, ["doc_id"], "text", work, "doc_tokens long, doc_crc32 long, "
                    "cuts array<struct<start: long, length: long, crc: long>>")
    sums = sums.select("doc_tokens", "doc_crc32", F.inline("cuts")).distinct()
    split = split.drop("ids_crc32").join(sums, ["doc_tokens", "doc_crc32", "start", "length"], "left")
    return kept.unionByName(split.withColumnRenamed("crc", "ids_crc32"))
