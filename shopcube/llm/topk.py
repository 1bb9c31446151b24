"""Operator 11: exact top-k search by inner product with vector-approximation files.

Vectors become whole numbers, floor(256 x).  The approximation file keeps a
byte for each component: the cell it lies in.  Cells follow the size of the
number (sign, power of two and the next two binary digits), so they need no
fit, hold any value and are exact below 8.

1. Scan: queries meet the cells of all vectors in blocks.  Cells bound the
   score from both sides; a vector whose upper bound is below the k-th best
   lower bound is out of question.
2. Reading: the exact vectors of those left are scored in the order of their
   upper bounds, until no bound reaches the k-th score found.

Equal vectors are one class with its k + 1 least ids: no more of them can be
among the first k.  A block returns at most k + 1 ids for each of its
queries, and each vector at most once for all of them, so no list of pairs is
made however many vectors lie close together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.components import _stored, discard

K = 5
STEP = 50                # rows whose id is divisible by this are queries
SCALE = 256.0
QUERY_BLOCK = 256        # queries of a block; up to QUERY_MOST where there are very many
QUERY_MOST = 4096
CELL_BLOCK = 8192        # vectors of a block; more where there are very many, as they are streamed
PARTS = 64               # blocks of vectors up to which blocks do not grow
CELL_MOST = 1 << 20
BATCH = 1 << 20          # products held at a time


def cells_of(x: np.ndarray) -> np.ndarray:
    """The cell of each whole number below 2**31 in size: sign, power of two, next two digits."""
    size = np.abs(x.astype(np.int64))
    power = np.frexp(size.astype(np.float64))[1].astype(np.int64)        # 0 for 0, else digits of the number
    shift = np.maximum(power - 3, 0)
    cell = np.where(power <= 3, size, shift * 4 + (size >> shift))
    return np.where(x < 0, cell + 128, cell).astype(np.uint8)


def cell_bounds() -> tuple[np.ndarray, np.ndarray]:
    """(middle, half width) of the 256 cells."""
    code = np.arange(128)
    shift = np.maximum(code // 4 - 1, 0)
    low = np.where(code < 8, code, (code - shift * 4).astype(np.float64) * 2.0 ** shift)
    high = low + 2.0 ** shift - 1
    middle, half = (low + high) / 2, (high - low) / 2
    return np.concatenate([middle, -middle]), np.concatenate([half, half])


MIDDLE, HALF = cell_bounds()


class Bounds:
    """Lower and upper bounds of the scores of some queries against cells."""

    def __init__(self, queries: np.ndarray):
        self.q = queries.astype(np.float64)
        self.size = np.abs(self.q)
        self.norm = np.sqrt((self.q * self.q).sum(axis=1))

    def of(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle, half = MIDDLE[cells], HALF[cells]
        far = np.abs(middle) + half
        # the sums are rounded by far less than this share of the lengths' product
        off = self.size @ half.T + 1e-9 * self.norm[:, None] * np.sqrt((far * far).sum(axis=1))[None, :]
        score = self.q @ middle.T
        return score - off, score + off


def whole_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dim, raw, cells) of the rows that take part; raw: the whole numbers, 4 bytes each."""
    rows = table.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            flat = v.flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64)          # null becomes NaN
            n = v.value_lengths().to_numpy()
            at = np.concatenate([[0], np.cumsum(n)])
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(SCALE * x)
                able = np.logical_and.reduceat(np.isfinite(x), at[:-1]) if len(n) else np.zeros(0, bool)
                able &= np.add.reduceat(x * x, at[:-1]) < 2.0 ** 62 if len(n) else able
            ids, dims, raws, codes = [], [], [], []
            for i in np.flatnonzero(able).tolist():
                c = x[at[i]:at[i + 1]].astype(np.int32)
                ids.append(i), dims.append(len(c)), raws.append(c.tobytes()), codes.append(cells_of(c).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(dims, pa.int32()), pa.array(raws, pa.binary()),
                 pa.array(codes, pa.binary())], names=["id", "dim", "raw", "cells"])

    return rows.mapInArrow(run, "id long, dim int, raw binary, cells binary")


def blocks_of(n: int, least: int, most: int, parts: int) -> int:
    """Number of blocks for ``n`` rows: blocks of ``least``, and up to ``most`` beyond ``parts`` blocks."""
    return max(1, min(-(-n // least), max(parts, -(-n // most))))


def _matrix(col: pa.Array, dim: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dim)


def _grouped(batches: Iterator[pa.RecordBatch], begin, more, finish) -> Iterator[pa.RecordBatch]:
    """Walk over rows sorted by (block, part, c) with the queries (c = -1 - number) first.

    ``begin(rows)`` takes the queries of a block, ``more(state, rows)`` some of
    its vectors, ``finish(state)`` returns a batch.
    """
    now, held, state = None, [], None
    for b in batches:
        key = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy() < 0])
        at = np.append(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))), b.num_rows)
        for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
            part, block = b.slice(x, y - x), (int(key[0, x]), int(key[1, x]))
            if block != now:
                if state is not None:
                    yield finish(state)
                now, held, state = block, [], None
            if key[2, x]:
                held.append(part)
                continue
            if state is None and held:
                state, held = begin(pa.Table.from_batches(held).combine_chunks()), []
            if state is not None:
                more(state, part)
    if state is not None:
        yield finish(state)


def _dealt(queries: DataFrame, files: DataFrame, parts: int, parted: list[str], cols: list[str]) -> DataFrame:
    """Queries and vectors of every (block, part), sorted so that the queries come first.

    ``files`` rows name their block; queries go to all ``parts``.
    """
    q = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    q = q.withColumn("c", -1 - F.col("c"))
    both = q.select(*parted, *cols).unionByName(files.select(*parted, *cols))
    return both.repartition("block", "part").sortWithinPartitions("block", "part", "c")


def scan(queries: DataFrame, cells: DataFrame, parts: int, k: int) -> DataFrame:
    """(block, q, c, low): lower bounds of each query's best (c null), and the vectors that a block has to read (q null)."""
    cols = ["c", "dim", "body"]
    dealt = _dealt(queries.withColumnRenamed("raw", "body"), cells.withColumnRenamed("cells", "body"), parts,
                   ["block", "part"], cols)

    def begin(t: pa.Table) -> dict:
        dim = t.column("dim")[0].as_py()
        bounds = Bounds(_matrix(t.column("body"), dim, np.int32))
        n = t.num_rows
        return {"block": t.column("block")[0].as_py(), "ids": -1 - t.column("c").to_numpy(), "dim": dim, "bounds": bounds,
                "best": np.full((n, k), -np.inf), "left": []}

    def more(state: dict, rows: pa.RecordBatch) -> None:
        step = max(1, BATCH // len(state["ids"]))
        for x in range(0, rows.num_rows, step):
            part = rows.slice(x, step)
            c = part.column(2).to_numpy()
            low, high = state["bounds"].of(_matrix(part.column(4), state["dim"], np.uint8))
            best = np.concatenate([state["best"], low], axis=1)
            state["best"] = best = -np.partition(-best, k - 1, axis=1)[:, :k]
            gap = (high - best.min(axis=1, keepdims=True)).max(axis=0)
            near = np.flatnonzero(gap >= 0)                                   # some query may need it
            state["left"].append(c[near])

    def finish(state: dict) -> pa.RecordBatch:
        best, ids = state["best"], state["ids"]
        q, at = np.nonzero(np.isfinite(best))
        left = np.concatenate(state["left"]) if state["left"] else np.zeros(0, np.int64)
        n, m = len(q), len(left)
        pad = lambda x, first: pa.array(np.concatenate([x, np.zeros(m, x.dtype)] if first else [np.zeros(n, x.dtype), x]),
                                        mask=np.arange(n + m) >= n if first else np.arange(n + m) < n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n + m, state["block"], np.int64)), pad(ids[q].astype(np.int64), True),
             pad(left.astype(np.int64), False), pad(best[q, at], True)], names=["block", "q", "c", "low"])

    return dealt.mapInArrow(lambda b: _grouped(b, begin, more, finish), "block long, q long, c long, low double")


def read_exact(queries: DataFrame, vectors: DataFrame, parts: int, k: int) -> DataFrame:
    """(q, c, id, score): the k best ids of each query in each block, from exact vectors in the order of their bounds.

    ``queries`` carry ``least``, a lower bound of their k-th score.
    """
    cols = ["c", "dim", "raw", "least", "ids"]
    dealt = _dealt(queries.withColumn("ids", F.lit(None).cast("array<long>")), vectors.withColumn("least", F.lit(None).cast("double")),
                   parts, ["block", "part"], cols)

    def begin(t: pa.Table) -> dict:
        dim = t.column("dim")[0].as_py()
        q = _matrix(t.column("raw"), dim, np.int32)
        return {"ids": -1 - t.column("c").to_numpy(), "dim": dim, "q": q.astype(np.int64), "bounds": Bounds(q),
                "least": np.nan_to_num(t.column("least").to_numpy(), nan=-np.inf, neginf=-np.inf), "best": [[] for _ in range(len(q))]}

    def more(state: dict, rows: pa.RecordBatch) -> None:
        step = max(1, BATCH // len(state["ids"]))
        for x in range(0, rows.num_rows, step):
            part = rows.slice(x, step)
            raw = _matrix(part.column(4), state["dim"], np.int32)
            exact, cls, ids = raw.astype(np.int64), part.column(2).to_numpy(), part.column(6).to_pylist()
            high = state["bounds"].of(cells_of(raw))[1]
            for i, best in enumerate(state["best"]):
                least = max(state["least"][i], -best[k - 1][0] if len(best) >= k else -np.inf)
                can = np.flatnonzero(high[i] >= least)
                can = can[np.argsort(-high[i, can], kind="stable")]
                at, width = 0, 4 * k
                while at < len(can) and high[i, can[at]] >= least:
                    some = can[at:at + width]
                    score = exact[some] @ state["q"][i]
                    good = np.flatnonzero(score >= least)
                    best = sorted([*best, *((-s, v, c) for s, j in zip(score[good].tolist(), some[good].tolist())
                                            for c in [int(cls[j])] for v in ids[j])])[:k]
                    if len(best) >= k:
                        least = max(least, -best[k - 1][0])
                    at, width = at + width, width * 2
                state["best"][i] = best

    def finish(state: dict) -> pa.RecordBatch:
        rows = [(int(q), c, v, -s) for q, best in zip(state["ids"], state["best"]) for s, v, c in best]
        cols_ = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols_], names=["q", "c", "id", "score"])

    return dealt.mapInArrow(lambda b: _grouped(b, begin, more, finish), "q long, c long, id long, score long")


def _best(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each group; every task passes on no more than ``k`` of a group."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= k)


def top_k(table: DataFrame, k: int = K, step: int = STEP, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id, score (long) of the ``k`` highest scores, ties to the smaller id.

    Queries are the rows whose id is divisible by ``step``; every other row of
    the same length is a candidate.  Vectors that are null or empty, hold a
    null or non-finite component, or have no id take no part, nor do those
    whose squared length in whole numbers reaches 2**62, as their scores are
    no long.  Rows equal in id and vector count once; rows of one id with
    different vectors are vectors of their own.  With fewer candidates than
    ``k`` all are returned, without any the query has no row; an empty table
    gives an empty result.  Extra columns are not read.
    """
    more = k + 1                                     # a query's own row may be among the best
    vectors = _stored(whole_vectors(table, key, vector), "topk-vectors")
    least = (vectors.dropDuplicates(["id", "raw"])
             .withColumn("place", F.row_number().over(Window.partitionBy("raw").orderBy("id"))).where(F.col("place") <= more))
    classes = _stored(least.groupBy("raw").agg(F.first("dim").alias("dim"), F.first("cells").alias("cells"),
                                               F.array_sort(F.collect_list("id")).alias("ids"))
                      .withColumn("c", F.monotonically_increasing_id()), "topk-classes")
    asked = _stored(vectors.where(F.col("id") % step == 0).select("id", "raw").distinct()
                    .join(classes.select("raw", "c", "dim"), "raw"), "topk-asked")
    queries = asked.groupBy("c").agg(F.first("dim").alias("dim"), F.first("raw").alias("raw"))

    n_q, n_c = queries.count(), classes.count()
    blocks, parts = blocks_of(n_q, QUERY_BLOCK, QUERY_MOST, 16), blocks_of(n_c, CELL_BLOCK, CELL_MOST, PARTS)
    # vectors of different lengths are never compared: a block number belongs to one length
    block = F.col("dim").cast("long") * (1 << 32) + F.pmod(F.xxhash64("c"), F.lit(blocks))
    queries = _stored(queries.withColumn("block", block), "topk-queries")
    used = queries.select("block", "dim").distinct()
    part = F.pmod(F.xxhash64("c", F.lit(1)), F.lit(parts)).cast("int").alias("part")
    files = classes.select("c", "dim", "cells", part).join(used, "dim")
    seen = _stored(scan(queries, files, parts, more), "topk-scan")

    lows = _best(seen.where("q IS NOT NULL").select("q", "low"), "q", [F.desc("low")], more)
    lows = lows.groupBy("q").agg(F.when(F.count("*") == more, F.min("low")).alias("least")).withColumnRenamed("q", "c")
    needed = seen.where("q IS NULL").select("block", "c")
    exact = needed.join(classes.select("c", "dim", "raw", "ids", part), "c")
    found = _stored(read_exact(queries.join(lows, "c", "left").select("c", "dim", "raw", "block", "least"), exact, parts, more),
                    "topk-found")

    best = _best(found, "q", [F.desc("score"), "id", "c"], more).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "c", "score"))).alias("best"))
    answers = asked.select("id", "c").join(best.withColumnRenamed("q", "c"), "c").select(
        F.col("id").alias("query_id"),
        F.expr(f"slice(filter(best, x -> NOT (x.id = id AND x.c = c)), 1, {k})").alias("best"))
    answers = _stored(answers.select("query_id", F.posexplode("best").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")),
        "topk-answers")
    discard(vectors, classes, asked, queries, seen, found)
    return answers
