"""Exact ranks by parallel sorting with regular sampling.

1. Every task sorts its rows: a run.
2. Every run gives its rows at equal distances; the samples of all runs give
   the splitters, again at equal distances.  Their number has a fixed bound.
3. Rows go to the segment between two splitters, whose sorted pieces are
   merged by the task that receives them.
4. The rows of the segments before (prefix counts) and the place in its
   segment make the rank of a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = 1 << 18        # rows of a segment, about; fewer where tasks would stay without one
SEGMENTS = 1 << 15       # segments at most: beyond 8 billion rows they grow
OVER = 32                # samples of a segment


def _segments(keys: list[np.ndarray], splitters: np.ndarray) -> np.ndarray:
    """How many splitters stand before or at each row; rows and splitters compare column by column."""
    n, m = len(keys[0]), len(splitters)
    if not m:
        return np.zeros(n, np.int32)
    cols = [np.concatenate([splitters[:, k], keys[k]]) for k in range(len(keys))]
    order = np.lexsort(cols[::-1])            # equal keys: splitters first
    passed = np.cumsum(order < m)
    out = np.empty(n + m, np.int32)
    out[order] = passed
    return out[m:]


def _samples(df: DataFrame, keys: list[str], stride: int) -> np.ndarray:
    """Every ``stride``-th row of every sorted run, sorted: at most about OVER * SEGMENTS rows.

    Runs begin at different rows, so that runs shorter than the stride are seen as well.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = TaskContext.get().partitionId() * 0x9E3779B1 % stride
        for b in batches:
            yield b.take(pa.array(np.arange(skip, b.num_rows, stride)))
            skip = (skip - b.num_rows) % stride

    runs = df.select(keys).sortWithinPartitions(*keys)
    rows = runs.mapInArrow(run, ", ".join(f"{k} long" for k in keys)).toArrow()
    found = np.stack([rows.column(k).to_numpy() for k in keys], axis=1) if rows.num_rows else np.zeros((0, len(keys)), np.int64)
    return found[np.lexsort(found.T[::-1])]


def ranked(df: DataFrame, keys: list[str], limit: int, rank: str = "rank") -> DataFrame:
    """The rows of ``df`` with their place 1, 2, 3.. in the order of ``keys`` up to ``limit``, null beyond it.

    ``keys`` are long columns without nulls whose values together are
    different in all rows; ``df`` is a stored table, as it is read three
    times.  Rows of segments beyond the limit are not moved.
    """
    n = df.count()
    empty = df.withColumn(rank, F.lit(None).cast("long"))
    if not n or limit <= 0:
        return empty
    tasks = df.sparkSession.sparkContext.defaultParallelism
    segments = max(1, min(SEGMENTS, max(-(-n // SEGMENT), min(tasks, n // 1024))))
    found = _samples(df, keys, max(1, n // (OVER * segments)))
    splitters = found[np.arange(1, segments) * len(found) // segments] if len(found) else found

    def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [b.column(b.schema.get_field_index(k)).to_numpy() for k in keys]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_segments(own, splitters), pa.int32())],
                                             names=[*b.schema.names, "__segment"])

    dealt = df.mapInArrow(part_of, T.StructType([*df.schema.fields, T.StructField("__segment", T.IntegerType())]))
    sizes = {r[0]: r[1] for r in dealt.groupBy("__segment").count().collect()}        # one row for each segment
    before = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(segments)])])
    used = int(np.searchsorted(before, limit, "left"))              # segments that hold a rank within the limit

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = -1, 0
        for b in batches:
            seg = b.column(b.num_columns - 1).to_numpy()
            new = np.append(True, seg[1:] != seg[:-1])
            at = np.flatnonzero(new)
            inside = np.arange(len(seg)) - np.repeat(at, np.diff(np.append(at, len(seg))))
            if len(seg) and seg[0] == now:
                inside[:at[1] if len(at) > 1 else len(seg)] += seen
            r = before[seg] + inside + 1
            if len(seg):
                now, seen = int(seg[-1]), int(inside[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(r, pa.int64(), mask=r > limit)],
                                             names=[*b.schema.names[:-1], rank])

    drawn = (dealt.where(F.col("__segment") < used).repartitionById(max(used, 1), F.col("__segment"))
             .sortWithinPartitions("__segment", *keys).mapInArrow(place, empty.schema))
    rest = dealt.where(F.col("__segment") >= used).drop("__segment").withColumn(rank, F.lit(None).cast("long"))
    return drawn.unionByName(rest)
