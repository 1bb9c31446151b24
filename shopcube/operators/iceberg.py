"""Iceberg cube: all cells of a cube that hold at least so many rows.

A cell can only reach the support if every cell above it does.  So the cube
is built from the top: one dimension, pairs, triples, ...; a row takes part
in a group-by only if all group-bys one dimension smaller have found its
values frequent.  Rows that can no longer be part of any frequent cell leave,
so the deep group-bys, which would have about as many groups as there are
facts, see only what is left.  No Expand copies fact rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.operators.dims import stored


def _grouped(rows: DataFrame, dims: tuple[str, ...], measures: dict[str, str], support: int) -> DataFrame:
    out = rows.groupBy(*dims).agg(F.sum("_n").alias("_n"), *[F.sum(f"_{a}").alias(f"_{a}") for a in measures.values()])
    return out.where(F.col("_n") >= support)


def _marked(rows: DataFrame, cells: DataFrame, dims: tuple[str, ...], mark: str) -> DataFrame:
    """``rows`` with ``mark``: whether their values are a frequent cell (null-safe; cells are unique)."""
    c = cells.select(*[F.col(x).alias(f"_k{i}") for i, x in enumerate(dims)], F.lit(True).alias(mark))
    same = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"_k{i}")) for i, x in enumerate(dims)])
    return rows.join(c, same, "left").drop(*[f"_k{i}" for i in range(len(dims))]).withColumn(mark, F.coalesce(mark, F.lit(False)))


def iceberg_cube(fact: DataFrame, dims: list[str], measures: dict[str, str], support: int) -> DataFrame:
    """Per frequent cell: dims (null where all), grouping_id, row_count and the sums of ``measures`` (column -> name).

    Exact for every cell of at least ``support`` rows; ``grouping_id`` has the
    bit of a dimension set where the cell is over all its values, the first
    dimension's bit being the highest, so a null value of a dimension is told
    from "all".  An empty fact has no cells.
    """
    live = stored(fact.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"),
                                                *[F.sum(c).alias(f"_{a}") for c, a in measures.items()]))
    apex = live.agg(F.sum("_n").alias("_n"), *[F.sum(f"_{a}").alias(f"_{a}") for a in measures.values()]).where(
        F.col("_n") >= support)
    found = [((), apex)]
    below: dict[tuple[str, ...], str] = {}                   # group-by of the level before -> mark of its rows
    for level in range(1, len(dims) + 1):
        marks, here = {}, []
        for group in combinations(dims, level):
            parents = [below.get(p) for p in combinations(group, level - 1)] if level > 1 else []
            if any(p is None for p in parents):              # a parent without frequent cells
                continue
            rows = live.where(reduce(lambda a, b: a & b, [F.col(p) for p in parents])) if parents else live
            cells = stored(_grouped(rows, group, measures, support))
            if cells.limit(1).count():
                here.append((group, cells))
        found += here
        if level == len(dims) or not here:
            break
        marked = live.drop(*below.values())
        for i, (group, cells) in enumerate(here):
            marks[group] = f"_f{level}_{i}"
            marked = _marked(marked, cells, group, marks[group])
        # a row goes on if some larger group-by finds all its parents frequent
        wider = [[marks.get(p) for p in combinations(g, level)] for g in combinations(dims, level + 1)]
        open_ = [reduce(lambda a, b: a & b, [F.col(p) for p in ps]) for ps in wider if all(ps)]
        if not open_:
            break
        live, below = stored(marked.where(reduce(lambda a, b: a | b, open_))), marks
    out = None
    for group, cells in found:
        gid = sum(1 << (len(dims) - 1 - i) for i, x in enumerate(dims) if x not in group)
        rows = cells.select(*[F.col(x) if x in group else F.lit(None).cast(fact.schema[x].dataType).alias(x) for x in dims],
                            F.lit(gid).cast("bigint").alias("grouping_id"), F.col("_n").alias("row_count"),
                            *[F.col(f"_{a}").alias(a) for a in measures.values()])
        out = rows if out is None else out.unionByName(rows)
    return out
