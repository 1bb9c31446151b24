"""Counting points in many overlapping windows without joining points to windows.

How many orders lie in a voucher's window and reach its minimum spend is a
dominance count.  Every order is read once and becomes a cell: the stretch of
time between two window borders it falls into, and the step between two
minimum amounts it reaches.  Cells are counted with map-side combination, so
what is left does not depend on how many windows cover an order.  A window is
a range of stretches; ranges are cut into dyadic nodes (at most two a level),
cells are added up to the nodes that some window asks for, and inside a node
the cells at or above the minimum are a running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopcube.operators.dims import checkpointed
from shopcube.operators.sequence import running_aggregates

LISTED = 200_000         # borders that are sent along as one array (1.6 MB); more are merged in by sorting


def steps_reached(borders: Column, x: Column) -> Column:
    """How many entries of a sorted array without nulls are <= ``x`` (binary search with built-in functions)."""
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(borders) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size(borders).alias("hi"))

    def halve(s, _):
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        up = F.get(borders, mid) <= x
        lo = F.when(s["lo"] >= s["hi"], s["lo"]).when(up, mid + 1).otherwise(s["lo"])
        hi = F.when(s["lo"] >= s["hi"], s["hi"]).when(up, s["hi"]).otherwise(mid)
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    return F.aggregate(halvings, start, halve)["lo"]


def place_among(rows: DataFrame, column: str, borders: DataFrame, name: str, listed: int = LISTED) -> DataFrame:
    """``rows`` with ``name``: how many distinct values of ``borders`` (column ``x``) are <= ``column``.

    Up to ``listed`` borders travel as one sorted array; beyond that both sides
    are sorted together over all executors.  Rows with a null go.
    """
    rows = rows.where(F.col(column).isNotNull())
    borders = borders.where("x IS NOT NULL").distinct()
    if borders.limit(listed + 1).count() <= listed:
        known = borders.agg(F.array_sort(F.collect_list("x"))).scalar()
        return rows.withColumn("borders", known).withColumn(name, steps_reached(F.col("borders"), F.col(column))).drop("borders")
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    both = (rows.select(F.col(column).alias("x"), F.lit(1).alias("side"), F.lit(0).alias("one"), own.alias("row"))
            .unionByName(borders.select("x", F.lit(0).alias("side"), F.lit(1).alias("one"),
                                        F.lit(None).cast(rows.select(own).schema[0].dataType).alias("row"))))
    both = both.withColumn("everything", F.lit(0))
    placed = running_aggregates(both, ["everything"], ["x", "side"], sums=["one"])
    return placed.where("side = 1").select("row.*", F.coalesce("prior_sum_one", F.lit(0)).cast("int").alias(name))


def _nodes_of_range(a: Column, b: Column, levels: Column) -> Column:
    """Dyadic nodes (level, number) whose union is the range of whole numbers [a, b)."""
    def at(level):
        size = F.call_function("shiftleft", F.lit(1), level)
        low, high = F.ceil(a / size).cast("int"), F.floor(b / size).cast("int")
        first = F.when((low < high) & (low % 2 == 1), low)
        rest = low + low % 2
        last = F.when((low < high) & (high % 2 == 1) & (rest < high), high - 1)
        return F.transform(F.array(first, last), lambda n: F.struct(level.alias("level"), n.alias("node")))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), levels), at)), lambda s: s["node"].isNotNull())


def count_in_windows(points: DataFrame, time: str, value: str, windows: DataFrame, key: str, start: str, end: str,
                     least: str, listed: int = LISTED) -> DataFrame:
    """(key, points): per window, the points with ``start <= time <= end`` and ``value >= least``.

    ``start`` and ``end`` have the type of ``time``, ``least`` that of
    ``value``; a window with a null in any of them has no points, nor has one
    that ends before it starts.  Equal windows may repeat.  Each point is read
    once and is no row of any join; the rows after it are cells.
    """
    w = windows.select(F.col(key).alias("k"), F.col(start).alias("s"), F.col(end).alias("e"), F.col(least).alias("m"))
    w = checkpointed(w.where("s IS NOT NULL AND e IS NOT NULL AND m IS NOT NULL AND s <= e"))     # read several times
    after = F.struct(F.col("e").alias("t"), F.lit(1).alias("past"))           # just behind the window's last moment
    times = w.select(F.struct(F.col("s").alias("t"), F.lit(0).alias("past")).alias("x")).unionByName(w.select(after.alias("x")))
    amounts = w.select(F.col("m").alias("x"))

    p = points.select(F.struct(F.col(time).alias("t"), F.lit(0).alias("past")).alias("t"), F.col(time).alias("at"),
                      F.col(value).alias("v")).where("at IS NOT NULL AND v IS NOT NULL").drop("at")
    p = place_among(place_among(p, "t", times, "seg", listed), "v", amounts, "step", listed)
    cells = p.groupBy("seg", "step").agg(F.count(F.lit(1)).alias("n"))

    w = w.withColumns({"t": F.struct(F.col("s").alias("t"), F.lit(0).alias("past")), "u": after})
    for name, column, borders in (("a", "t", times), ("b", "u", times), ("c", "m", amounts)):
        w = place_among(w, column, borders, name, listed)
    w = checkpointed(w.select("k", "a", "b", "c"))
    # an order in the window has seg in [a, b) and step >= c
    levels = F.ceil(F.log2(F.greatest(w.agg(F.max("b")).scalar(), F.lit(1)) + 1)).cast("int")
    asked = (w.withColumn("levels", levels)
             .select("k", "c", F.explode(_nodes_of_range(F.col("a"), F.col("b"), F.col("levels"))).alias("n"))
             .select("k", "c", "n.*"))
    nodes = asked.select("level", "node").distinct()
    held = (cells.withColumn("level", F.explode(F.sequence(F.lit(0), levels)))
            .select("level", F.expr("shiftright(seg, level)").alias("node"), "step", "n")
            .groupBy("level", "node", "step").agg(F.sum("n").alias("n")).join(nodes, ["level", "node"], "left_semi"))
    both = (held.select("level", "node", (-F.col("step")).alias("down"), F.lit(0).alias("side"), "n",
                        F.lit(None).cast(w.schema["k"].dataType).alias("k"))
            .unionByName(asked.select("level", "node", (-F.col("c")).alias("down"), F.lit(1).alias("side"),
                                      F.lit(0).cast("bigint").alias("n"), "k")))
    placed = running_aggregates(both, ["level", "node"], ["down", "side"], sums=["n"])
    return (placed.where("side = 1").groupBy(F.col("k").alias(key))
            .agg(F.sum(F.coalesce("prior_sum_n", F.lit(0))).cast("bigint").alias("points")).where("points > 0"))
