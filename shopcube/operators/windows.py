"""Ranking and trend operators (W04, W05, O04) and sessionisation.

Windows are only partitioned by keys whose groups are bounded by design
(a platform's days: the calendar) -- never by a product category, voucher
or user, which can hold a third of all rows.  Those use two-phase plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcube.operators.sequence import running_aggregates


def top_n_per_group(df: DataFrame, group_cols: list[str], order: list[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group in ``order`` (which must be
    total).  The planner puts a group limit before the shuffle, so at most n
    rows of a group leave each input partition.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k; planned as TakeOrderedAndProject (per-partition
    top-k, then a k-way merge), so it never sorts the whole input."""
    return df.orderBy(*order).limit(k)


def daily_trend(daily: DataFrame, partition_col: str, date_col: str, value_col: str,
                window_days: int = 7) -> DataFrame:
    """Previous value, change and a trailing moving average.  The
    window partition is one platform's days: bounded by the calendar."""
    w = Window.partitionBy(partition_col).orderBy(date_col)
    prev = F.lag(value_col).over(w)
    return daily.select(
        "*", prev.alias(f"prev_{value_col}"),
        (F.col(value_col) - prev).alias(f"change_{value_col}"),
        (F.sum(value_col).over(w.rowsBetween(-(window_days - 1), 0))
         / F.count(value_col).over(w.rowsBetween(-(window_days - 1), 0)))
        .alias(f"avg{window_days}_{value_col}"))


def sessionize(events: DataFrame, user_col: str, ts_col: str, id_col: str,
               gap_minutes: int = 30) -> DataFrame:
    """session start per event; a new session begins when the gap to
    the user's previous event is at least ``gap_minutes`` (the semantics of
    ``session_window``).  Exact and skew-safe: two running-maximum passes
    (previous event time, then latest session start) instead of a window
    over each user's whole history."""
    order = [ts_col, id_col]
    r1 = running_aggregates(events, [user_col], order, maxes=[ts_col])
    prev = F.col(f"prior_max_{ts_col}")
    new = prev.isNull() | (F.col(ts_col) >= prev + F.expr(f"INTERVAL {gap_minutes} MINUTES"))
    flagged = r1.withColumn("_start", F.when(new, F.col(ts_col))).drop(
        f"prior_max_{ts_col}", "prior_count")
    r2 = running_aggregates(flagged, [user_col], order, maxes=["_start"])
    return r2.withColumn("session_start", F.coalesce("_start", "prior_max__start")) \
        .drop("_start", "prior_max__start", "prior_count")
