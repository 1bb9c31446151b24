"""Counting in overlapping windows against DuckDB's range join."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from shopcube.operators.intervals import count_in_windows

T0 = dt.datetime(1994, 1, 1)


def _frames(spark, n, m, seed, hot=0.3):
    r = random.Random(seed)
    points = [(T0 if r.random() < hot else T0 + dt.timedelta(seconds=r.randrange(10 ** 8)), r.choice([0, 100, r.randrange(10 ** 5)]))
              for _ in range(n)] + [(None, 5), (T0, None)]
    windows = []
    for k in range(m):
        a = T0 + dt.timedelta(seconds=r.randrange(10 ** 8))
        b = a + dt.timedelta(seconds=r.choice([0, r.randrange(10 ** 8), -5]))
        windows.append((k, T0 if r.random() < .2 else a, b, r.choice([0, 100, r.randrange(10 ** 5)])))
    windows += [(m, None, T0, 1), (m + 1, T0, None, 1), (m + 2, T0, T0, None), (m + 3, T0, T0, 0), (m + 3, T0, T0, 0)]
    p = spark.createDataFrame(points, "t timestamp_ntz, v long")
    w = spark.createDataFrame(windows, "k long, s timestamp_ntz, e timestamp_ntz, least long")
    return p, w, pd.DataFrame(points, columns=["t", "v"]), pd.DataFrame(windows, columns=["k", "s", "e", "least"])


def _expected(p, w):
    con = duckdb.connect()
    con.register("p", p), con.register("w", w)
    return dict(con.execute("""SELECT k, count(*) FROM w JOIN p ON CAST(t AS TIMESTAMP) BETWEEN CAST(s AS TIMESTAMP) AND CAST(e AS TIMESTAMP)
                               AND v >= least GROUP BY k""").fetchall())


@pytest.mark.parametrize("n,m,listed", [(400, 60, 200_000), (400, 60, 3), (3, 1, 200_000)])
def test_counts_equal_the_range_join(spark, n, m, listed):
    p, w, pp, pw = _frames(spark, n, m, seed=n + m)
    got = count_in_windows(p, "t", "v", w, "k", "s", "e", "least", listed)
    assert {r.k: r.points for r in got.collect()} == _expected(pp, pw)


def test_ten_thousand_overlapping_windows(spark):
    p, w, pp, pw = _frames(spark, 2000, 10_000, seed=1)
    got = count_in_windows(p, "t", "v", w, "k", "s", "e", "least")
    assert {r.k: r.points for r in got.collect()} == _expected(pp, pw)


def test_empty_sides(spark):
    p, w, _, _ = _frames(spark, 20, 5, seed=3)
    assert count_in_windows(p.where("false"), "t", "v", w, "k", "s", "e", "least").count() == 0
    assert count_in_windows(p, "t", "v", w.where("false"), "k", "s", "e", "least").count() == 0


def test_points_meet_no_windows_in_a_join(spark):
    """The only joins are of nodes and cells; the points are read once."""
    p, w, _, _ = _frames(spark, 50, 5, seed=4)
    p = p.where("v >= 0")
    plan = count_in_windows(p, "t", "v", w, "k", "s", "e", "least")._jdf.queryExecution().optimizedPlan().toString()
    assert "Nested" not in plan and "Cartesian" not in plan
