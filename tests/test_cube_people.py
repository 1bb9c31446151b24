"""Iceberg cube and stored people bitmaps against brute force."""

import datetime as dt
import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shopcube.operators.iceberg import iceberg_cube
from shopcube.operators.people import merged_bitmaps, people_between, people_bitmaps, people_counts, people_rollup


@pytest.mark.parametrize("support", [1, 4, 30, 1000])
def test_iceberg_cube_has_all_frequent_cells(spark, support):
    r = random.Random(support)
    dims = ["a", "b", "c", "d"]
    rows = [(r.choice([None, 1, 1, 1, 2, r.randrange(40)]), r.choice("xyz"), r.randrange(6), r.choice([True, False, None]), r.randrange(9))
            for _ in range(500)]
    want = defaultdict(lambda: [0, 0])
    for x in rows:
        for k in range(5):
            for g in combinations(range(4), k):
                cell = want[(*[x[i] if i in g else None for i in range(4)], sum(8 >> i for i in range(4) if i not in g))]
                cell[0] += 1
                cell[1] += x[4]
    df = spark.createDataFrame(rows, "a int, b string, c int, d boolean, m long")
    got = iceberg_cube(df, dims, {"m": "total"}, support).collect()
    assert len(got) == len({tuple(x)[:5] for x in got})
    assert {tuple(x)[:5]: [x.row_count, x.total] for x in got} == {k: v for k, v in want.items() if v[0] >= support}
    assert iceberg_cube(df.where("false"), dims, {"m": "total"}, support).count() == 0


def _orders(spark, n, seed, days=40):
    r = random.Random(seed)
    rows = [(k % 2 + 1, dt.date(2023, 12, 20) + dt.timedelta(days=r.randrange(days)), 7 if r.random() < .3 else r.choice([r.randrange(50), 10 ** 12 + r.randrange(40)]),
             r.random() < .2, r.choice([0, 5, None]), r.random() < .3) for k in range(n)]
    cols = "platform_key int, order_date date, customer_key long, is_cancelled boolean, voucher_total int, has_return boolean"
    return spark.createDataFrame(rows, cols), rows


def _numbers(spark, rows):
    ids = sorted({x[2] for x in rows})
    return spark.createDataFrame([(c, 32768 * (i % 3) + i + 1) for i, c in enumerate(ids)], "customer_key long, sk long")


def _kinds(rows):
    return (len({x[2] for x in rows}), len({x[2] for x in rows if not x[3]}), len({x[2] for x in rows if (x[4] or 0) > 0}),
            len({x[2] for x in rows if x[5]}))


def test_people_of_any_period(spark):
    df, rows = _orders(spark, 600, 1)
    bitmaps = people_bitmaps(df, _numbers(spark, rows))
    got = {(x.grain, x.period_start, x.platform_key): tuple(x)[3:] for x in people_rollup(bitmaps).collect()}
    start = {"week": lambda d: d - dt.timedelta(days=d.weekday()), "month": lambda d: d.replace(day=1),
             "quarter": lambda d: d.replace(month=(d.month - 1) // 3 * 3 + 1, day=1), "year": lambda d: d.replace(month=1, day=1)}
    want = defaultdict(list)
    for x in rows:
        for g, f in start.items():
            want[g, f(x[1]), x[0]].append(x)
            want[g, f(x[1]), None].append(x)
    assert got == {k: _kinds(v) for k, v in want.items()}
    a, b = dt.date(2023, 12, 28), dt.date(2024, 1, 9)
    free = people_between(bitmaps, a, b).collect()
    assert [tuple(x)[1:] for x in free] == [_kinds([x for x in rows if a <= x[1] <= b])]


def test_late_orders_are_merged_and_loads_may_repeat(spark):
    df, rows = _orders(spark, 400, 2)
    numbers = _numbers(spark, rows)
    early, late = people_bitmaps(df.where("customer_key % 3 > 0"), numbers), people_bitmaps(df.where("customer_key % 3 = 0"), numbers)
    for stored in (merged_bitmaps(early, late), merged_bitmaps(late, early, late)):
        got = people_counts(stored, ["platform_key"]).collect()
        assert {x.platform_key: tuple(x)[1:] for x in got} == {p: _kinds([x for x in rows if x[0] == p]) for p in (1, 2)}


def test_people_of_no_orders(spark):
    df, rows = _orders(spark, 10, 3)
    assert people_rollup(people_bitmaps(df.where("false"), _numbers(spark, rows))).count() == 0
    nobody = people_bitmaps(df.withColumn("is_cancelled", F.lit(True)), _numbers(spark, rows))
    assert {x.buyers for x in people_counts(nobody, ["platform_key"]).collect()} == {0}


def test_cells_are_read_from_columns(spark):
    df = spark.createDataFrame([(k % 3, k % 2, k) for k in range(60)], "a int, b int, m long")
    plan = iceberg_cube(df, ["a", "b"], {"m": "total"}, 2)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan
