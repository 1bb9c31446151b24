"""Stored history and first-order index: batches in any order give the table of the full build."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopcube.operators.history import STATE, customer_history, load_first_orders, load_history, merge_history


def _orders(spark, n, seed):
    r = random.Random(seed)
    rows = [(k, 7 if r.random() < .35 else r.randrange(25), dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(60)),
             Decimal(r.randrange(10 ** 8)) / 100, k % 2 + 1) for k in range(n)]
    df = spark.createDataFrame(rows, "order_key long, customer_key long, order_date date, buyer_paid_price decimal(10,2), platform_key int")
    return df.withColumn("order_ts", F.col("order_date").cast("timestamp_ntz")), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_history_by_batches_equals_the_full_build(spark, tmp_path, seed):
    df, rows = _orders(spark, 150, seed)
    root = str(tmp_path / "h")
    part = list(range(4))
    random.Random(seed).shuffle(part)
    for p in part:
        load_history(df.where(F.col("order_key") % 4 == p), root, buckets=4)
    load_history(df.where("false"), root, buckets=4)
    cols = ["customer_key", "valid_from", "orders_to_date", "spent_to_date", "previous_order_date", "segment", "valid_to"]
    key = lambda x: sorted(map(tuple, x.select(*cols).collect()))
    assert key(spark.read.parquet(root)) == key(customer_history(df))


def test_a_late_order_leaves_earlier_states_alone(spark):
    df, _ = _orders(spark, 60, 3)
    one = merge_history(None, df.where("order_date < '2024-02-01'"))
    late = df.where("order_date >= '2024-02-01'")
    both = merge_history(one, late)
    before = one.where("valid_to IS NOT NULL").select(*STATE)
    assert before.exceptAll(both.select(*STATE)).count() == 0
    assert merge_history(one, late.where("false")).exceptAll(one).count() == 0


def test_new_customers_are_retracted(spark, tmp_path):
    df, rows = _orders(spark, 120, 4)
    root, total = str(tmp_path / "f"), {}
    for p in (2, 0, 1, 1):                                       # the last load comes again
        for x in load_first_orders(df.where(F.col("order_key") % 3 == p), root, buckets=4).collect():
            total[x.order_date, x.platform_key] = total.get((x.order_date, x.platform_key), 0) + x.change
    first = {}
    for k, c, d, _, p in rows:
        first[c] = min(first.get(c, (d, k, p)), (d, k, p))
    want = {}
    for d, _, p in first.values():
        want[d, p] = want.get((d, p), 0) + 1
    assert {k: v for k, v in total.items() if v} == want
    assert spark.read.parquet(root).count() == len(first)


def test_summary_by_change_sets_replaces_touched_months_only(spark, tmp_path):
    import os

    from shopcube.operators.mart_batches import load_changes, read_summary
    from shopcube.operators.marts import sales_summary
    from shopcube.plans.model import Model
    from tests.conftest import SF001
    now = Model(spark, SF001).priced_orders.where("order_date < '1997-01-01'")
    root = str(tmp_path / "s")
    cols = ["time_key", "platform_key", "total_orders", "net_revenue", "unique_customers", "new_customers", "vouchers_used", "average_order_value"]
    key = lambda df: sorted(map(tuple, df.select(*cols).collect()))
    load_changes(now.withColumn("sign", F.lit(1)), root)
    assert key(read_summary(spark, root)) == key(sales_summary(now))
    files = lambda t: {m: sorted(os.listdir(f"{root}/{t}/{m}")) for m in os.listdir(f"{root}/{t}") if m.startswith("month=")}
    before = files("days")
    one = now.where("order_date >= '1996-03-01' AND order_date < '1996-04-01'")
    load_changes(one.withColumn("sign", F.lit(-1)).unionByName(
        one.withColumn("is_cancelled", F.lit(True)).withColumn("sign", F.lit(1))), root)
    after = files("days")
    assert {m for m in after if after[m] != before[m]} == {"month=1996-03"}
    changed = now.withColumn("is_cancelled", F.col("is_cancelled") | F.col("order_date").between("1996-03-01", "1996-03-31"))
    assert key(read_summary(spark, root)) == key(sales_summary(changed))
    assert key(read_summary(spark, root, ["1996-03"])) == key(sales_summary(changed, now).where("date_format(date, 'yyyy-MM') = '1996-03'"))
    load_changes(now.where("false").withColumn("sign", F.lit(1)), root)
    assert files("days") == after
