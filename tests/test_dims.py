"""Calendar, pricing formula and segment rules on hand-picked rows (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shopcube.operators.dims import build_dim_time
from shopcube.operators.facts import buyer_paid_price, voucher_total


def test_calendar_rows(spark):
    hol = spark.createDataFrame([(dt.date(2024, 6, 12),)], "date date")
    cal = build_dim_time(spark, "2024-01-01", "2025-12-31", holidays=hol)
    assert cal.count() == 731
    r = {str(x["date"]): x for x in cal.collect()}
    assert r["2024-02-29"]["time_key"] == 20240229 and r["2024-02-29"]["season"] == "Winter"
    assert r["2024-12-30"]["week"] == 1 and r["2024-12-30"]["day_of_week"] == 1   # ISO week 1, Monday
    assert r["2024-11-11"]["is_mega_sale_day"] and r["2024-12-12"]["is_mega_sale_day"]
    assert r["2024-06-15"]["is_weekend"] and r["2024-06-15"]["day_name"] == "Saturday"
    assert r["2024-06-12"]["is_holiday"] and not r["2024-06-15"]["is_holiday"]


def test_fiscal_year(spark):
    cal = build_dim_time(spark, "2024-03-31", "2024-04-01", fiscal_start=4)
    r = {str(x["date"]): x for x in cal.collect()}
    assert (r["2024-03-31"]["fiscal_year"], r["2024-03-31"]["fiscal_quarter"]) == (2024, 4)
    assert (r["2024-04-01"]["fiscal_year"], r["2024-04-01"]["fiscal_quarter"]) == (2025, 1)


def test_orders_without_items_keep_the_defaults(spark):
    from shopcube.operators.facts import price_orders
    from shopcube.plans.model import Model
    from tests.conftest import SF001
    m = Model(spark, SF001)
    priced = price_orders(m.orders, m.items)
    assert priced.count() == m.orders.count()
    none = priced.filter("line_count = 0")
    assert none.count() > 0
    assert none.filter("order_total_price <> 0 OR items_count <> 0 OR has_return OR buyer_paid_price IS NULL").count() == 0


def test_voucher_rules_without_an_amount_give_nothing(spark):
    from shopcube.operators.vouchers import entitled_discount
    df = spark.createDataFrame([("percentage", 10.0, None, 5.0), ("percentage", None, None, 5.0), ("shipping", None, None, None),
                                ("fixed_amount", None, 30.0, None), ("fixed_amount", None, None, 5.0)],
                               "t string, p double, f double, c double").selectExpr(
        "t", "cast(p as decimal(5,2)) p", "cast(f as decimal(10,2)) f", "cast(c as decimal(10,2)) c")
    got = df.select(entitled_discount(F.lit(100).cast("decimal(10,2)"), F.col("t"), F.col("p"), F.col("f"), F.col("c")))
    assert [r[0] if r[0] is None else float(r[0]) for r in got.collect()] == [5.0, None, None, 30.0, None]


def test_worked_price_example(spark):
    df = spark.createDataFrame([(Decimal("1000.00"), Decimal("50.00"), Decimal("30.00"),
                                 Decimal("45.00")),
                                (Decimal("1000.00"), None, None, None)],
                               "t decimal(10,2), s decimal(10,2), p decimal(10,2), f decimal(10,2)")
    out = df.select(voucher_total(F.col("s"), F.col("p")).alias("vt")) \
        .withColumn("x", F.lit(1)).collect()
    assert out[0]["vt"] == Decimal("80.00") and out[1]["vt"] == Decimal("0.00")
    bp = df.select(buyer_paid_price(F.col("t"), voucher_total(F.col("s"), F.col("p")), F.col("f"))
                   .alias("b")).collect()
    assert bp[0]["b"] == Decimal("965.00") and bp[1]["b"] == Decimal("1000.00")
