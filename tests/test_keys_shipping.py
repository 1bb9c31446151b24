"""Stored key maps over loads, shipping fees on lines, voucher lists, usage keys."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from shopcube.operators.analytics import voucher_products
from shopcube.operators.facts import allocate_shipping
from shopcube.operators.keymap import extend_map, with_keys


def test_keys_stay_over_loads_and_reruns(spark, tmp_path):
    path = f"{tmp_path}/map"
    one = spark.createDataFrame([(2, "b"), (1, "a"), (1, "a"), (None, "x"), (9, None)], "n int, s string")
    first = {(r.n, r.s): r.sk for r in extend_map(one, ["n", "s"], path, "1").collect()}
    assert first == {(1, "a"): 1, (2, "b"): 2}
    two = one.unionByName(spark.createDataFrame([(0, "z"), (1, "b"), (1, "b")], "n int, s string"))
    second = {(r.n, r.s): r.sk for r in extend_map(two, ["n", "s"], path, "2").collect()}
    assert second == {**first, (0, "z"): 3, (1, "b"): 4}
    for load in ("1", "2"):
        assert {(r.n, r.s): r.sk for r in extend_map(two, ["n", "s"], path, load).collect()} == second
    out = with_keys(two, extend_map(two.where("false"), ["n", "s"], path, "3"), ["n", "s"], "key").collect()
    assert len(out) == 8 and {(r.n, r.s): r.key for r in out} == {**second, (None, "x"): None, (9, None): None}


def test_shipping_adds_up_to_the_fee(spark):
    r = random.Random(4)
    lines, fees = [], {}
    for k in range(200):
        fees[k] = r.choice([None, Decimal("45.00"), Decimal("0.01"), Decimal("99999.99"), Decimal(0)])
        lines += [(k, r.randrange(1, 3), r.randrange(3), j, r.choice([Decimal(0), Decimal(r.randrange(10 ** 9)) / 100])) for j in range(r.randrange(1, 9))]
    items = spark.createDataFrame(lines, "order_key long, line_number int, product_key long, supplier_key long, total_item_price decimal(12,2)")
    orders = spark.createDataFrame(list(fees.items()), "order_key long, shipping_fee decimal(10,2)")
    out = allocate_shipping(items, orders)
    got = {x.order_key: x.s for x in out.groupBy("order_key").agg(F.sum("shipping_revenue").alias("s")).collect()}
    assert got == {k: fees[k] or 0 for k in {x[0] for x in lines}} and out.count() == len(lines)
    assert out.where("shipping_revenue < 0").count() == 0


def test_product_and_category_lists(spark):
    products = spark.createDataFrame([(1, "SKU-1", "A"), (2, "SKU-2", "A"), (3, "SKU-3", "B"), (4, "SKU-4", None)],
                                     "product_key long, sku_id string, category string")
    rows = [(1, '["A"]', '["SKU-3", "SKU-3", "SKU-1"]'), (2, None, '["SKU-4", "none"]'), (3, "[broken", "{}"), (4, "[]", None), (5, '["B","B"]', "[1")]
    vouchers = spark.createDataFrame([(k, f"V{k}", 1.0, None, c, p) for k, c, p in rows],
                                     "voucher_key int, voucher_id string, discount_value double, discount_percentage double, "
                                     "applicable_categories string, applicable_products string")
    got = sorted((x.voucher_key, x.product_key) for x in voucher_products(vouchers, products).collect())
    assert got == [(1, 1), (1, 2), (1, 3), (2, 4), (5, 3)]
    assert sorted((x.voucher_key, x.product_key) for x in voucher_products(vouchers.drop("applicable_products"), products).collect()) == [
        (1, 1), (1, 2), (5, 3)]


def test_lines_are_joined_once_for_all_loads(spark, monkeypatch):
    from shopcube.plans import registry
    from tests.conftest import SF001
    seen = []
    monkeypatch.setattr(registry, "_stored_keys", lambda spark, rows, *rest: seen.append(rows) or rows)
    registry.q_fact_sales_keys(spark, SF001)
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()
