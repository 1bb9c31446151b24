"""Cross-query invariants (SURVEY §5 (3)) on the driver tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001

Q = E.queries()


def one(df):
    return df.first()


def test_cube_grand_total_equals_plain_aggregate(spark):
    cube = Q["sales_cube"](spark, SF001)
    total = one(cube.filter(F.col("grouping_id") == 7))
    fact = Q["fact_sales"](spark, SF001)
    plain = one(fact.agg(F.count("*").alias("n"), F.sum("quantity_sold").alias("q")))
    assert total["row_count"] == plain["n"] and total["total_quantity"] == plain["q"]


def test_rollup_levels_add_up(spark):
    r = Q["time_rollup"](spark, SF001)
    by_gid = {row["grouping_id"]: row["row_count"] for row in
              r.groupBy("grouping_id").agg(F.sum("row_count").alias("row_count")).collect()}
    assert len(set(by_gid.values())) == 1      # every level covers every line once


def test_summary_totals_equal_order_totals(spark):
    s = Q["sales_summary"](spark, SF001)
    n = Q["net_revenue"](spark, SF001)
    tot = one(s.agg(F.sum("total_orders").alias("o"), F.sum("net_revenue").alias("r"),
                    F.sum("new_customers").alias("new")))
    net = one(n.agg(F.sum("net_revenue").alias("r")))
    priced = Q["order_pricing"](spark, SF001)
    assert tot["o"] == priced.count()
    assert abs(tot["r"] - net["r"]) < 1e-6 * max(1.0, net["r"])
    # every customer's first order is counted as new exactly once (if it has lines)
    assert tot["new"] <= spark.read.parquet(f"{SF001}/customer.parquet").count()


def test_order_states_partition_total_orders(spark):
    s = Q["sales_summary"](spark, SF001)
    bad = s.filter(F.col("successful_orders") + F.col("cancelled_orders") + F.col("returned_orders")
                   != F.col("total_orders")).count()
    assert bad == 0
    bad = s.filter(F.col("unique_customers") != F.col("new_customers") + F.col("returning_customers")
                   ).count()
    assert bad == 0


def test_kpi_periods_reconcile(spark):
    r = Q["kpi_reconcile"](spark, SF001)
    assert r.count() > 0 and r.filter(~F.col("reconciled")).count() == 0


def test_upsert_is_order_independent(spark):
    from shopcube.operators.load import upsert
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    s1 = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    s2 = spark.createDataFrame([("c", 30), ("b", 20)], "k string, v int").repartition(3)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(upsert(t, s1, "k").merged) == key(upsert(t, s2, "k").merged)


def test_product_view_totals_equal_live_fact(spark):
    p = Q["product_performance"](spark, SF001)
    f = Q["fact_sales"](spark, SF001).filter(~F.col("is_cancelled"))
    a = one(p.agg(F.sum("total_quantity_sold").alias("q")))
    b = one(f.agg(F.sum("quantity_sold").alias("q")))
    assert a["q"] == b["q"]
