"""Marts: daily Sales_Summary (G15-G19), cube and rollup (G20-G21), and their
materialisation with partition replacement (L09)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.functions.money import msum, safe_div
from shopcube.operators.facts import flag_first_orders


def sales_summary(priced_orders: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Sales_Summary per (day, platform_key).

    Order states partition the orders: cancelled, else returned (a returned
    line), else successful.  Money metrics cover live (non-cancelled)
    orders; counts cover all orders.  new_customers counts customers whose
    first-ever order is in the group (each customer has exactly one first
    order, so a plain conditional count is exact); returning = unique - new.
    """
    o = flag_first_orders(priced_orders, orders)
    live = F.col("is_cancelled") == F.lit(False)
    ret = F.col("has_return")
    vou = F.col("voucher_total") > 0
    g = o.groupBy("time_key", "order_date", "platform_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(live & ~ret).alias("successful_orders"),
        F.count_if(~live).alias("cancelled_orders"),
        F.count_if(live & ret).alias("returned_orders"),
        F.sum(F.when(live, F.col("items_count"))).alias("items"),
        msum(F.when(live, F.col("order_total_price"))).alias("gross"),
        msum(F.when(live, F.col("voucher_total"))).alias("disc"),
        msum(F.when(live, F.col("buyer_paid_price"))).alias("net"),
        msum(F.when(live, F.coalesce("shipping_fee", F.lit(0)))).alias("ship"),
        F.count_if(live).alias("live_orders"),
        F.countDistinct("customer_key").alias("unique_customers"),
        F.count_if(F.col("is_first_order")).alias("new_customers"),
        F.count_if(vou).alias("vouchers_used"),
        msum(F.when(vou, F.col("voucher_total"))).alias("vdisc"),
    )
    return g.select(
        "time_key", F.col("order_date").alias("date"), "platform_key",
        "total_orders", "successful_orders", "cancelled_orders", "returned_orders",
        F.coalesce(F.col("items").cast("bigint"), F.lit(0).cast("bigint")).alias("total_items_sold"),
        F.coalesce(F.col("gross").cast("double"), F.lit(0.0)).alias("gross_revenue"),
        F.coalesce(F.col("disc").cast("double"), F.lit(0.0)).alias("total_discounts"),
        F.coalesce(F.col("net").cast("double"), F.lit(0.0)).alias("net_revenue"),
        F.coalesce(F.col("ship").cast("double"), F.lit(0.0)).alias("shipping_revenue"),
        F.coalesce(safe_div("net", "live_orders"), F.lit(0.0)).alias("average_order_value"),
        "unique_customers", "new_customers",
        (F.col("unique_customers") - F.col("new_customers")).alias("returning_customers"),
        "vouchers_used",
        F.coalesce(F.col("vdisc").cast("double"), F.lit(0.0)).alias("voucher_discount_total"),
        safe_div(F.col("vouchers_used") * 100, "total_orders").alias("voucher_adoption_rate"),
    )


def sales_cube(fact: DataFrame, dims: list[str], measures: dict[str, str] | None = None,
               rollup: bool = False) -> DataFrame:
    """Cube (or hierarchical rollup) with grouping_id.

    The fact is first aggregated at the finest grain (all dims) -- partial
    aggregation, one shuffle -- and only those grouped rows are expanded
    into the 2^dims (or dims+1) grouping sets, so Expand never multiplies
    fact rows.  Valid because every measure is decomposable (sum, count).
    """
    measures = measures or {"quantity_sold": "total_quantity", "net_sales_amount": "net_sales"}
    base = fact.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.sum(c).alias(f"_{a}") for c, a in measures.items()])
    grouped = base.rollup(*dims) if rollup else base.cube(*dims)
    out = grouped.agg(F.grouping_id().alias("grouping_id"), F.sum("_n").alias("row_count"),
                      *[F.sum(f"_{a}").alias(f"_{a}") for a in measures.values()])
    return out.select(*dims, "grouping_id", "row_count",
                      *[F.col(f"_{a}").cast("double").alias(a) for a in measures.values()])


def write_mart(df: DataFrame, path: str, partition_cols=("year", "month")) -> None:
    """Materialise a mart partitioned by date parts, replacing only the
    partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .parquet(path))
