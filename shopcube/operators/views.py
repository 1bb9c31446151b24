"""The four analytical views (G10-G12, O02) and the formula outputs.

Each view aggregates the fact side *before* joining the dimension: the
dimension keys are unique, so the result is identical to join-then-group,
but only one row per key crosses the join instead of every fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.functions.money import avg_d, msum, safe_div, sum_d


def product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """G10 v_product_performance: non-cancelled lines (NULL flag excluded) per product."""
    per_product = (fact.filter(F.col("is_cancelled") == F.lit(False))
                   .groupBy("product_key")
                   .agg(F.countDistinct("order_key").alias("orders_count"),
                        F.sum("quantity_sold").alias("qty"),
                        msum("gross_sales_amount").alias("gross"),
                        msum("discount_amount").alias("disc"),
                        msum("net_sales_amount").alias("net"),
                        msum("unit_price").alias("sum_price"),
                        F.count("unit_price").alias("n_price")))
    p = products.select("product_key", "product_name", "product_sku", "category")
    return (per_product.join(p, "product_key", "inner")
            .select("product_name", "product_sku", "category", "orders_count",
                    F.col("qty").cast("bigint").alias("total_quantity_sold"),
                    F.col("gross").cast("double").alias("gross_sales"),
                    F.col("disc").cast("double").alias("total_discounts"),
                    F.col("net").cast("double").alias("net_sales"),
                    safe_div("sum_price", "n_price").alias("avg_selling_price"),
                    safe_div("net", "qty").alias("revenue_per_unit")))


def voucher_effectiveness(vouchers: DataFrame, usage: DataFrame) -> DataFrame:
    """G11 v_voucher_effectiveness: every voucher, used or not (left join)."""
    per_voucher = (usage.groupBy("voucher_key")
                   .agg(F.count("usage_key").alias("total_usage"),
                        F.countDistinct("customer_key").alias("unique_customers"),
                        msum("discount_amount").alias("disc"),
                        F.count("discount_amount").alias("n_disc"),
                        msum("order_value_after_discount").alias("after"),
                        F.count(F.when(F.col("first_time_customer"), 1))
                        .alias("new_customer_acquisitions")))
    v = vouchers.select("voucher_key", "voucher_code", "voucher_name", "voucher_type",
                        "start_date", "end_date")
    # the voucher dimension is small and bounded (one row per voucher)
    return (v.join(per_voucher, "voucher_key", "left")
            .select("voucher_code", "voucher_name", "voucher_type", "start_date", "end_date",
                    F.coalesce("total_usage", F.lit(0)).alias("total_usage"),
                    F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
                    F.col("disc").cast("double").alias("total_discount_given"),
                    safe_div("disc", "n_disc").alias("avg_discount_per_use"),
                    F.col("after").cast("double").alias("total_order_value_generated"),
                    F.coalesce("new_customer_acquisitions", F.lit(0))
                    .alias("new_customer_acquisitions"),
                    (F.col("after") - F.col("disc")).cast("double").alias("net_revenue_generated")))


def voucher_roi(vouchers: DataFrame, usage: DataFrame) -> DataFrame:
    """(order value generated - discount given) / discount given per voucher."""
    per_voucher = (usage.groupBy("voucher_key")
                   .agg(msum("order_value_after_discount").alias("after"),
                        msum("discount_amount").alias("disc")))
    return (vouchers.select("voucher_key", "voucher_code")
            .join(per_voucher, "voucher_key", "left")
            .select("voucher_key", "voucher_code",
                    F.col("after").cast("double").alias("total_order_value_generated"),
                    F.col("disc").cast("double").alias("total_discount_given"),
                    safe_div(F.col("after") - F.col("disc"), F.col("disc")).alias("effectiveness")))


def customer_segments(dim_customers: DataFrame) -> DataFrame:
    """G12 v_customer_segments over active customers only (NULL is_active excluded)."""
    c = dim_customers.filter(F.col("is_active") == F.lit(True))
    life = F.datediff("last_order_date", "first_order_date")
    return (c.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 safe_div(F.sum("total_orders"), F.count("total_orders"))
                 .alias("avg_orders_per_customer"),
                 avg_d("average_order_value").alias("avg_order_value"),
                 avg_d("total_spent").alias("avg_customer_lifetime_value"),
                 sum_d("total_spent").alias("segment_total_revenue"),
                 safe_div(F.sum(life), F.count(life)).alias("avg_customer_lifespan_days")))


TREND_COLUMNS = ["year", "quarter", "month_name", "week", "day_name", "is_weekend",
                 "total_orders", "net_revenue", "average_order_value", "unique_customers",
                 "voucher_adoption_rate"]


def sales_trends(dim_time: DataFrame, summary: DataFrame, keyed: bool = False) -> DataFrame:
    """O02 v_sales_trends: calendar x daily summary, ordered by time_key.

    As written the view has no date or platform column; ``keyed=True`` adds
    time_key and platform so rows are distinguishable.
    """
    t = dim_time.select("time_key", "year", "quarter", "month_name", "week", "day_name",
                        "is_weekend")
    # the calendar is bounded by its date range (days), never by fact volume
    j = summary.join(F.broadcast(t), "time_key", "inner")
    cols = (["time_key", "platform"] if keyed else []) + TREND_COLUMNS
    return j.orderBy("time_key", "platform").select(*cols)


def net_revenue(priced_orders: DataFrame) -> DataFrame:
    """Net Revenue = SUM(buyer_paid_price), per platform and overall."""
    live = priced_orders.filter(F.col("is_cancelled") == F.lit(False))
    return (live.groupBy("platform_key")
            .agg(sum_d("buyer_paid_price").alias("net_revenue"),
                 F.count(F.lit(1)).alias("orders")))
