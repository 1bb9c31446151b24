"""Remaining analytical operators: voucher-product rules (F08), voucher
status (D20), usage pattern (G24), reason totals (G27), cohort retention
(G25), inventory turnover (G26), discount rate (K09), product identity
across marketplaces (D22, J09), headline totals (G28), display formatting
(B13) and the upload result envelope (B12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopcube.functions.money import safe_div


def voucher_products(vouchers: DataFrame, products: DataFrame) -> DataFrame:
    """one row per (voucher, product) from the voucher's JSON lists of
    categories and of product ids (sku_id); a product that both lists name is
    one row.  Malformed or empty lists contribute nothing; duplicates collapse."""
    cols = ["voucher_key", "voucher_id", "discount_value", "discount_percentage"]
    lists = [("category", "applicable_categories")] + [
        ("sku_id", "applicable_products")] * ("applicable_products" in vouchers.columns)
    # the listed names are the bounded side, de-duplicated before the join;
    # a product has one category and one id, so each list gives a pair once
    p = products.select("product_key", "sku_id", "category")
    pairs = [p.join(vouchers.select(*cols, F.explode(F.from_json(text, "array<string>")).alias(name))
                    .dropDuplicates(["voucher_key", name]), name)
             .select("voucher_key", "product_key", "voucher_id", "sku_id", "discount_value", "discount_percentage")
             for name, text in lists]
    return pairs[0] if len(pairs) == 1 else pairs[0].unionByName(pairs[1]).dropDuplicates(["voucher_key", "product_key"])


def voucher_status(as_of: Column, start: Column, end: Column) -> Column:
    """D20."""
    return F.when(as_of > end, "Expired").when(as_of < start, "Inactive").otherwise("Active")


def acquisition_cost(usage: DataFrame) -> DataFrame:
    """Discount a voucher has given per customer it has won (first order with the voucher)."""
    return (usage.groupBy("voucher_key", "voucher_code")
            .agg(F.sum("discount_amount").alias("_d"), F.count_if("first_time_customer").alias("new_customers"))
            .select("voucher_key", "voucher_code", F.col("_d").cast("double").alias("discount_total"),
                    "new_customers", safe_div("_d", "new_customers").alias("acquisition_cost")))


def usage_pattern(usage: DataFrame) -> DataFrame:
    """Uses per hour of day and ISO weekday."""
    return (usage.groupBy(F.hour("usage_date").alias("hour"),
                          (F.weekday("usage_date") + 1).alias("day_of_week"))
            .agg(F.count(F.lit(1)).alias("uses"),
                 F.sum("discount_amount").cast("double").alias("discount_total")))


def reason_totals(fact_orders: DataFrame) -> DataFrame:
    """Lines and paid amount per cancellation reason and per return reason."""
    both = F.array(*[F.struct(F.lit(kind).alias("reason_type"), F.col(c).alias("reason"))
                     for kind, c in (("cancellation", "cancellation_reason"), ("return", "return_reason"))])
    lines = fact_orders.select("paid_price", F.inline(both)).filter(F.col("reason").isNotNull())
    return lines.groupBy("reason_type", "reason").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("paid_price").cast("double").alias("amount"))


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers per first-order month (cohort) active k months later."""
    m = orders.select("customer_key", F.trunc("order_date", "month").alias("month")).distinct()
    first = m.groupBy("customer_key").agg(F.min("month").alias("cohort"))
    j = m.join(first, "customer_key")
    return (j.groupBy("cohort", F.months_between("month", "cohort").cast("int")
                      .alias("months_since"))
            .agg(F.count(F.lit(1)).alias("customers")))


def inventory_turnover(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Units sold (live lines) / stock on hand, per product."""
    sold = (fact.filter(F.col("is_cancelled") == F.lit(False))
            .groupBy("product_key").agg(F.sum("quantity_sold").alias("units_sold")))
    p = products.select("product_key", "stock_on_hand")
    return (p.join(sold, "product_key", "left")
            .select("product_key", "stock_on_hand",
                    F.coalesce("units_sold", F.lit(0)).cast("bigint").alias("units_sold"),
                    safe_div(F.coalesce("units_sold", F.lit(0)), "stock_on_hand")
                    .alias("turnover")))


def discount_rate(fact: DataFrame) -> DataFrame:
    """Discounts / gross per year and platform (live lines)."""
    live = fact.filter(F.col("is_cancelled") == F.lit(False))
    return (live.groupBy((F.col("time_key") / 10000).cast("int").alias("year"), "platform_key")
            .agg(F.sum("discount_amount").alias("d"), F.sum("gross_sales_amount").alias("g"))
            .select("year", "platform_key", F.col("d").cast("double").alias("total_discounts"),
                    F.col("g").cast("double").alias("gross_sales"),
                    safe_div("d", "g").alias("discount_rate")))


def product_identity(fact: DataFrame, products: DataFrame) -> DataFrame:
    """One universal product row per product sold anywhere, with a
    marketplace id where it sold there: one grouped pass over the sales."""
    on = lambda p, mark: F.max(F.when(F.col("platform_key") == p, F.concat(
        F.lit(mark), F.col("product_key").cast("string"))))
    ids = (fact.groupBy("product_key").agg(on(1, "L-").alias("lazada_item_id"), on(2, "S-").alias("shopee_item_id"))
           .where("lazada_item_id IS NOT NULL OR shopee_item_id IS NOT NULL"))
    return (ids.join(products.select("product_key", "product_name", "category"), "product_key", "left")
            .select("product_key", "lazada_item_id", "shopee_item_id", "product_name",
                    F.col("category").alias("category_l2")))


def display_value(x: Column) -> Column:
    """NULL -> 'N/A'; whole numbers with thousands separators; other
    numbers with 4 decimals (no separators).  ``x`` is an exact decimal."""
    whole = x == F.floor(x)
    return F.coalesce(F.when(whole, F.format_number(x, 0))
                      .otherwise(F.round(x, 4).cast("decimal(38,4)").cast("string")),
                      F.lit("N/A"))


def headline_totals(model) -> DataFrame:
    """Row counts of the main tables and total revenue, one row; the
    other tables' counts enter as scalar subqueries."""
    from shopcube.operators.traffic import fact_activity
    o = model.priced_orders.agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("line_count") > 0).alias("orders_with_lines"),
        F.sum(F.when(F.col("is_cancelled") == F.lit(False), F.col("buyer_paid_price")))
        .cast("double").alias("net_revenue"))
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return o.select("*", count(model.items).alias("order_items"),
                    count(model.customers).alias("customers"),
                    count(model.products).alias("products"),
                    count(model.dim_time).alias("calendar_days"),
                    count(model.vouchers).alias("vouchers"),
                    count(fact_activity(model.t.events)).alias("activities"))
