"""Fact builders: order pricing (F01-F04), Fact_Sales (F05), Fact_Orders.

Scale notes: the only large join is items x orders on order_key (unique on
the order side, <= a handful of lines per order), planned as a sort-merge
join on both sides' order_key; every aggregate below runs a map-side partial
aggregation before its shuffle, so a hot product/customer/day never lands
whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcube.functions.money import MONEY, PRICE, cents_to_money, msum, to_cents

# The natural key of a line: feeds may number two lines of an order alike.
LINE = ["order_key", "line_number", "product_key", "supplier_key"]


def _zero() -> F.Column:
    return F.lit(0).cast(PRICE)


def voucher_total(seller, platform) -> F.Column:
    """seller + platform voucher, each defaulting to 0."""
    return (F.coalesce(seller, _zero()) + F.coalesce(platform, _zero())).cast(PRICE)


def buyer_paid_price(total, vouchers, shipping) -> F.Column:
    """order_total_price - voucher_total + shipping_fee (fee defaults to 0)."""
    return (total - vouchers + F.coalesce(shipping, _zero())).cast(PRICE)


def order_rollup(items: DataFrame) -> DataFrame:
    """per-order totals from the items (partial aggregation before shuffle)."""
    disc = F.col("item_voucher_discount")
    return items.groupBy("order_key").agg(
        msum("total_item_price", PRICE).alias("order_total_price"),
        msum(F.when(F.col("voucher_side") == "seller", disc), PRICE).alias("voucher_seller"),
        msum(F.when(F.col("voucher_side") == "platform", disc), PRICE).alias("voucher_platform"),
        F.sum("quantity").cast("int").alias("items_count"),
        msum("tax_amount", MONEY).alias("tax_total"),
        F.max("is_returned").alias("has_return"),
        F.count(F.lit(1)).alias("line_count"),
    )


def price_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every order with the full price block; an order without items has the
    declared defaults (0 amounts and counts, nothing returned)."""
    r = order_rollup(items)
    vt = voucher_total(F.col("voucher_seller"), F.col("voucher_platform"))
    zero = F.lit(0)
    return (orders.join(r, "order_key", "left")
            .withColumns({
                "order_total_price": F.coalesce("order_total_price", zero).cast(PRICE),
                "items_count": F.coalesce("items_count", zero).cast("int"),
                "tax_total": F.coalesce("tax_total", zero).cast(MONEY),
                "has_return": F.coalesce("has_return", F.lit(False)),
                "line_count": F.coalesce("line_count", zero.cast("bigint"))})
            .withColumn("voucher_total", vt)
            .withColumn("buyer_paid_price",
                        buyer_paid_price(F.col("order_total_price"), F.col("voucher_total"),
                                         F.col("shipping_fee"))))


def first_order_keys(orders: DataFrame) -> DataFrame:
    """The first order of every customer, by (order_ts, order_key).

    A grouped minimum instead of a window: partial aggregation keeps a
    customer with millions of orders from landing in one task.  (time, key)
    is packed into one exact decimal so the aggregate stays hash-based.  The
    result is keyed by order_key, so joining it back is skew-free.
    """
    from shopcube.functions.keys import pack_time_key, unpack_key
    first = F.min(pack_time_key(F.col("order_ts"), F.col("order_key")))
    return (orders.groupBy("customer_key").agg(first.alias("f"))
            .select(unpack_key(F.col("f")).alias("order_key"),
                    F.lit(True).alias("is_first_order")))


def flag_first_orders(df: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Add ``is_first_order`` to an order-grain frame; the first order is taken
    over ``orders`` (the full order history), defaulting to ``df`` itself."""
    firsts = first_order_keys(orders if orders is not None else df)
    return (df.join(firsts, "order_key", "left")
            .withColumn("is_first_order", F.coalesce("is_first_order", F.lit(False))))


def fact_sales(items: DataFrame, orders: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Fact_Sales at line grain.

    Keys: time, customer, product, order, voucher (nullable).  Measures follow
    the DDL: gross (before discount), discount, net (after), shipping (kept at
    order grain, 0 here), tax, profit (NULL without a cost), unit price/cost.
    """
    o = orders.select("order_key", "customer_key", "time_key", "platform_key", "is_cancelled",
                      "order_ts", "order_date")
    f = items.join(o, "order_key", "inner")
    cols = [
        "time_key", "customer_key", "product_key", "order_key", "voucher_key", "platform_key",
        "order_ts", "order_date",
        F.col("quantity").alias("quantity_sold"),
        F.col("total_item_price").alias("gross_sales_amount"),
        F.col("item_voucher_discount").alias("discount_amount"),
        F.col("paid_price").alias("net_sales_amount"),
        _zero().alias("shipping_revenue"),
        "tax_amount",
        F.col("item_price").alias("unit_price"),
        F.col("is_cancelled"),
        F.col("is_returned"),
        F.col("voucher_key").isNotNull().alias("is_voucher_used"),
    ]
    if products is None:
        return f.select(*cols)
    cost = products.select("product_key", F.col("cost_price").alias("unit_cost"))
    f = f.join(cost, "product_key", "left")
    profit = (F.col("paid_price") - F.col("unit_cost") * F.col("quantity")).cast(MONEY)
    return f.select(*cols, F.col("unit_cost"), profit.alias("profit_amount"))


def allocate_shipping(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipping revenue of each line: the order's fee in exact cents, in proportion to the lines' gross.

    Line i of an order gets floor(fee * g(1..i) / g) - floor(fee * g(1..i-1) / g),
    so the lines add up to the fee.  An order whose lines are all worth
    nothing puts the fee on its first line; an order without fee has none (0).
    A window over the lines of one order is bounded by the order.
    """
    w = Window.partitionBy("order_key").orderBy(*LINE[1:]).rowsBetween(Window.unboundedPreceding, 0)
    first = Window.partitionBy("order_key").orderBy(*LINE[1:])
    whole = Window.partitionBy("order_key")
    fee = orders.select("order_key", to_cents(F.coalesce("shipping_fee", _zero())).alias("_fee"))
    g = items.select(*LINE, to_cents("total_item_price").alias("_g")).join(fee, "order_key")
    g = g.select("*", F.sum("_g").over(w).alias("_to"), F.sum("_g").over(whole).alias("_all"), F.row_number().over(first).alias("_i"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    upto = lambda part: F.floor((wide("_fee") * part).cast("decimal(38,0)") / wide("_all")).cast("bigint")
    share = F.when(F.col("_all") > 0, upto(wide("_to")) - upto((wide("_to") - wide("_g")).cast("decimal(19,0)"))) \
        .otherwise(F.when(F.col("_i") == 1, F.col("_fee")).otherwise(0))
    return g.select(*LINE, cents_to_money(share, PRICE).alias("shipping_revenue"))


def fact_orders(items: DataFrame, orders: DataFrame, commission_rate: str = "0.05") -> DataFrame:
    """Fact_Orders (line grain) with commission, subsidy and seller payout.

    commission = paid x rate; platform subsidy = the platform-side voucher of
    the line; payout = paid - commission.
    """
    from shopcube.functions.money import dec
    o = orders.select("order_key", "customer_key", "time_key", "platform_key",
                      "cancellation_reason")
    f = items.join(o, "order_key", "inner")
    commission = (F.col("paid_price") * dec(commission_rate)).cast(MONEY)
    subsidy = F.when(F.col("voucher_side") == "platform", F.col("item_voucher_discount"))
    return f.select(
        "order_key", "line_number", "time_key", "product_key", "customer_key", "platform_key",
        F.col("paid_price"),
        F.col("quantity").alias("item_quantity"),
        "cancellation_reason", "return_reason",
        commission.alias("seller_commission_fee"),
        subsidy.cast(MONEY).alias("platform_subsidy_amount"),
        (F.col("paid_price") - commission).cast(MONEY).alias("seller_payout"),
    )
