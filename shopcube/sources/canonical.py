"""Map the driver tables onto the canonical warehouse inputs.

The driver data is TPC-H shaped; this module is the one place that knows
that.  Everything downstream sees canonical columns only:

* ``order_items``  -- line grain (Order_Items): order_key, product_key,
  quantity, item_price, total_item_price (gross), discount, paid_price (net),
  tax, voucher side and key, return flag/reason.
* ``orders``       -- order grain header: order_key, customer_key, dates,
  status, platform, shipping fee, cancellation reason.
* ``products``, ``customers``, ``events`` -- dimension and traffic inputs.

Mapping rules (fixed, synthetic): cancelled = order status 'P'; returned =
return flag 'R'; voucher key = discount in percent (1..10); odd line numbers
carry the seller voucher, even ones the platform voucher; shipping fee 45.00
on '1-URGENT' orders, otherwise NULL; platform = order key parity + 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.functions.calendar import time_key
from shopcube.functions.money import (MONEY, PRICE, RATE, cents_from_double, cents_to_money,
                                      dec, half_up_div, money_from_double)
from shopcube.sources.tables import Tables

# Cancellation reasons by order priority, return reasons by
# line status.
CANCEL_REASONS = {
    "1-URGENT": "Delivery too slow",
    "2-HIGH": "Found cheaper elsewhere",
    "3-MEDIUM": "Changed mind",
    "4-NOT SPECIFIED": "Ordered by mistake",
    "5-LOW": "Payment failed",
}
RETURN_REASONS = {"F": "Damaged item", "O": "Not as described"}

SHIPPING_FEE = "45.00"


def _map_expr(c, mapping: dict):
    e = None
    for k, v in mapping.items():
        e = F.when(c == k, v) if e is None else e.when(c == k, v)
    return e


def order_items(t: Tables) -> DataFrame:
    """Order_Items at line grain with exact decimal pricing.

    Per-row money stays in long-backed arithmetic: amounts are read as
    integer cents, the unit price is a half-up integer division of cents by
    quantity, and decimals are formed with precisions that stay compact.
    """
    li = t.lineitem.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        cents_from_double("l_extendedprice").alias("_gc"),
        cents_to_money(cents_from_double("l_discount"), RATE).alias("_rate"),
        cents_to_money(cents_from_double("l_tax"), RATE).alias("_tax"),
        F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_shipdate"))
    gross = cents_to_money("_gc", MONEY)
    discount = (gross * F.col("_rate")).cast(MONEY)
    net = (gross - discount).cast(MONEY)
    returned = F.col("l_returnflag") == "R"
    return li.select(
        "order_key", "product_key", "supplier_key", "line_number", "quantity",
        cents_to_money(half_up_div("_gc", "quantity"), PRICE).alias("item_price"),
        gross.alias("total_item_price"),
        discount.alias("item_voucher_discount"),
        net.alias("paid_price"),
        (net * F.col("_tax")).cast(PRICE).alias("tax_amount"),
        F.when(F.col("_rate") > 0, (F.col("_rate") * dec("100")).cast("int")).alias("voucher_key"),
        F.when(F.col("line_number") % 2 == 1, "seller").otherwise("platform").alias("voucher_side"),
        returned.alias("is_returned"),
        F.when(returned, _map_expr(F.col("l_linestatus"), RETURN_REASONS)).alias("return_reason"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


def orders(t: Tables) -> DataFrame:
    """Order headers (no amounts: those are rolled up from the items)."""
    o = t.orders
    d = F.to_date("o_orderdate")
    cancelled = F.col("o_orderstatus") == "P"
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").alias("order_ts"),
        d.alias("order_date"),
        time_key(d).alias("time_key"),
        F.when(cancelled, "cancelled").when(F.col("o_orderstatus") == "F", "completed")
         .otherwise("open").alias("order_status"),
        cancelled.alias("is_cancelled"),
        F.col("o_orderpriority").alias("order_priority"),
        (F.col("o_orderkey") % 2 + 1).cast("int").alias("platform_key"),
        F.when(F.col("o_orderpriority") == "1-URGENT", dec(SHIPPING_FEE)).cast(PRICE)
         .alias("shipping_fee"),
        F.when(cancelled, _map_expr(F.col("o_orderpriority"), CANCEL_REASONS))
         .alias("cancellation_reason"),
    )


def products(t: Tables) -> DataFrame:
    """Product master: one row per part; cost 60% of list, unknown above size 45."""
    p = t.part
    price = money_from_double("p_retailprice", PRICE)
    return p.select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku_id"),
        F.col("p_name").alias("product_name"),
        F.concat_ws("-", F.col("p_brand"), F.col("p_partkey").cast("string")).alias("product_sku"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        price.alias("list_price"),
        F.when(F.col("p_size") <= 45, (price * dec("0.6")).cast(PRICE)).alias("cost_price"),
        F.col("p_name").alias("variation"),
        F.col("p_size").alias("stock_on_hand"),
    )


def customers(t: Tables) -> DataFrame:
    """Customer master with place names (nation -> city/country, region)."""
    c = t.customer
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    # nation (25) and region (5) are fixed-size reference tables
    place = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    name_parts = F.split(F.col("c_name"), "#")
    return (c.join(F.broadcast(place), c.c_nationkey == place.n_nationkey, "left")
             .select(
                 F.col("c_custkey").alias("customer_key"),
                 F.col("c_custkey").cast("string").alias("customer_id"),
                 name_parts.getItem(0).alias("first_name"),
                 F.try_element_at(name_parts, F.lit(2)).alias("last_name"),
                 F.col("c_name").alias("full_name_src"),
                 F.col("n_name").alias("city"),
                 F.col("r_name").alias("region"),
                 F.col("n_name").alias("country"),
                 F.col("c_mktsegment").alias("market_segment"),
                 (F.col("c_acctbal") > 0).alias("is_active"),
             ))


TRANSACTION_COLUMNS = ["transaction_id", "product_name", "quantity", "price", "customer_name",
                       "transaction_date", "source"]


def transactions(t: Tables, priced_orders: DataFrame, price_col: str = "buyer_paid_price"
                 ) -> DataFrame:
    """Standardised transactions (one per order) with the loader's 7 columns.

    product_name is the order's top line by gross (ties: lowest product key),
    chosen with a grouped max_by (partial aggregation, no window).
    """
    items = order_items(t)
    # max over (gross desc, product key asc) packed into one exact decimal:
    # cents * 10^18 + (10^18 - 1 - key) keeps the aggregate hash-based
    space = F.lit(10 ** 18).cast("decimal(38,0)")
    packed = ((F.col("total_item_price") * 100).cast("decimal(38,0)") * space
              + (space - 1 - F.col("product_key").cast("decimal(38,0)"))).cast("decimal(38,0)")
    top = (items.groupBy("order_key").agg(F.max(packed).alias("_p"))
           .select("order_key", (space - 1 - F.pmod(F.col("_p"), space)).cast("bigint")
                   .alias("product_key")))
    names = t.part.select(F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name"))
    cust = t.customer.select(F.col("c_custkey").alias("customer_key"),
                             F.col("c_name").alias("customer_name"))
    from shopcube.functions.calendar import PLATFORMS
    src = F.when(F.col("platform_key") == PLATFORMS[0][0], PLATFORMS[0][1]).otherwise(PLATFORMS[1][1])
    return (priced_orders.join(top, "order_key", "left")
            .join(names, "product_key", "left")
            .join(cust, "customer_key", "left")
            .select(F.col("order_key").cast("string").alias("transaction_id"),
                    "product_name",
                    F.col("items_count").cast("int").alias("quantity"),
                    F.col(price_col).cast(PRICE).alias("price"),
                    F.col("order_total_price").cast(PRICE).alias("list_price"),
                    "customer_name",
                    F.col("order_ts").alias("transaction_date"),
                    src.alias("source"),
                    "platform_key"))


def marketplace_feeds(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split standardised transactions into the two marketplace feeds as they
    arrive: the second feed has its own column order and no customer name."""
    a = tx.filter(F.col("platform_key") == 1).select(*TRANSACTION_COLUMNS)
    b = tx.filter(F.col("platform_key") == 2).select(
        "source", "transaction_date", "transaction_id", "price", "quantity", "product_name")
    return a, b
