"""Voucher operators: usage (F07), voucher-product rules (F08), eligibility
(F09, J07), discount caps (F10), usage limits (F11), usage pattern (G24).

Whether the voucher side of a join is broadcast is left to its size at run
time; the fact side never is.  Voucher keys are hot by nature (few vouchers, many uses): every
aggregate keyed by voucher is a partial + final aggregation, and distinct
counts shuffle on (voucher, customer), which spreads a hot voucher.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.functions.money import PRICE, msum
from shopcube.operators.facts import first_order_keys
from shopcube.operators.intervals import count_in_windows

VOUCHER_SPACE = 1 << 31  # voucher keys are ints


def voucher_usage(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Voucher_Usage: one row per (voucher, order) that used a voucher.

    usage_key is unique for any order and voucher key (voucher keys are
    below 2**31); discount = sum of the voucher's line discounts, value before = gross of
    those lines, after = net; first_time_customer = the order is the
    customer's first order.
    """
    used = items.filter(F.col("voucher_key").isNotNull())
    per_order = (used.groupBy("voucher_key", "order_key")
                 .agg(msum("item_voucher_discount", PRICE).alias("discount_amount"),
                      msum("total_item_price", PRICE).alias("order_value_before_discount"),
                      msum("paid_price", PRICE).alias("order_value_after_discount")))
    o = (orders.select("order_key", "customer_key", "time_key", "order_ts")
         .join(first_order_keys(orders), "order_key", "left"))
    return (per_order.join(o, "order_key", "inner")
            .select((F.col("order_key").cast("decimal(19,0)") * VOUCHER_SPACE + F.col("voucher_key"))
                    .cast("decimal(29,0)").alias("usage_key"),
                    "voucher_key", "order_key", "customer_key", "time_key",
                    F.format_string("SAVE%02d", "voucher_key").alias("voucher_code"),
                    "discount_amount", "order_value_before_discount",
                    "order_value_after_discount",
                    F.col("order_ts").alias("usage_date"),
                    F.coalesce("is_first_order", F.lit(False)).alias("first_time_customer")))


def voucher_eligibility(vouchers: DataFrame, priced_orders: DataFrame,
                        usage: DataFrame) -> DataFrame:
    """Per voucher, how many live orders were eligible (inside the
    window, spend >= minimum) and how many actual uses were valid.

    Orders are counted in the windows by ``count_in_windows``: each order is
    read once, however many vouchers cover it.
    """
    live = priced_orders.filter(F.col("is_cancelled") == F.lit(False)).select("order_ts", "order_total_price")
    elig = (count_in_windows(live, "order_ts", "order_total_price", vouchers, "voucher_key", "start_date",
                             "end_date", "minimum_spend")
            .withColumnRenamed("points", "eligible_orders"))
    vu = usage.join(vouchers.select("voucher_key", "start_date", "end_date", "minimum_spend"), "voucher_key")
    in_window = F.col("usage_date").between(F.col("start_date"), F.col("end_date"))
    spend_ok = F.col("order_value_before_discount") >= F.col("minimum_spend")
    uses = vu.groupBy("voucher_key").agg(
        F.count(F.lit(1)).alias("uses"),
        F.count_if(in_window & spend_ok).alias("valid_uses"),
        F.count_if(~in_window).alias("outside_window"),
        F.count_if(in_window & ~spend_ok).alias("below_minimum"))
    return (vouchers.select("voucher_key", "voucher_code")
            .join(elig, "voucher_key", "left").join(uses, "voucher_key", "left")
            .select("voucher_key", "voucher_code",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in
                      ["eligible_orders", "uses", "valid_uses", "outside_window",
                       "below_minimum"]]))


def audience_eligibility(vouchers: DataFrame, priced_orders: DataFrame) -> DataFrame:
    """F09 with the voucher's target audience: per voucher, the live orders in
    its window that reach its minimum and whose customer belongs to it.

    'all' takes every order, 'new_customers' a customer's first order, 'vip'
    orders of customers who are VIP by the orders of earlier days; a voucher
    with another or no audience has none.  Each order is read once for each
    audience it belongs to, however many vouchers cover it.
    """
    from shopcube.operators.dims import stored
    from shopcube.operators.facts import flag_first_orders
    from shopcube.operators.history import segment_at_usage
    o = priced_orders.select("customer_key", "order_key", "order_ts", "order_total_price", "is_cancelled")
    o = segment_at_usage(flag_first_orders(o, priced_orders), priced_orders, at="order_ts")
    live = stored(o.where(F.col("is_cancelled") == F.lit(False)))
    member = {"all": F.lit(True), "new_customers": F.col("is_first_order"), "vip": F.col("customer_segment_at_usage") == "VIP"}
    found = None
    for audience, belongs in member.items():
        n = count_in_windows(live.where(belongs), "order_ts", "order_total_price",
                             vouchers.where(F.col("target_audience") == audience), "voucher_key", "start_date", "end_date", "minimum_spend")
        found = n if found is None else found.unionByName(n)
    return (vouchers.select("voucher_key", "target_audience").join(found, "voucher_key", "left")
            .select("voucher_key", "target_audience", F.coalesce("points", F.lit(0)).cast("bigint").alias("eligible_orders")))


def entitled_discount(value_before, vtype, pct, fixed, cap) -> F.Column:
    """percentage of the order value or a fixed amount, capped by the
    voucher's maximum discount; never more than the order value.  A rule
    without its amount (and a shipping voucher, which has none) gives NULL:
    ``least`` would skip the NULL and give the cap or the whole order away."""
    raw = rule_amount(value_before, vtype, pct, fixed)
    return F.when(raw.isNotNull(), F.least(raw, F.coalesce(cap, raw), value_before)).cast(PRICE)


def rule_amount(value_before, vtype, pct, fixed) -> F.Column:
    """The discount of the rule itself, before cap and order value."""
    return (F.when(vtype == "percentage", (value_before * pct / 100).cast(PRICE))
            .when(vtype == "fixed_amount", fixed))


def voucher_discounts(vouchers: DataFrame, usage: DataFrame) -> DataFrame:
    """F10 per voucher: entitled discount before and after the cap."""
    v = vouchers.select("voucher_key", "voucher_type", "discount_percentage", "discount_value",
                        "maximum_discount")
    u = usage.join(v, "voucher_key")
    before = F.col("order_value_before_discount")
    raw = rule_amount(before, F.col("voucher_type"), F.col("discount_percentage"), F.col("discount_value"))
    capped = entitled_discount(before, F.col("voucher_type"), F.col("discount_percentage"),
                               F.col("discount_value"), F.col("maximum_discount"))
    return (u.groupBy("voucher_key")
            .agg(F.count(F.lit(1)).alias("uses"),
                 F.sum(raw).cast("double").alias("uncapped_discount"),
                 F.sum(capped).cast("double").alias("entitled_discount"),
                 F.count_if(raw > F.col("maximum_discount")).alias("capped_uses"),
                 F.sum("discount_amount").cast("double").alias("applied_discount")))


def voucher_limits(vouchers: DataFrame, usage: DataFrame) -> DataFrame:
    """usage limits, first come first served, every use kept and flagged.

    A use is accepted when it is among the customer's first
    ``usage_limit_per_customer`` uses of the voucher and, among the uses
    that pass that test, among the voucher's first ``usage_limit``.  Both
    ranks come from :func:`running_aggregates`, so a voucher (or customer)
    holding a third of all uses is spread over many tasks.
    """
    from shopcube.operators.sequence import group_rank
    v = vouchers.select("voucher_key", "usage_limit", "usage_limit_per_customer")
    u = usage.select("voucher_key", "customer_key", "order_key", "usage_date").join(v, "voucher_key")
    order = ["usage_date", "order_key"]
    per_cust = group_rank(u, ["voucher_key", "customer_key"], order, "customer_rank")
    per_cust = per_cust.withColumn(
        "within_customer_limit",
        F.col("customer_rank") <= F.coalesce("usage_limit_per_customer", F.col("customer_rank")))
    ok = per_cust.filter("within_customer_limit")
    ranked = group_rank(ok, ["voucher_key"], order, "voucher_rank")
    flagged = (per_cust.filter(~F.col("within_customer_limit"))
               .withColumn("voucher_rank", F.lit(None).cast("bigint"))
               .unionByName(ranked))
    accepted = F.col("within_customer_limit") & (
        F.col("voucher_rank") <= F.coalesce("usage_limit", F.col("voucher_rank")))
    return flagged.withColumn("accepted", accepted)
