"""Dimension builders: calendar, platform, customers, products, vouchers, keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopcube.functions.calendar import (DEFAULT_HOLIDAYS, PLATFORMS, calendar_columns,
                                         is_recurring_holiday)
from shopcube.functions.money import PRICE, TOTAL, dec, msum, safe_div


# --------------------------------------------------------------------------
# Calendar (D01-D05)
# --------------------------------------------------------------------------

def build_dim_time(spark: SparkSession, start, end, fiscal_start: int = 1,
                   holidays: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end] with all calendar attributes.

    ``start``/``end`` are dates or DATE columns of a one-row frame (see
    :func:`dim_time_for`).  ``holidays`` is an optional frame with a DATE
    column ``date``; without it recurring fixed holidays are flagged.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return _calendar(days, fiscal_start, holidays)


def dim_time_for(dates: DataFrame, date_col: str = "order_date", fiscal_start: int = 1,
                 holidays: DataFrame | None = None, whole_years: bool = True) -> DataFrame:
    """Calendar covering the date range present in ``dates`` (derived, not fixed).

    Only the two-value min/max crosses to the sequence generator; the
    calendar itself is bounded by the number of days in the range.
    """
    rng = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    if whole_years:
        rng = rng.select(F.trunc("lo", "year").alias("lo"),
                         F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("hi"))
    days = rng.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return _calendar(days, fiscal_start, holidays)


def _calendar(days: DataFrame, fiscal_start: int, holidays: DataFrame | None) -> DataFrame:
    cal = days.select(*calendar_columns(F.col("d"), fiscal_start))
    if holidays is None:
        cal = cal.withColumn("is_holiday", is_recurring_holiday(F.col("date"), DEFAULT_HOLIDAYS))
    else:
        h = holidays.select(F.col("date").cast("date").alias("date"),
                            F.lit(True).alias("is_holiday")).dropDuplicates(["date"])
        # holiday lists are bounded by the calendar they annotate
        cal = (cal.join(F.broadcast(h), "date", "left")
               .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False))))
    return cal.select("time_key", "date", "year", "quarter", "month", "month_name", "week",
                      "day_of_month", "day_of_week", "day_name", "is_weekend", "is_holiday",
                      "is_mega_sale_day", "fiscal_year", "fiscal_quarter", "season")


# --------------------------------------------------------------------------
# Platform (D07)
# --------------------------------------------------------------------------

def dim_platform(spark: SparkSession) -> DataFrame:
    schema = "platform_key int, platform_name string, platform_region string"
    return spark.createDataFrame(PLATFORMS, schema)


def with_platform_name(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Attach platform_name via a broadcast of the 2-row platform dimension."""
    p = dim_platform(spark).select("platform_key", F.col("platform_name").alias("platform"))
    return df.join(F.broadcast(p), "platform_key", "left")


# --------------------------------------------------------------------------
# Customers
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class SegmentRules:
    """Thresholds (the source names the classes but gives no numbers).

    Tested in order: Inactive, New, VIP, Regular.
    """
    inactive_days: int = 365
    new_max_orders: int = 1
    vip_min_spent: str = "3000000"
    gold_min_spent: str = "2300000"
    silver_min_spent: str = "1650000"
    mask_salt: str = "shopcube"


def customer_rollup(priced_orders: DataFrame) -> DataFrame:
    """Per-customer order count, spend (buyer paid price) and first/last
    order over the customer's whole order history (orders with lines,
    cancelled ones included: they are part of the buying history the
    segment thresholds were calibrated on)."""
    return (priced_orders.groupBy("customer_key")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 msum("buyer_paid_price").alias("spent"),
                 F.min("order_date").alias("first_order_date"),
                 F.max("order_date").alias("last_order_date")))


def segment_expr(total_orders, total_spent, recency_days, rules: SegmentRules) -> F.Column:
    """D09 customer_segment."""
    return (F.when(recency_days > rules.inactive_days, "Inactive")
            .when(total_orders <= rules.new_max_orders, "New")
            .when(total_spent >= dec(rules.vip_min_spent), "VIP")
            .otherwise("Regular"))


def ltv_tier_expr(total_spent, rules: SegmentRules) -> F.Column:
    """D11 LTV_tier."""
    return (F.when(total_spent >= dec(rules.gold_min_spent), "Gold")
            .when(total_spent >= dec(rules.silver_min_spent), "Silver")
            .otherwise("Bronze"))


def build_dim_customers(customers: DataFrame, priced_orders: DataFrame, as_of,
                        rules: SegmentRules = SegmentRules()) -> DataFrame:
    """Dim_Customers plus the schema-B attributes (buyer_segment, ltv_tier, RFM)."""
    r = customer_rollup(priced_orders)
    c = customers.join(r, "customer_key", "left")
    orders_ = F.coalesce("total_orders", F.lit(0)).cast("int")
    spent = F.coalesce(F.col("spent"), F.lit(0)).cast(TOTAL)
    as_of_c = as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("date")
    recency = F.datediff(as_of_c, F.col("last_order_date"))
    return c.select(
        "customer_key", "customer_id", "first_name", "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "city", "region", "country",
        orders_.alias("total_orders"),
        spent.alias("total_spent"),
        F.coalesce(F.round(F.col("spent") / F.col("total_orders").cast("decimal(10,0)"), 2),
                   F.lit(0)).cast(PRICE).alias("average_order_value"),
        "first_order_date", "last_order_date",
        segment_expr(orders_, spent, recency, rules).alias("customer_segment"),
        spent.alias("customer_lifetime_value"),
        F.when(orders_ <= 1, "New Buyer").otherwise("Returning Buyer").alias("buyer_segment"),
        ltv_tier_expr(spent, rules).alias("ltv_tier"),
        recency.alias("recency_days"),
        F.sha2(F.concat(F.lit(rules.mask_salt), F.col("customer_id")), 256)
         .alias("platform_buyer_id"),
        F.when(F.col("region").isNull(), None)
         .when(F.col("region") == "ASIA", "Metro").otherwise("Provincial").alias("region_class"),
        "is_active",
    )


# --------------------------------------------------------------------------
# Products (D17-D21, K08)
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class InventoryRules:
    active_days: int = 180
    inactive_days: int = 730


def product_rollup(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Sales totals, first/last sold and the price of the latest sale.
    The fact carries the order time, so no second join with the orders."""
    live = fact.filter(F.col("is_cancelled") == F.lit(False))
    if "order_ts" not in fact.columns:
        live = live.join(orders.select("order_key", "order_ts", "order_date"), "order_key")
    return (live.groupBy("product_key")
            .agg(F.sum("quantity_sold").alias("qty"),
                 msum("net_sales_amount").alias("amount"),
                 F.min("order_date").alias("first_sold_date"),
                 F.max("order_date").alias("last_sold_date"),
                 # total order on (ts, order, price) so ties resolve identically everywhere
                 F.max(F.struct("order_ts", "order_key", "unit_price")).alias("latest")))


def inventory_status_expr(days_since, rules: InventoryRules) -> F.Column:
    return (F.when(days_since.isNull() | (days_since > rules.inactive_days), "Discontinued")
            .when(days_since > rules.active_days, "Inactive")
            .otherwise("Active"))


def build_dim_products(products: DataFrame, fact: DataFrame, orders: DataFrame, as_of,
                       rules: InventoryRules = InventoryRules()) -> DataFrame:
    r = product_rollup(fact, orders)
    as_of_c = as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("date")
    p = products.join(r, "product_key", "left")
    last_price = F.coalesce(F.col("latest.unit_price"), F.col("list_price"))
    margin = safe_div((last_price - F.col("cost_price")) * 100, last_price)
    return p.select(
        "product_key", "sku_id", "product_name", "product_sku", "category", "brand",
        last_price.cast(PRICE).alias("last_price"),
        "cost_price",
        margin.alias("margin_percentage"),
        *variation_columns(F.col("variation")),
        F.coalesce("qty", F.lit(0)).cast("bigint").alias("total_sales_quantity"),
        F.coalesce("amount", F.lit(0)).cast(TOTAL).alias("total_sales_amount"),
        F.round(F.col("amount") / F.col("qty").cast("decimal(12,0)"), 2).cast(PRICE)
         .alias("average_selling_price"),
        "first_sold_date", "last_sold_date",
        inventory_status_expr(F.datediff(as_of_c, F.col("last_sold_date")), rules)
         .alias("inventory_status"),
        "stock_on_hand",
    )


# Colour words recognised in variation / product-name text.
COLOURS = ["red", "blue", "green", "black", "white", "yellow", "pink", "purple", "orange",
           "brown", "grey", "gray", "silver", "gold"]
# Size words recognised in variation text.
SIZES = ["small", "medium", "large", "xs", "s", "m", "l", "xl", "xxl"]


def variation_columns(v: F.Column) -> list[F.Column]:
    """Colour family and size from variation text such as
    'Color:red;Size:M', or the first colour / size word of free text."""
    low = F.lower(v)
    kv_colour = F.nullif(F.regexp_extract(low, r"colou?r\s*[:=]\s*([a-z]+)", 1), F.lit(""))
    kv_size = F.nullif(F.regexp_extract(low, r"size\s*[:=]\s*([a-z0-9]+)", 1), F.lit(""))
    words = F.split(low, r"[^a-z0-9]+")
    colour_word = F.try_element_at(F.filter(words, lambda w: w.isin(*COLOURS)), F.lit(1))
    size_word = F.try_element_at(F.filter(words, lambda w: w.isin(*SIZES)), F.lit(1))
    return [F.coalesce(kv_colour, colour_word).alias("color_family"),
            F.coalesce(kv_size, size_word).alias("size")]


# --------------------------------------------------------------------------
# Vouchers (derived master for the driver data; A04 reads real landed JSON)
# --------------------------------------------------------------------------

def vouchers_from_levels(items: DataFrame) -> DataFrame:
    """Dim_Vouchers: one voucher per discount level seen, plus one never used.

    The number of vouchers is bounded by the discount domain (whole percents,
    at most 101), independent of data volume.  Rule columns (fixed synthetic
    rules): minimum spend 10000 v, cap 500 v, window from 1 January of
    1994 + (v-1) div 2 to 31 December two years later, odd v fixed amount
    (100 v), even v percentage (v %).
    """
    top = items.agg(F.max("voucher_key").alias("hi"))
    v = top.select(F.explode(F.sequence(F.lit(1), F.col("hi") + 1)).alias("voucher_key"))
    vk = F.col("voucher_key")
    start_year = (F.lit(1994) + F.floor((vk - 1) / 2)).cast("int")
    fixed = vk % 2 == 1
    cats = F.when(vk % 3 == 0, F.lit('["PROMO", "STANDARD"]')).when(vk % 3 == 1, F.lit("[]"))\
        .otherwise(F.lit('["ECONOMY", "LARGE", "MEDIUM", "SMALL"]'))
    return v.select(
        vk.cast("int").alias("voucher_key"),
        F.format_string("V%03d", vk).alias("voucher_id"),
        F.format_string("SAVE%02d", vk).alias("voucher_code"),
        F.when(fixed, F.format_string("PHP %d off", vk * 100))
         .otherwise(F.format_string("%d%% off", vk)).alias("voucher_name"),
        F.when(fixed, "fixed_amount").otherwise("percentage").alias("voucher_type"),
        F.when(vk % 2 == 1, "seller").otherwise("platform").alias("discount_type"),
        F.when(fixed, (vk * 100).cast(PRICE)).alias("discount_value"),
        F.when(~fixed, vk.cast("decimal(5,2)")).alias("discount_percentage"),
        (vk * 10000).cast(PRICE).alias("minimum_spend"),
        (vk * 500).cast(PRICE).alias("maximum_discount"),
        (vk * 300).cast("int").alias("usage_limit"),
        F.lit(3).alias("usage_limit_per_customer"),
        F.make_timestamp_ntz(start_year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
         .alias("start_date"),
        F.make_timestamp_ntz(start_year + 2, F.lit(12), F.lit(31), F.lit(23), F.lit(59),
                             F.lit(59)).alias("end_date"),
        F.when(vk % 4 == 0, "new_customers").when(vk % 4 == 2, "vip").otherwise("all")
         .alias("target_audience"),
        cats.alias("applicable_categories"),
        F.when(vk == 7, F.lit("[not json")).otherwise(F.lit(None).cast("string"))
         .alias("applicable_products"),
    )


def voucher_status_expr(as_of, start, end) -> F.Column:
    """Expired after the window, Inactive before it, Active inside."""
    return (F.when(as_of > end, "Expired").when(as_of < start, "Inactive").otherwise("Active"))


# --------------------------------------------------------------------------
# Surrogate keys
# --------------------------------------------------------------------------

def assign_surrogate_keys(new_keys: DataFrame, key_col: str, existing: DataFrame | None = None,
                          sk_col: str = "sk", num_partitions: int | None = None, distinct: bool = False) -> DataFrame:
    """Dense, stable surrogate keys for business keys, without a global window.

    Keys already in ``existing`` (key_col, sk_col) keep their value; new keys
    get max(existing)+1.. in business-key order.  Plan: range-partition and
    sort the new keys, take the in-partition position from
    ``monotonically_increasing_id`` (partition id in the high bits, no
    shuffle), checkpoint so both passes see identical partitions, then add
    per-partition offsets computed from the partition counts (one row per
    partition: bounded by the partition count, safe to broadcast).
    ``distinct``: the caller knows that no key comes twice.
    """
    spark = new_keys.sparkSession
    nk = new_keys.select(key_col).filter(F.col(key_col).isNotNull())
    nk = nk if distinct else nk.dropDuplicates([key_col])
    base = F.lit(0).cast("bigint")
    if existing is not None:
        nk = nk.join(existing.select(key_col), key_col, "left_anti")
        base = existing.agg(F.coalesce(F.max(sk_col), F.lit(0)).cast("bigint")).scalar()
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    ranged = (nk.repartitionByRange(n, key_col).sortWithinPartitions(key_col)
              .select(key_col, F.shiftright(mid, 33).alias("_pid"),
                      mid.bitwiseAND(F.lit(LOW_BITS)).alias("_pos")))
    ranged = stored(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_c").over(Window.orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"))
    keyed = (ranged.join(F.broadcast(offsets), "_pid")
             .select(key_col, (base + F.col("_off") + F.col("_pos") + 1).cast("bigint").alias(sk_col)))
    if existing is not None:
        keyed = existing.select(key_col, F.col(sk_col).cast("bigint")).unionByName(keyed)
    return keyed


LOW_BITS = (1 << 33) - 1


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``."""
    from shopcube.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: lineage ends here.

    A pass over it reads only the columns it uses, and a row takes a fraction
    of its size in a checkpoint; order and partitions are not kept.
    """
    from shopcube.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
