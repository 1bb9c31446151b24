"""A daily-KPI export derived from the order data, in the marketplace's text
layout: one "file" per platform and month with a period row (``a~b``), an
all-dash row on the second platform, and one row per day -- day-first dates
on platform 1, ISO dates on platform 2, percents as ``'9.47%'``, zero counts
of the wishlist columns and undefined ratios written as ``'-'``.

It feeds the same cleaning operator as uploaded CSVs, so the cleaning is
exercised at the volume of the order data rather than on two sample files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.operators.dims import with_platform_name
from shopcube.functions.money import WIDE, msum
from shopcube.operators.kpi import HEADER


def _customer_sums():
    """Per-customer partial sums and flags (level 1 of the two-level plan)."""
    live = F.col("is_cancelled") == F.lit(False)
    ret = F.col("has_return")
    return [
        msum(F.when(live, F.col("buyer_paid_price"))).alias("rev"),
        F.count_if(live).alias("orders"),
        F.sum("line_count").alias("pageviews"),
        F.sum(F.when(live, F.col("items_count"))).alias("units"),
        F.sum("items_count").alias("atc_units"),
        F.count_if(ret).alias("wishlists"),
        msum(F.when(~live, F.col("order_total_price"))).alias("cancelled"),
        msum(F.when(live & ret, F.col("buyer_paid_price"))).alias("refunds"),
        F.max(live).alias("is_buyer"),
        F.max(F.col("voucher_total") > 0).alias("is_atc"),
        F.max(ret).alias("is_wish"),
    ]


SUMS = ["rev", "orders", "pageviews", "units", "atc_units", "wishlists", "cancelled", "refunds"]
FLAGS = ["is_buyer", "is_atc", "is_wish"]


def _regroup(df: DataFrame, keys: list) -> DataFrame:
    """Re-aggregate per-customer rows at a coarser customer grain."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS],
                                 *[F.max(c).alias(c) for c in FLAGS])


def _people(df: DataFrame, keys: list) -> DataFrame:
    """Level 2: one row per customer per group, so distinct people are plain
    counts -- no Expand of the order rows, partial aggregation throughout."""
    zero = F.lit(0).cast(WIDE)
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum("rev"), zero).alias("rev"),
        F.count(F.lit(1)).alias("visitors"),
        F.count_if("is_buyer").alias("buyers"),
        F.sum("orders").alias("orders"),
        F.sum("pageviews").alias("pageviews"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"),
        F.count_if("is_atc").alias("atc_users"),
        F.sum("atc_units").alias("atc_units"),
        F.sum("wishlists").alias("wishlists"),
        F.count_if("is_wish").alias("wishlist_users"),
        F.coalesce(F.sum("cancelled"), zero).alias("cancelled"),
        F.coalesce(F.sum("refunds"), zero).alias("refunds"))


def _half_up(num, den, scale=2):
    d = F.nullif(den.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(num.cast(WIDE) / d, scale)


def _text_cells(date_text) -> list:
    s = lambda c: c.cast("string")
    dash = lambda c: F.coalesce(s(c), F.lit("-"))
    pct = _half_up(F.col("buyers") * 100, F.col("visitors"))
    cells = [
        date_text,
        s(F.col("rev").cast(WIDE)),
        s(F.col("visitors")), s(F.col("buyers")), s(F.col("orders")), s(F.col("pageviews")),
        s(F.col("units")),
        F.coalesce(F.concat(s(pct), F.lit("%")), F.lit("-")),
        dash(_half_up(F.col("rev"), F.col("buyers"))),
        dash(_half_up(F.col("rev"), F.col("visitors"))),
        s(F.col("atc_users")), s(F.col("atc_units")),
        dash(F.nullif(F.col("wishlists"), F.lit(0))),
        dash(F.nullif(F.col("wishlist_users"), F.lit(0))),
        dash(_half_up(F.col("rev"), F.col("orders"))),
        dash(_half_up(F.col("units"), F.col("orders"))),
        s(F.col("cancelled").cast(WIDE)),
        s(F.col("refunds").cast(WIDE)),
    ]
    return [c.alias(h) for c, h in zip(cells, HEADER)]


def kpi_feed_text(priced_orders: DataFrame) -> DataFrame:
    """Raw text rows (18 string cells + platform + source_file)."""
    spark = priced_orders.sparkSession
    o = with_platform_name(priced_orders, spark).withColumn(
        "month", F.trunc("order_date", "month"))
    file_ = F.concat_ws("-", F.lower("platform"), F.date_format("month", "yyyy-MM"))
    per_day = o.groupBy("platform", "platform_key", "month", "order_date", "customer_key") \
        .agg(*_customer_sums())
    days = _people(per_day, ["platform", "platform_key", "month", "order_date"])
    day_text = F.when(F.col("platform_key") == 1, F.date_format("order_date", "dd/MM/yyyy")) \
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
    day_rows = days.select("platform", file_.alias("source_file"), *_text_cells(day_text))
    per_month = _regroup(per_day, ["platform", "platform_key", "month", "customer_key"])
    months = _people(per_month, ["platform", "platform_key", "month"])
    period_text = F.concat(F.date_format("month", "yyyy-MM-dd"), F.lit("~"),
                           F.date_format(F.last_day("month"), "yyyy-MM-dd"))
    period_rows = months.select("platform", file_.alias("source_file"), *_text_cells(period_text))
    dash_rows = (months.filter(F.col("platform_key") == 2)
                 .select("platform", file_.alias("source_file"),
                         *[F.lit("-").alias(h) for h in HEADER]))
    rows = (period_rows.unionByName(dash_rows).unionByName(day_rows)
            .withColumn("_corrupt_record", F.lit(None).cast("string")))
    return rows.unionByName(_damaged(months.select("platform", "month", file_.alias("source_file")), rows.columns))


def _damaged(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows no export should hold, by a fixed rule on the month of the file:
    a short row in every file, and an amount, a date, a period or a day of
    another month that is wrong in every file of a quarter's first, second,
    third month or of December."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    n = F.month("month")
    bad = F.array(
        F.struct(F.lit(True).alias("short"), F.lit(None).cast("string").alias("day"), F.lit(None).cast("string").alias("rev")),
        *[F.when(rule, F.struct(F.lit(False).alias("short"), day.alias("day"), F.lit(rev).alias("rev")))
          for rule, day, rev in (
              (n % 3 == 1, iso(F.col("month")), "abc"),
              (n % 3 == 2, F.concat(F.lit("31/31/"), F.year("month")), "1.00"),
              (n % 3 == 0, F.concat(iso(F.last_day("month")), F.lit("~"), iso(F.col("month"))), "1.00"),
              (n == 12, iso(F.add_months("month", 1)), "1.00"))])
    f = files.select("platform", "source_file", F.inline(F.array_compact(bad)))
    cells = {"Date": F.col("day"), "Revenue": F.col("rev"),
             "_corrupt_record": F.when(F.col("short"), F.lit("a,short,row"))}
    return f.select(*[F.col(c) if c in ("platform", "source_file")
                      else cells.get(c, F.lit(None).cast("string")).cast("string").alias(c) for c in columns])
