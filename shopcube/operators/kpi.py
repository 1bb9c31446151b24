"""Daily-KPI feed: cleaning (B01-B07, A07), ratios (K01-K05), period roll-up
(K06) and period/day reconciliation (K07).

Input: a frame of raw *string* cells under the feed's header names, plus
``platform`` and ``source_file`` (see :mod:`shopcube.sources.kpi_csv`).
Output of :func:`clean_kpi_feed`: three frames -- day rows, period rows and
quarantined raw rows -- all lazy, split by filters on one parsed frame.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 18 header names of the daily-KPI export, in file order,
# with canonical names and types (date, total_sales_value and total_orders are
# the names downstream code relies on).  Amounts and counts are as wide as a
# feed of any size needs.
COLUMNS = [
    ("Date", "date", "date"),
    ("Revenue", "total_sales_value", "decimal(28,2)"),
    ("Visitors", "visitors", "bigint"),
    ("Buyers", "buyers", "bigint"),
    ("Orders", "total_orders", "bigint"),
    ("Pageviews", "pageviews", "bigint"),
    ("Units Sold", "units_sold", "bigint"),
    ("Conversion Rate", "conversion_rate", "percent"),
    ("Revenue per Buyer", "revenue_per_buyer", "decimal(28,2)"),
    ("Visitor Value", "visitor_value", "decimal(28,2)"),
    ("Add to Cart Users", "add_to_cart_users", "bigint"),
    ("Add to Cart Units", "add_to_cart_units", "bigint"),
    ("Wishlists", "wishlists", "bigint"),
    ("Wishlist Users", "wishlist_users", "bigint"),
    ("Average Order Value", "average_order_value", "decimal(28,2)"),
    ("Average Basket Size", "average_basket_size", "decimal(28,2)"),
    ("Cancelled Amount", "cancelled_amount", "decimal(28,2)"),
    ("Return/Refund Amount", "return_refund_amount", "decimal(28,2)"),
]
HEADER = [h for h, _, _ in COLUMNS]
ADDITIVE = ["total_sales_value", "total_orders", "pageviews", "units_sold", "add_to_cart_units",
            "wishlists", "cancelled_amount", "return_refund_amount"]
PEOPLE = ["visitors", "buyers", "add_to_cart_users", "wishlist_users"]
RATIOS = ["conversion_rate", "revenue_per_buyer", "visitor_value", "average_order_value",
          "average_basket_size"]
MEASURES = [c for _, c, t in COLUMNS if t != "date"]

# Per-marketplace layout (A02): the file's columns in order, each with the
# header it stands for.  The first marketplace's export names its columns as
# above; the second one's layout is an own choice (other names and order).
LAYOUTS = {
    "lazada": {h: h for h in HEADER},
    "shopee": {f"Shop {h}" if h != "Date" else "Day": h for h in [HEADER[0], *reversed(HEADER[1:])]},
}
PLATFORM_HEADERS = {k: list(v) for k, v in LAYOUTS.items()}


def to_canonical(raw: DataFrame, platform: str) -> DataFrame:
    """The cells of a marketplace's file under the common header names."""
    layout = LAYOUTS[platform.strip().lower()]
    return raw.select(*[F.col(f"`{c}`").alias(layout.get(c, c)) for c in raw.columns])


class CleanFeed(NamedTuple):
    daily: DataFrame
    period: DataFrame
    quarantine: DataFrame


def _cell(name: str) -> Column:
    """Trimmed cell, '-' and '' -> NULL."""
    c = F.trim(F.col(f"`{name}`"))
    return F.when((c == "-") | (c == ""), None).otherwise(c)


def _parse(cell: Column, kind: str) -> Column:
    """Failure-tolerant typed value (NULL when unparsable)."""
    if kind == "percent":
        num = F.regexp_replace(cell, "%$", "").try_cast("decimal(18,4)")
        return (num / 100).cast("decimal(18,4)")
    if kind == "bigint":
        # exports write counts as '12' or '12.0'
        return cell.try_cast("decimal(28,4)").try_cast("bigint")
    return cell.try_cast(kind)


def parse_day(cell: Column) -> Column:
    """ISO first, then day-first; never month-first."""
    return F.coalesce(F.try_to_date(cell, "yyyy-MM-dd"),
                      F.try_to_date(cell, "dd/MM/yyyy"))


def clean_kpi_feed(raw: DataFrame) -> CleanFeed:
    date_cell = _cell("Date")
    is_dash_row = F.lit(True)
    for h in HEADER:
        is_dash_row = is_dash_row & _cell(h).isNull()
    is_period = F.coalesce(date_cell.contains("~"), F.lit(False))
    parts = F.split(date_cell, "~")
    start = parse_day(F.trim(parts.getItem(0)))
    end = parse_day(F.trim(F.try_element_at(parts, F.lit(2))))
    day = parse_day(date_cell)

    # typed values under a private prefix: Spark resolves names case-insensitively,
    # so 'visitors' would collide with the raw 'Visitors' cell
    typed = [(_parse(_cell(h), kind).alias(f"_v_{name}"), _cell(h).isNotNull()
              & _parse(_cell(h), kind).isNull())
             for h, name, kind in COLUMNS if kind != "date"]
    bad_cell = F.lit(False)
    for _, bad in typed:
        bad_cell = bad_cell | bad
    corrupt = (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns
               else F.lit(False))

    # a corrupt row may have only empty cells: it is no dash row
    state = (F.when(corrupt, "malformed_row")
             .when(is_dash_row, "dash")
             .when(bad_cell, "bad_number")
             .when(is_period & start.isNotNull() & end.isNotNull() & (start <= end), "period")
             .when(is_period, "bad_period")
             .when(day.isNotNull(), "day")
             .otherwise("bad_date"))
    parsed = raw.select("*", state.alias("_state"), day.alias("_day"), start.alias("_start"),
                        end.alias("_end"), *[t for t, _ in typed])
    keys = ["platform", "source_file"]
    # A day outside the period of its own file is no day of it -- the only
    # guard against a swapped day and month.  One row per file.
    span = (parsed.filter(F.col("_state") == "period").groupBy(*keys)
            .agg(F.min("_start").alias("_from"), F.max("_end").alias("_to")))
    parsed = parsed.join(span, keys, "left").withColumn("_state", F.when(
        (F.col("_state") == "day") & ~F.col("_day").between(F.col("_from"), F.col("_to")),
        "out_of_period").otherwise(F.col("_state")))
    measures = [F.col(f"_v_{m}").alias(m) for m in MEASURES]
    daily = (parsed.filter(F.col("_state") == "day")
             .select(*keys, F.col("_day").alias("date"), *measures))
    period = (parsed.filter(F.col("_state") == "period")
              .select(*keys, F.col("_start").alias("period_start"),
                      F.col("_end").alias("period_end"), *measures))
    quarantine = (parsed.filter(~F.col("_state").isin("day", "period", "dash"))
                  .select(*keys, F.col("_state").alias("reason"),
                          *[F.col(f"`{h}`") for h in HEADER]))
    return CleanFeed(daily, period, quarantine)


# --------------------------------------------------------------------------
# Ratios (K01-K05) and roll-ups
# --------------------------------------------------------------------------

def _ratio(num: Column, den: Column, scale: int) -> Column:
    """num / den rounded half-up to ``scale`` decimals; NULL when den is 0/NULL."""
    d = F.nullif(den.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(num.cast("decimal(28,2)") / d, scale)


def kpi_ratios(df: DataFrame) -> DataFrame:
    """Recompute the five ratio columns from the count/amount columns."""
    rev = F.col("total_sales_value")
    return df.withColumns({
        "conversion_rate": (_ratio(F.col("buyers") * 100, F.col("visitors"), 2) / 100)
        .cast("decimal(18,4)"),
        "revenue_per_buyer": _ratio(rev, F.col("buyers"), 2).cast("decimal(28,2)"),
        "visitor_value": _ratio(rev, F.col("visitors"), 2).cast("decimal(28,2)"),
        "average_order_value": _ratio(rev, F.col("total_orders"), 2).cast("decimal(28,2)"),
        "average_basket_size": _ratio(F.col("units_sold"), F.col("total_orders"), 2)
        .cast("decimal(28,2)"),
    })


def rollup_kpis(daily: DataFrame, grain: str = "month") -> DataFrame:
    """Period totals from day rows.  Additive columns are summed; ratios
    that only need additive inputs are recomputed from the sums; people
    columns (distinct visitors/buyers) cannot be re-aggregated and the
    ratios built on them are left out."""
    g = daily.groupBy("platform", F.trunc("date", grain).alias("period_start")).agg(
        F.max("date").alias("last_day"), F.count(F.lit(1)).alias("days"),
        *[F.sum(c).alias(c) for c in ADDITIVE])
    rev = F.col("total_sales_value")
    return g.select(
        "platform", "period_start", "last_day", "days",
        *[F.col(c).cast("bigint").alias(c) if c in ("total_orders", "pageviews", "units_sold",
                                                     "add_to_cart_units", "wishlists")
          else F.col(c) for c in ADDITIVE],
        _ratio(rev, F.col("total_orders"), 2).cast("decimal(28,2)").alias("average_order_value"),
        _ratio(F.col("units_sold"), F.col("total_orders"), 2).cast("decimal(28,2)")
        .alias("average_basket_size"))


def people_ratios(rollup: DataFrame, people: DataFrame) -> DataFrame:
    """Period totals (:func:`rollup_kpis`) with the people columns of the same platform and period, and the
    ratios built on them.  A period without people has none (null ratios); zero wishlist users are none."""
    both = rollup.join(people, ["platform", "period_start"], "left")
    rev = F.col("total_sales_value")
    return both.select(
        "platform", "period_start", "total_sales_value", "total_orders", "visitors", "buyers", "add_to_cart_users",
        F.nullif("wishlist_users", F.lit(0)).alias("wishlist_users"),
        (_ratio(F.col("buyers") * 100, F.col("visitors"), 2) / 100).cast("decimal(18,4)").alias("conversion_rate"),
        _ratio(rev, F.col("buyers"), 2).cast("decimal(28,2)").alias("revenue_per_buyer"),
        _ratio(rev, F.col("visitors"), 2).cast("decimal(28,2)").alias("visitor_value"))


def reconcile_kpis(daily: DataFrame, period: DataFrame) -> DataFrame:
    """Period row minus the sum of its day rows, per additive column.

    Day rows are summed per (platform, source file, day) first, then joined
    to the period rows of the same file on the date range; a file holds one
    export, so the equi key bounds every join group by the period length.
    """
    keys = ["platform", "source_file"]
    # equal period rows of a file are one row; several rows of a day are summed first
    p = period.select(*keys, "period_start", "period_end",
                      *[F.col(c).alias(f"p_{c}") for c in ADDITIVE]).distinct()
    days = (daily.groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys], "date")
            .agg(*[F.sum(c).alias(c) for c in ADDITIVE]))
    cond = [p[k] == days[f"_d_{k}"] for k in keys] + [
        days["date"].between(p["period_start"], p["period_end"])]
    j = p.join(days, cond, "left")
    pcols = [f"p_{c}" for c in ADDITIVE]
    g = j.groupBy(*keys, "period_start", "period_end", *pcols).agg(
        F.count("date").alias("days"), *[F.sum(c).alias(f"d_{c}") for c in ADDITIVE])
    diffs = [(F.col(f"p_{c}") - F.coalesce(F.col(f"d_{c}"), F.lit(0))).alias(f"diff_{c}")
             for c in ADDITIVE]
    ok = F.lit(True)
    for c in ADDITIVE:
        same = F.col(f"p_{c}") == F.coalesce(F.col(f"d_{c}"), F.lit(0))
        ok = ok & F.coalesce(same, F.lit(True))
    return g.select(*keys, "period_start", "period_end", "days", *diffs, ok.alias("reconciled"))
