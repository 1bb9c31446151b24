"""Calendar attribute expressions (Dim_Time columns) over a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marketplace names and regions of the platform dimension
# (1 and 2 as fixed by the source schema comment; region code PH).
PLATFORMS = [(1, "Lazada", "PH"), (2, "Shopee", "PH")]

# Recurring public holidays used when no holiday table is given,
# as (month, day): New Year's Day, Independence Day, Christmas Day, Rizal Day.
DEFAULT_HOLIDAYS = [(1, 1), (6, 12), (12, 25), (12, 30)]


def time_key(d) -> Column:
    """YYYYMMDD integer key, computed arithmetically (stays in codegen)."""
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(d: Column) -> Column:
    """ISO day of week: Monday = 1 ... Sunday = 7."""
    return (F.weekday(d) + 1).cast("int")


def season(month: Column) -> Column:
    """Meteorological season of the northern hemisphere."""
    return (F.when(month.isin(12, 1, 2), "Winter")
            .when(month.isin(3, 4, 5), "Spring")
            .when(month.isin(6, 7, 8), "Summer")
            .otherwise("Fall"))


def fiscal_year(d: Column, fiscal_start: int = 1) -> Column:
    """Fiscal year named after the calendar year in which it ends."""
    if fiscal_start == 1:
        return F.year(d)
    return (F.year(d) + F.when(F.month(d) >= fiscal_start, 1).otherwise(0)).cast("int")


def fiscal_quarter(d: Column, fiscal_start: int = 1) -> Column:
    return (F.floor(((F.month(d) - fiscal_start + 12) % 12) / 3) + 1).cast("int")


def is_mega_sale_day(d: Column, months=None) -> Column:
    """Double-date sale days (11.11, 12.12, ...): month number equals day number."""
    same = F.month(d) == F.dayofmonth(d)
    if months:
        same = same & F.month(d).isin(*months)
    return same


def is_recurring_holiday(d: Column, holidays=DEFAULT_HOLIDAYS) -> Column:
    md = F.month(d) * 100 + F.dayofmonth(d)
    return md.isin(*[m * 100 + dd for m, dd in holidays])


def calendar_columns(d: Column, fiscal_start: int = 1) -> list[Column]:
    """All Dim_Time attribute columns for date column ``d`` (except holiday)."""
    dow = day_of_week(d)
    return [
        time_key(d).alias("time_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (dow >= 6).alias("is_weekend"),
        is_mega_sale_day(d).alias("is_mega_sale_day"),
        fiscal_year(d, fiscal_start).alias("fiscal_year"),
        fiscal_quarter(d, fiscal_start).alias("fiscal_quarter"),
        season(F.month(d)).alias("season"),
    ]
