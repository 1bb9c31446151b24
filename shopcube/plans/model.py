"""The canonical warehouse over one directory of driver tables.

Properties are lazy DataFrames; building one costs a plan, not a job.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcube.operators import dims, facts, marts
from shopcube.sources import canonical
from shopcube.sources.tables import Tables


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)

    # canonical inputs -----------------------------------------------------
    @cached_property
    def items(self) -> DataFrame:
        return canonical.order_items(self.t)

    @cached_property
    def orders(self) -> DataFrame:
        return canonical.orders(self.t)

    @cached_property
    def products(self) -> DataFrame:
        return canonical.products(self.t)

    @cached_property
    def customers(self) -> DataFrame:
        return canonical.customers(self.t)

    # derived --------------------------------------------------------------
    @cached_property
    def priced_orders(self) -> DataFrame:
        return facts.price_orders(self.orders, self.items)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_sales(self.items, self.orders)

    @cached_property
    def as_of(self):
        """Reporting date: the latest order date, as a scalar subquery."""
        return self.orders.agg(F.max("order_date")).scalar()

    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.dim_time_for(self.orders, "order_date")

    @cached_property
    def vouchers(self) -> DataFrame:
        return dims.vouchers_from_levels(self.items)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.build_dim_customers(self.customers, self.priced_orders, self.as_of)

    @cached_property
    def summary(self) -> DataFrame:
        return dims.with_platform_name(marts.sales_summary(self.priced_orders, self.orders), self.spark)

    @cached_property
    def usage(self) -> DataFrame:
        from shopcube.operators import vouchers
        return vouchers.voucher_usage(self.items, self.orders)

    @cached_property
    def kpi(self):
        """Cleaned KPI feed (daily, period, quarantine) from the derived export."""
        from shopcube.operators.dims import checkpointed
        from shopcube.operators.kpi import clean_kpi_feed
        from shopcube.sources.kpi_feed import kpi_feed_text
        # the export is one row per platform-day: small and bounded by the
        # calendar; writing it once lets day, period and quarantine rows be
        # cleaned from the file instead of re-aggregating the orders per branch
        return clean_kpi_feed(checkpointed(kpi_feed_text(self.priced_orders)))

    def transactions(self, price_col: str = "buyer_paid_price") -> DataFrame:
        return canonical.transactions(self.t, self.priced_orders, price_col)
