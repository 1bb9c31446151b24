"""The daily summary kept up to date by change sets.

A change set is a table of priced orders with ``sign``: +1 for a row that is
there now, -1 for one that no longer is (a changed order is both).  Every
additive column of the summary is a signed sum; distinct customers are the
positive counts of a (day, platform, customer) table, which can be added up
and taken back as well; new customers are the changes of the stored index of
first orders (``history.load_first_orders``).  All three tables are
partitioned by month: a load reads and replaces the months of its change set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcube.functions.money import safe_div, to_cents
from shopcube.operators.history import FIRST, load_first_orders
from shopcube.operators.load import table_exists

DAY = ["order_date", "platform_key"]


def summary_deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of the additive columns (amounts in cents) per day and platform."""
    live, ret = F.col("is_cancelled") == F.lit(False), F.col("has_return")
    vou = F.coalesce(F.col("voucher_total") > 0, F.lit(False))
    one = F.col("sign").cast("bigint")
    flag = lambda cond: F.sum(F.when(cond, one).otherwise(0))
    cents = lambda cond, c: F.sum(F.when(cond, one * to_cents(F.coalesce(F.col(c), F.lit(0).cast("decimal(10,2)")))).otherwise(0))
    return changes.groupBy(*DAY).agg(
        F.sum(one).alias("total_orders"), flag(live & ~ret).alias("successful_orders"), flag(~live).alias("cancelled_orders"),
        flag(live & ret).alias("returned_orders"), F.sum(F.when(live, one * F.col("items_count")).otherwise(0)).alias("items"),
        cents(live, "order_total_price").alias("gross"), cents(live, "voucher_total").alias("disc"),
        cents(live, "buyer_paid_price").alias("net"), cents(live, "shipping_fee").alias("ship"), flag(live).alias("live_orders"),
        flag(vou).alias("vouchers_used"), cents(vou, "voucher_total").alias("vdisc"))


def customer_deltas(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*DAY, "customer_key").agg(F.sum(F.col("sign").cast("bigint")).alias("orders"))


def _month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("order_date", "yyyy-MM"))


def add_deltas(deltas: DataFrame, root: str, key: list[str]) -> None:
    """Add ``deltas`` to the stored table: the months they touch are read, summed up and replaced.

    Rows that come to 0 stay as such (readers leave them out), so a month that
    loses its last order is replaced like any other.
    """
    from shopcube.session import scratch_path
    spark, cols = deltas.sparkSession, [c for c in deltas.columns if c not in key]
    deltas = _month(deltas)
    both = deltas
    if table_exists(spark, root):
        months = [r[0] for r in deltas.select("month").distinct().collect()]          # months of the change set
        both = spark.read.parquet(root).where(F.col("month").isin(months)).select(deltas.columns).unionByName(deltas)
    total = both.groupBy(*key, "month").agg(*[F.sum(c).alias(c) for c in cols])
    staged = scratch_path(spark, "mart")
    total.write.parquet(staged)
    (spark.read.schema(total.schema).parquet(staged).repartition("month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(root))


def load_changes(changes: DataFrame, root: str) -> None:
    """Apply a change set to the tables under ``root``; an empty one changes nothing.

    Orders with sign +1 and no -1 enter the index of first orders; an order
    that is taken back for good must not have been its customer's first.
    """
    if changes.limit(1).count() == 0:
        return
    add_deltas(summary_deltas(changes), f"{root}/days", DAY)
    add_deltas(customer_deltas(changes), f"{root}/customers", [*DAY, "customer_key"])
    fresh = load_first_orders(changes.where("sign > 0").select(*FIRST), f"{root}/first")
    add_deltas(fresh.select(*DAY, F.col("change").cast("bigint").alias("new_customers")), f"{root}/new", DAY)


def read_summary(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """The summary (columns of ``marts.sales_summary``) of all or some stored months."""
    def table(name: str) -> DataFrame:
        t = spark.read.parquet(f"{root}/{name}")
        return (t.where(F.col("month").isin(months)) if months else t).drop("month")

    days = table("days").where("total_orders <> 0")
    people = table("customers").where("orders > 0").groupBy(*DAY).agg(F.count(F.lit(1)).alias("unique_customers"))
    g = days.join(people, DAY, "left").join(table("new"), DAY, "left")
    zero = F.lit(0).cast("bigint")
    new, unique = F.coalesce("new_customers", zero), F.coalesce("unique_customers", zero)
    money = lambda c: (F.col(c).cast("decimal(19,0)") / 100).cast("decimal(20,2)")
    return g.select(
        F.expr("year(order_date) * 10000 + month(order_date) * 100 + day(order_date)").cast("int").alias("time_key"),
        F.col("order_date").alias("date"), "platform_key", "total_orders", "successful_orders", "cancelled_orders",
        "returned_orders", F.col("items").cast("bigint").alias("total_items_sold"),
        money("gross").cast("double").alias("gross_revenue"), money("disc").cast("double").alias("total_discounts"),
        money("net").cast("double").alias("net_revenue"), money("ship").cast("double").alias("shipping_revenue"),
        F.coalesce(safe_div(money("net"), "live_orders"), F.lit(0.0)).alias("average_order_value"),
        unique.alias("unique_customers"), new.alias("new_customers"), (unique - new).alias("returning_customers"),
        "vouchers_used", money("vdisc").cast("double").alias("voucher_discount_total"),
        safe_div(F.col("vouchers_used") * 100, "total_orders").alias("voucher_adoption_rate"))
