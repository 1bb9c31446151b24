"""Distinct people over any period from stored daily bitmaps.

Distinct counts of days cannot be added up, but sets of people can be merged.
A load stores, for each day, platform and range of 32,768 people, one bitmap
for each kind of people (4 KB each).  Any period, platform or both together
is then the OR of its bitmaps, exact, without reading an order again.  Bits
follow a dense number of each person that never changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of people and which orders make one of them.
KINDS = {
    "visitors": "true",
    "buyers": "NOT is_cancelled",
    "add_to_cart_users": "voucher_total > 0",
    "wishlist_users": "has_return",
}
KEYS = ["platform_key", "date", "bucket"]


def _kinds(bitmaps: DataFrame) -> list[str]:
    return [f.name for f in bitmaps.schema.fields if f.dataType.typeName() == "binary"]


def people_bitmaps(priced_orders: DataFrame, numbers: DataFrame, kinds: dict[str, str] = KINDS) -> DataFrame:
    """(platform_key, date, bucket, a bitmap for each kind); ``numbers``: (customer_key, sk), sk dense from 1.

    Conditions that are null count as false.  Bitmaps are built map-side
    first, so a day with a third of all orders is no hot group.
    """
    o = priced_orders.join(numbers.select("customer_key", "sk"), "customer_key")
    at = F.bitmap_bit_position("sk")
    return (o.groupBy("platform_key", F.col("order_date").alias("date"), F.bitmap_bucket_number("sk").alias("bucket"))
            .agg(*[F.bitmap_construct_agg(F.when(F.expr(rule), at)).alias(kind) for kind, rule in kinds.items()]))


def merged_bitmaps(*tables: DataFrame, by: list[str] = KEYS) -> DataFrame:
    """Several bitmap tables as one: late orders of a stored day are merged into its bitmaps."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    kinds = _kinds(both)
    return both.groupBy(*by).agg(*[F.bitmap_or_agg(k).alias(k) for k in kinds])


def people_counts(bitmaps: DataFrame, by: list[Column | str]) -> DataFrame:
    """Distinct people of each kind for each group of stored days."""
    names = [f"_g{i}" for i in range(len(by))]
    cols = [F.col(b) if isinstance(b, str) else b for b in by]
    kinds = _kinds(bitmaps)
    keyed = bitmaps.select(*[c.alias(n) for c, n in zip(cols, names)], "bucket", *kinds)
    each = keyed.groupBy(*names, "bucket").agg(*[F.bitmap_count(F.bitmap_or_agg(k)).alias(k) for k in kinds])
    total = each.groupBy(*names).agg(*[F.sum(k).alias(k) for k in kinds])
    shown = bitmaps.select(*cols).columns
    return total.select(*[F.col(n).alias(c) for n, c in zip(names, shown)], *kinds)


def people_between(bitmaps: DataFrame, start, end, by: list[Column | str] = ()) -> DataFrame:
    """Distinct people of the stored days ``start`` .. ``end``."""
    days = bitmaps.where(F.col("date").between(F.lit(start), F.lit(end)))
    return people_counts(days, [F.lit("all").alias("period"), *by])


def people_rollup(bitmaps: DataFrame, grains: tuple[str, ...] = ("week", "month", "quarter", "year")) -> DataFrame:
    """(grain, period_start, platform_key, kinds): every period of every grain, for each platform and all (null)."""
    spans = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), F.trunc("date", g).alias("period_start")) for g in grains]))
    each = bitmaps.select("*", spans.alias("s")).select("*", "s.grain", "s.period_start").drop("s")
    one = people_counts(each, ["grain", "period_start", "platform_key"])
    both = people_counts(each, ["grain", "period_start"]).withColumn("platform_key", F.lit(None).cast("int"))
    return one.unionByName(both)


def store_bitmaps(bitmaps: DataFrame, path: str) -> None:
    """One folder a month; days of a month that is loaded again replace it."""
    (bitmaps.withColumn("month", F.date_format("date", "yyyy-MM")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
