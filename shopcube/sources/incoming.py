"""Batches as a shop may send them: the driver's tables with damage by a fixed rule.

The quality rules run on these, so that every rule has something to find.
The damage depends on the keys alone, and its share is the same at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.sources.tables import Tables

# Every so many-th key is damaged in the named way.
ORDER_DAMAGE = {"repeated": 73, "status": 79, "orphan": 83, "no_customer": 89, "no_date": 97, "negative": 101}
LINE_DAMAGE = {"net": 271, "repeated": 283, "discount": 293, "no_quantity": 307, "orphan_product": 311, "orphan_order": 313}
EVENT_DAMAGE = {"type": 61, "no_user": 67}


def _hit(key, n: int):
    return F.pmod(key, F.lit(n)) == 0


def _again(df: DataFrame, repeated) -> DataFrame:
    """Every row once, and once more where ``repeated`` holds."""
    return df.withColumn("_copy", F.explode(F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def orders(t: Tables) -> DataFrame:
    k, n = F.col("o_orderkey"), ORDER_DAMAGE
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return _again(df, _hit(k, n["repeated"])).select(
        k.alias("order_key"),
        F.when(_hit(k, n["no_customer"]), None).when(_hit(k, n["orphan"]), -1 - F.col("o_custkey"))
        .otherwise(F.col("o_custkey")).alias("customer_key"),
        F.when(_hit(k, n["status"]), "X").otherwise(F.col("o_orderstatus")).alias("status_code"),
        F.when(~_hit(k, n["no_date"]), F.col("o_orderdate").cast("date")).alias("order_date"),
        F.when(_hit(k, n["negative"]), -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("total"))


def order_items(t: Tables) -> DataFrame:
    k, n = F.col("l_orderkey") * 8 + F.col("l_linenumber"), LINE_DAMAGE
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
    gross = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    off = F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("bigint")
    return _again(df, _hit(k, n["repeated"])).select(
        F.when(_hit(k, n["orphan_order"]), -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.when(_hit(k, n["orphan_product"]), -1 - F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("product_key"),
        F.when(~_hit(k, n["no_quantity"]), F.col("l_quantity")).alias("quantity"),
        (F.col("l_discount") + F.when(_hit(k, n["discount"]), 2).otherwise(0)).alias("discount_rate"),
        gross.alias("gross_cents"), off.alias("discount_cents"),
        (gross - off + F.when(_hit(k, n["net"]), 100).otherwise(0)).alias("net_cents"))


def events(t: Tables) -> DataFrame:
    k, n = F.col("event_id"), EVENT_DAMAGE
    return t.events.select(
        k.alias("event_key"), F.when(_hit(k, n["type"]), F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(~_hit(k, n["no_user"]), F.col("user_id")).alias("customer_key"))


ORACLE = f"""
in_orders0 AS (
  SELECT o_orderkey AS order_key,
         CASE WHEN o_orderkey % {ORDER_DAMAGE["no_customer"]} = 0 THEN NULL
              WHEN o_orderkey % {ORDER_DAMAGE["orphan"]} = 0 THEN -1 - o_custkey ELSE o_custkey END AS customer_key,
         CASE WHEN o_orderkey % {ORDER_DAMAGE["status"]} = 0 THEN 'X' ELSE o_orderstatus END AS status_code,
         CASE WHEN o_orderkey % {ORDER_DAMAGE["no_date"]} <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date,
         CASE WHEN o_orderkey % {ORDER_DAMAGE["negative"]} = 0 THEN -o_totalprice ELSE o_totalprice END AS total
  FROM orders),
in_orders AS (SELECT * FROM in_orders0
              UNION ALL SELECT * FROM in_orders0 WHERE order_key % {ORDER_DAMAGE["repeated"]} = 0),
in_items0 AS (
  SELECT l_orderkey * 8 + l_linenumber AS k,
         CASE WHEN (l_orderkey * 8 + l_linenumber) % {LINE_DAMAGE["orphan_order"]} = 0 THEN -1 - l_orderkey
              ELSE l_orderkey END AS order_key, l_linenumber AS line_number,
         CASE WHEN (l_orderkey * 8 + l_linenumber) % {LINE_DAMAGE["orphan_product"]} = 0 THEN -1 - l_partkey
              ELSE l_partkey END AS product_key,
         CASE WHEN (l_orderkey * 8 + l_linenumber) % {LINE_DAMAGE["no_quantity"]} <> 0 THEN l_quantity END AS quantity,
         l_discount + CASE WHEN (l_orderkey * 8 + l_linenumber) % {LINE_DAMAGE["discount"]} = 0 THEN 2 ELSE 0 END
           AS discount_rate,
         (l_orderkey * 8 + l_linenumber) % {LINE_DAMAGE["net"]} = 0 AS bad_net
  FROM lineitem),
in_items AS (SELECT * FROM in_items0 UNION ALL SELECT * FROM in_items0 WHERE k % {LINE_DAMAGE["repeated"]} = 0),
in_events AS (
  SELECT event_id AS event_key, CASE WHEN event_id % {EVENT_DAMAGE["type"]} = 0 THEN upper(event_type)
                                     ELSE event_type END AS event_type,
         CASE WHEN event_id % {EVENT_DAMAGE["no_user"]} <> 0 THEN user_id END AS customer_key
  FROM events)"""
