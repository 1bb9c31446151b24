"""Traffic and shop activity from raw events: Fact_Traffic (F12, F13),
Fact_Activity (F14), traffic totals (G22), daily activity with running
follower total (G23, W03).

Event mapping (fixed, synthetic): view -> page view, click -> add to cart,
signup -> SHOP_FOLLOWED (+1 follower), error -> CHAT_SENT (value = response
seconds), purchase -> COUPON_CLAIMED; product = props.k; platform = user
parity + 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcube.functions.calendar import time_key
from shopcube.functions.money import safe_div
from shopcube.operators.windows import sessionize

# Activity type per raw event type.
ACTIVITY_TYPES = {"signup": "SHOP_FOLLOWED", "error": "CHAT_SENT", "purchase": "COUPON_CLAIMED"}


def canonical_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("ts"), F.col("user_id").alias("customer_key"), "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("product_key"),
        ((F.col("user_id") % 2) + 1).cast("int").alias("platform_key"),
        time_key(F.to_date("ts")).alias("time_key"))


def fact_traffic(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Fact_Traffic: day x product x customer x platform counts; visits are
    the distinct sessions touching the product that day."""
    e = sessionize(canonical_events(events), "customer_key", "ts", "event_id", gap_minutes)
    t = F.col("event_type")
    return (e.groupBy("time_key", "product_key", "customer_key", "platform_key")
            .agg(F.count_if(t == "view").alias("page_views"),
                 F.countDistinct("session_start").alias("visits"),
                 F.nullif(F.count_if(t == "click"), F.lit(0)).alias("add_to_cart_count"),
                 F.nullif(F.count_if(t == "wishlist"), F.lit(0)).alias("wishlist_add_count")))


def sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """one row per session: user, start, last event, event count."""
    e = sessionize(canonical_events(events), "customer_key", "ts", "event_id", gap_minutes)
    return (e.groupBy("customer_key", "session_start")
            .agg(F.max("ts").alias("last_event"), F.count(F.lit(1)).alias("events")))


def fact_activity(events: DataFrame) -> DataFrame:
    """Fact_Activity: typed shop events."""
    e = canonical_events(events)
    typ = None
    for k, v in ACTIVITY_TYPES.items():
        typ = F.when(F.col("event_type") == k, v) if typ is None else typ.when(F.col("event_type") == k, v)
    return (e.filter(F.col("event_type").isin(*ACTIVITY_TYPES))
            .select(F.col("event_id").alias("activity_event_key"), "time_key", "customer_key",
                    "platform_key", typ.alias("activity_type"),
                    F.when(F.col("event_type") == "error", F.floor("value").cast("int"))
                    .alias("chat_response_time_seconds"),
                    F.when(F.col("event_type") == "signup", F.lit(1)).alias("follower_count_change")))


def traffic_totals(traffic: DataFrame) -> DataFrame:
    """Totals per day and platform."""
    return (traffic.groupBy("time_key", "platform_key")
            .agg(F.sum("page_views").alias("page_views"), F.sum("visits").alias("visits"),
                 F.sum("add_to_cart_count").alias("add_to_cart"),
                 F.sum("wishlist_add_count").alias("wishlist_adds"),
                 F.countDistinct("product_key").alias("products_viewed")))


def traffic_by_product(traffic: DataFrame) -> DataFrame:
    """Totals per product."""
    return (traffic.groupBy("product_key")
            .agg(F.sum("page_views").alias("page_views"), F.sum("visits").alias("visits"),
                 F.sum("add_to_cart_count").alias("add_to_cart"),
                 F.sum("wishlist_add_count").alias("wishlist_adds"),
                 F.countDistinct("time_key").alias("days_viewed")))


def activity_daily(activity: DataFrame) -> DataFrame:
    """G23 + W03: chat response average, follower net change and running
    follower total per platform.  The running window covers one platform's
    days (bounded by the calendar), computed after the daily aggregation."""
    d = (activity.groupBy("platform_key", "time_key")
         .agg(F.count_if(F.col("activity_type") == "CHAT_SENT").alias("chats"),
              safe_div(F.sum("chat_response_time_seconds"), F.count("chat_response_time_seconds"))
              .alias("avg_chat_response_seconds"),
              F.coalesce(F.sum("follower_count_change"), F.lit(0)).alias("follower_net_change")))
    w = Window.partitionBy("platform_key").orderBy("time_key").rowsBetween(
        Window.unboundedPreceding, 0)
    return d.withColumn("followers_running_total", F.sum("follower_net_change").over(w))
