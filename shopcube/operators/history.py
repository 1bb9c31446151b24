"""Customer state over time: state before each order (W02), the daily state
history (D23) and the segment as of a usage date (J08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.functions.money import TOTAL
from shopcube.operators.dims import SegmentRules, dec
from shopcube.operators.sequence import asof_join, running_aggregates


def state_before_order(priced_orders: DataFrame) -> DataFrame:
    """For every order, the customer's prior orders and spend (ordered
    by order time, then order key) -- the same history as the D08 roll-up."""
    hist = priced_orders.select("customer_key", "order_key", "order_ts", "order_date",
                                "buyer_paid_price")
    r = running_aggregates(hist, ["customer_key"], ["order_ts", "order_key"],
                           sums=["buyer_paid_price"], maxes=["order_date"])
    return r.select("customer_key", "order_key", "order_date",
                    F.col("prior_count").alias("prior_orders"),
                    F.coalesce(F.col("prior_sum_buyer_paid_price"), F.lit(0)).cast(TOTAL)
                    .alias("prior_spent"),
                    F.col("prior_max_order_date").alias("previous_order_date"))


def customer_history(priced_orders: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """The states of :func:`customer_states` with the validity interval
    [valid_from, valid_to) (valid_to NULL = current)."""
    h = customer_states(priced_orders, rules)
    # valid_to = the next state's valid_from: the row whose previous date is
    # this row's date.  An equi join on unique (customer, date) keys, so a
    # customer with a long history is spread over the join, unlike lead().
    nxt = (h.filter(F.col("previous_order_date").isNotNull())
           .select("customer_key", F.col("previous_order_date").alias("valid_from"),
                   F.col("valid_from").alias("valid_to")))
    return h.join(nxt, ["customer_key", "valid_from"], "left")


def customer_states(priced_orders: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """One state per customer and order day (same-day orders collapsed):
    cumulative orders and spend after that day and the segment they imply.
    Inactivity is judged when the state is looked up (see segment_as_of)."""
    days = priced_orders.groupBy("customer_key", "order_date").agg(
        F.count(F.lit(1)).alias("day_orders"), F.sum("buyer_paid_price").alias("day_spent"))
    r = running_aggregates(days, ["customer_key"], ["order_date"],
                           sums=["day_orders", "day_spent"], maxes=["order_date"])
    orders_ = (F.coalesce(F.col("prior_sum_day_orders"), F.lit(0)) + F.col("day_orders"))
    spent = (F.coalesce(F.col("prior_sum_day_spent"), F.lit(0)) + F.col("day_spent")).cast(TOTAL)
    seg = (F.when(orders_ <= rules.new_max_orders, "New")
           .when(spent >= dec(rules.vip_min_spent), "VIP").otherwise("Regular"))
    return r.select("customer_key", F.col("order_date").alias("valid_from"),
                    orders_.cast("bigint").alias("orders_to_date"), spent.alias("spent_to_date"),
                    F.col("prior_max_order_date").alias("previous_order_date"),
                    seg.alias("segment"))


def segment_as_of(usage: DataFrame, history: DataFrame, rules: SegmentRules = SegmentRules(),
                  at: str = "usage_date") -> DataFrame:
    """The customer's segment in force strictly before ``at``: the
    latest earlier state, 'Inactive' when that state is older than the
    inactivity window, 'New' when there is none."""
    h = history.select("customer_key", "valid_from", "segment")
    u = usage.withColumn("_at_day", F.to_date(at))
    j = asof_join(u, h, ["customer_key"], "_at_day", "valid_from", strict=True, prefix="_h_")
    seg = (F.when(F.col("_h_segment").isNull(), "New")
           .when(F.datediff("_at_day", "_h_valid_from") > rules.inactive_days, "Inactive")
           .otherwise(F.col("_h_segment")))
    return j.withColumn("customer_segment_at_usage", seg).drop("_at_day", "_h_segment",
                                                               "_h_valid_from")


def segment_at_usage(usage: DataFrame, priced_orders: DataFrame,
                     rules: SegmentRules = SegmentRules(), at: str = "usage_date") -> DataFrame:
    """J08 in one skew-safe pass: the same result as
    ``segment_as_of(usage, customer_history(priced_orders))``.

    Usage rows are merged into each customer's sequence of order days,
    sorted before that day's orders; running sums over the preceding rows are
    then exactly the customer's state at the end of the previous order day.
    """
    days = (priced_orders.groupBy("customer_key", F.col("order_date").alias("_day"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("buyer_paid_price").alias("_s"))
            .select("customer_key", "_day", F.lit(1).alias("_side"), "_n", "_s",
                    F.col("_day").alias("_hday"),
                    F.lit(None).cast(_row_type(usage)).alias("_u")))
    u = usage.select("customer_key", F.to_date(at).alias("_day"), F.lit(0).alias("_side"),
                     F.lit(None).cast("bigint").alias("_n"),
                     F.lit(None).cast(days.schema["_s"].dataType).alias("_s"),
                     F.lit(None).cast("date").alias("_hday"),
                     F.struct(*[F.col(f"`{c}`") for c in usage.columns]).alias("_u"))
    r = running_aggregates(days.unionByName(u), ["customer_key"], ["_day", "_side"],
                           sums=["_n", "_s"], maxes=["_hday"])
    prior_n = F.coalesce(F.col("prior_sum__n"), F.lit(0))
    prior_s = F.coalesce(F.col("prior_sum__s"), F.lit(0)).cast(TOTAL)
    last = F.col("prior_max__hday")
    seg = (F.when(last.isNull(), "New")
           .when(F.datediff("_day", last) > rules.inactive_days, "Inactive")
           .when(prior_n <= rules.new_max_orders, "New")
           .when(prior_s >= dec(rules.vip_min_spent), "VIP").otherwise("Regular"))
    return (r.filter(F.col("_side") == 0)
            .select("_u.*", seg.alias("customer_segment_at_usage")))


def _row_type(df: DataFrame):
    from pyspark.sql import types as T
    return T.StructType(df.schema.fields)


# ---------------------------------------------------------------------------
# D23 by batches: merging late and new orders into stored validity intervals
# ---------------------------------------------------------------------------

STATE = ["customer_key", "valid_from", "orders_to_date", "spent_to_date", "previous_order_date", "segment", "valid_to",
         "day_orders", "day_spent"]


def _segment_of(orders_, spent, rules: SegmentRules):
    return (F.when(orders_ <= rules.new_max_orders, "New")
            .when(spent >= dec(rules.vip_min_spent), "VIP").otherwise("Regular"))


def merge_history(history: DataFrame | None, batch: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """The history of D23 after a batch of priced orders, in whatever order batches come.

    ``history``: the customers' states so far (STATE columns; None for none).
    States before a customer's earliest order of the batch stay; the one in
    force there ends at that day; the days behind it are added up again from
    the state before them.  Each order comes in one batch only.  A customer
    with a long history is spread over tasks (``running_aggregates``).
    """
    new = batch.groupBy("customer_key", F.col("order_date").alias("valid_from")).agg(
        F.count(F.lit(1)).alias("day_orders"), F.sum("buyer_paid_price").cast(TOTAL).alias("day_spent"))
    kept, tail, base = None, new, None
    if history is not None:
        since = new.groupBy("customer_key").agg(F.min("valid_from").alias("_m"))
        marked = history.select(*STATE).join(since, "customer_key", "left")
        in_force = (F.col("valid_from") < F.col("_m")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_m")))
        base = marked.where(in_force).select("customer_key", F.col("orders_to_date").alias("_n"), F.col("spent_to_date").alias("_s"),
                                             F.col("valid_from").alias("_from"))
        kept = marked.where(F.col("_m").isNull() | (F.col("valid_from") < F.col("_m"))).withColumn(
            "valid_to", F.when(in_force, F.col("_m")).otherwise(F.col("valid_to"))).select(*STATE)
        tail = (marked.where(F.col("valid_from") >= F.col("_m")).select(*new.columns).unionByName(new)
                .groupBy("customer_key", "valid_from").agg(F.sum("day_orders").alias("day_orders"),
                                                           F.sum("day_spent").cast(TOTAL).alias("day_spent")))
    r = running_aggregates(tail, ["customer_key"], ["valid_from"], sums=["day_orders", "day_spent"], maxes=["valid_from"])
    if base is None:
        r = r.withColumns({"_n": F.lit(0), "_s": F.lit(0), "_from": F.lit(None).cast("date")})
    else:
        r = r.join(base, "customer_key", "left")
    add = lambda *cs: sum((F.coalesce(F.col(c), F.lit(0)) for c in cs), F.lit(0))
    orders_ = add("_n", "prior_sum_day_orders", "day_orders").cast("bigint")
    spent = add("_s", "prior_sum_day_spent", "day_spent").cast(TOTAL)
    states = r.select("customer_key", "valid_from", orders_.alias("orders_to_date"), spent.alias("spent_to_date"),
                      F.coalesce("prior_max_valid_from", "_from").alias("previous_order_date"),
                      _segment_of(orders_, spent, rules).alias("segment"), "day_orders", "day_spent")
    # the next state of the tail is the one whose previous day is this row's (unique keys)
    nxt = states.where("previous_order_date IS NOT NULL").select(
        "customer_key", F.col("previous_order_date").alias("valid_from"), F.col("valid_from").alias("valid_to"))
    states = states.join(nxt, ["customer_key", "valid_from"], "left").select(*STATE)
    return states if kept is None else kept.unionByName(states)


def load_history(batch: DataFrame, root: str, rules: SegmentRules = SegmentRules(), buckets: int | None = None) -> None:
    """Merge a batch into the stored history at ``root``; only the buckets of its customers are read and replaced."""
    from shopcube.operators.load import BUCKETS, replace_touched
    replace_touched(batch, root, ["customer_key"], buckets or BUCKETS, lambda old: merge_history(old, batch, rules))


# ---------------------------------------------------------------------------
# W01 as a stored index: the first order of each customer, corrected by late orders
# ---------------------------------------------------------------------------

FIRST = ["customer_key", "order_ts", "order_key", "order_date", "platform_key"]


def merge_first_orders(index: DataFrame | None, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index, changes) after a batch of orders, in whatever order batches come.

    The index holds each customer's first order by (order_ts, order_key).
    ``changes`` (order_date, platform_key, change) is +1 where a customer is
    new and -1 on the day that an earlier order has taken it from; the sums
    over all batches are the new customers of each day.  An order that comes
    again changes nothing.  Minima are combined map-side.
    """
    from shopcube.operators.dims import checkpointed
    first = batch.groupBy("customer_key").agg(F.min(F.struct(*[c for c in FIRST if c != "customer_key"])).alias("f"))
    if index is None:
        now = checkpointed(first.select("customer_key", "f.*").select(*FIRST))
        return now, now.groupBy("order_date", "platform_key").agg(F.count(F.lit(1)).alias("change"))
    old = index.select("customer_key", F.struct(*[c for c in FIRST if c != "customer_key"]).alias("o"))
    both = checkpointed(old.join(first, "customer_key", "full").withColumn(
        "taken", F.col("f").isNotNull() & (F.col("o").isNull() | (F.col("f") < F.col("o")))))
    now = both.select("customer_key", F.when(F.col("taken"), F.col("f")).otherwise(F.col("o")).alias("n")).select("customer_key", "n.*")
    moved = both.where("taken")
    plus = moved.select("f.order_date", "f.platform_key", F.lit(1).cast("bigint").alias("change"))
    minus = moved.where("o IS NOT NULL").select("o.order_date", "o.platform_key", F.lit(-1).cast("bigint").alias("change"))
    changes = plus.unionByName(minus).groupBy("order_date", "platform_key").agg(F.sum("change").alias("change")).where("change <> 0")
    return now.select(*FIRST), changes


def load_first_orders(batch: DataFrame, root: str, buckets: int | None = None) -> DataFrame:
    """Merge a batch into the stored index at ``root`` and return the changes of new customers by day and platform."""
    from shopcube.operators.load import BUCKETS, replace_touched
    out = {}

    def merge(old):
        now, out["changes"] = merge_first_orders(old, batch)
        return now
    replace_touched(batch, root, ["customer_key"], buckets or BUCKETS, merge)
    return out["changes"]
