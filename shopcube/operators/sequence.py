"""Skew-safe running aggregates within groups (ranks, running sums, previous
values) -- the exact result of ``Window.partitionBy(g).orderBy(o)
.rowsBetween(unboundedPreceding, -1)`` without putting a whole group in one
task.

A window partitioned by a hot key (one voucher or customer with a third of
all rows) runs in a single task.  So groups are first counted in buckets (a
fixed number, combined map-side).  Groups of buckets that are small beside a
task's share go through the plain window: one shuffle.  For the others:

1. range-partition and sort by (group, order): a hot group spans many
   partitions; the partition id and the position inside it come from
   ``monotonically_increasing_id`` (no extra shuffle);
2. store, so the passes below see identical partitions;
3. inside each partition, running values per group come from a window
   partitioned by (partition id, group) -- bounded by the partition size;
4. only the first group of a partition can continue from earlier
   partitions; what it carries over is computed on a table with at most one
   row per partition and broadcast back.

``order_cols`` must order rows totally within a group (add a unique key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW = (1 << 33) - 1
BUCKETS = 1 << 16        # buckets in which the rows of groups are counted
HOT_LEAST = 1000         # rows of a bucket from which its groups can be hot


def running_aggregates(df: DataFrame, group_cols: list[str], order_cols: list,
                       sums: list[str] = (), maxes: list[str] = (), mins: list[str] = (),
                       num_partitions: int | None = None) -> DataFrame:
    """Adds, per row, aggregates over the *preceding* rows of its group:
    ``prior_count`` (so rank = prior_count + 1), ``prior_sum_<c>``,
    ``prior_max_<c>`` and ``prior_min_<c>`` (NULL for the first row).

    ``df`` is stored first, so it is worked out once.  Because the rows of hot
    groups are range-partitioned and sorted by (group, order), a
    group continues from earlier partitions only as the *first* group of a
    partition, and only if it was the *last* group of the previous non-empty
    partition.  The carried-over values therefore live in a table with at
    most one row per partition (bounded by the partition count, broadcast);
    the rows themselves are never joined against a per-group table.
    """
    from shopcube.operators.dims import stored
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.withColumn("_hb", F.pmod(F.xxhash64(*group_cols), F.lit(BUCKETS)).cast("int")))
    most = max(HOT_LEAST, rows.count() // (2 * n))
    hot = [r[0] for r in rows.groupBy("_hb").count().where(F.col("count") > most).select("_hb").collect()]  # < 2 n + 1
    if not hot:
        return _plain(rows, df.columns, group_cols, order_cols, sums, maxes, mins)
    is_hot = F.col("_hb").isin(hot)
    spread = _spread(rows.where(is_hot).drop("_hb"), group_cols, order_cols, sums, maxes, mins, n)
    return _plain(rows.where(~is_hot), df.columns, group_cols, order_cols, sums, maxes, mins).unionByName(spread)


def _plain(rows: DataFrame, columns: list[str], group_cols: list[str], order_cols: list, sums, maxes, mins) -> DataFrame:
    """The running values by a window over whole groups, in the types of :func:`_spread`."""
    from pyspark.sql import types as T
    w = (Window.partitionBy(*group_cols).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
         .rowsBetween(Window.unboundedPreceding, -1))

    def total(c):
        t, s = rows.schema[c].dataType, F.sum(c).over(w)
        return s.cast(T.DecimalType(min(38, t.precision + 21), t.scale)) if isinstance(t, T.DecimalType) else s

    return rows.select(*columns, F.count(F.lit(1)).over(w).alias("prior_count"),
                       *[total(c).alias(f"prior_sum_{c}") for c in sums],
                       *[F.max(c).over(w).alias(f"prior_max_{c}") for c in maxes],
                       *[F.min(c).over(w).alias(f"prior_min_{c}") for c in mins])


def _spread(df: DataFrame, group_cols: list[str], order_cols: list, sums, maxes, mins, n: int) -> DataFrame:
    """The running values of hot groups, each spread over many tasks."""
    from shopcube.operators.dims import stored
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    mid = F.monotonically_increasing_id()
    # stored: the positions feed later shuffles, and a recomputed
    # (indeterminate) stage could renumber them
    staged = stored(df.repartitionByRange(n, *[F.col(g) for g in group_cols], *order)
                    .sortWithinPartitions(*group_cols, *order)
                    .withColumn("_pid", F.shiftright(mid, 33))
                    .withColumn("_pos", mid.bitwiseAND(F.lit(_LOW))))
    gk = [f"_g{i}" for i in range(len(group_cols))]

    # (3) in-partition running values, exclusive of the current row
    w = Window.partitionBy("_pid", *group_cols).orderBy("_pos") \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = staged.select(
        "*",
        F.count(F.lit(1)).over(w).alias("_lc"),
        *[F.sum(c).over(w).alias(f"_ls_{c}") for c in sums],
        *[F.max(c).over(w).alias(f"_lx_{c}") for c in maxes],
        *[F.min(c).over(w).alias(f"_ln_{c}") for c in mins])

    # (4) last group of every non-empty partition and its totals there
    last_pos = staged.groupBy(F.col("_pid").alias("_kp")).agg(F.max("_pos").alias("_lp"))
    last_key = (staged.join(F.broadcast(last_pos),                               # <= P rows
                            (F.col("_pid") == F.col("_kp")) & (F.col("_pos") == F.col("_lp")))
                .select("_kp", *[F.col(g).alias(k) for g, k in zip(group_cols, gk)]))
    in_last = staged.join(F.broadcast(last_key),
                          [F.col("_pid") == F.col("_kp")]
                          + [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group_cols, gk)],
                          "left_semi")
    tail = in_last.groupBy(F.col("_pid").alias("_kp")).agg(
        F.count(F.lit(1)).alias("_tc"),
        *[F.sum(c).alias(f"_ts_{c}") for c in sums],
        *[F.max(c).alias(f"_tx_{c}") for c in maxes],
        *[F.min(c).alias(f"_tn_{c}") for c in mins])                              # <= P rows
    runs = last_key.join(tail, "_kp")
    # totals carried to the next non-empty partition: cumulative over the
    # run of partitions that end with the same group (small window, <= P rows)
    wr = Window.partitionBy(*gk).orderBy("_kp").rowsBetween(Window.unboundedPreceding, 0)
    nxt = F.lead("_kp").over(Window.orderBy("_kp"))
    carry = runs.select(
        nxt.alias("_cp"), *gk,
        F.sum("_tc").over(wr).alias("_oc"),
        *[F.sum(f"_ts_{c}").over(wr).alias(f"_os_{c}") for c in sums],
        *[F.max(f"_tx_{c}").over(wr).alias(f"_ox_{c}") for c in maxes],
        *[F.min(f"_tn_{c}").over(wr).alias(f"_on_{c}") for c in mins]
    ).filter(F.col("_cp").isNotNull())

    cond = [F.col("_pid") == F.col("_cp")] + [F.col(g).eqNullSafe(F.col(k))
                                              for g, k in zip(group_cols, gk)]
    j = local.join(F.broadcast(carry), cond, "left")

    def add(a, b):  # NULL-aware sum of two partial sums
        return F.when(F.col(a).isNull(), F.col(b)).when(F.col(b).isNull(), F.col(a)) \
            .otherwise(F.col(a) + F.col(b))

    out = [F.col(c) for c in df.columns]
    out.append((F.coalesce(F.col("_oc"), F.lit(0)) + F.col("_lc")).alias("prior_count"))
    out += [add(f"_os_{c}", f"_ls_{c}").alias(f"prior_sum_{c}") for c in sums]
    out += [F.greatest(f"_ox_{c}", f"_lx_{c}").alias(f"prior_max_{c}") for c in maxes]
    out += [F.least(f"_on_{c}", f"_ln_{c}").alias(f"prior_min_{c}") for c in mins]
    return j.select(*out)


def group_rank(df: DataFrame, group_cols: list[str], order_cols: list, name: str = "rank",
               **kw) -> DataFrame:
    """Row number within group in ``order_cols`` order (1-based), skew-safe."""
    r = running_aggregates(df, group_cols, order_cols, **kw)
    return r.withColumn(name, F.col("prior_count") + 1).drop("prior_count")


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              strict: bool = True, prefix: str = "") -> DataFrame:
    """Left as-of join: each left row gets the right row of the same ``by``
    key with the latest ``right_on`` that is < (``strict``) or <= the left
    row's ``left_on``; right columns are NULL when there is none.

    ``right`` must be unique on (by, right_on) -- collapse same-timestamp
    states first.  Both sides are unioned and ordered by (by, time, side);
    the matching right time is the running maximum of right times over the
    preceding rows (:func:`running_aggregates`, skew-safe), and the right
    attributes are fetched with an equi join on (by, matched time).
    """
    l_struct = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    # at equal times a strict match must not see the right row: left sorts first
    l_side, r_side = (0, 1) if strict else (1, 0)
    lt = left.schema[left_on].dataType
    l = left.select(*by, F.col(left_on).alias("_t"), F.lit(l_side).alias("_side"),
                    l_struct.alias("_l"), F.lit(None).cast(lt).alias("_rt"))
    r = right.select(*by, F.col(right_on).cast(lt).alias("_t"), F.lit(r_side).alias("_side"),
                     F.lit(None).cast(l_struct_type(left)).alias("_l"),
                     F.col(right_on).cast(lt).alias("_rt"))
    seq = running_aggregates(l.unionByName(r), by, ["_t", "_side"], maxes=["_rt"])
    matched = (seq.filter(F.col("_side") == l_side)
               .select("_l.*", F.col("prior_max__rt").alias("_match_t")))
    rcols = [c for c in right.columns if c not in by]
    rr = right.select(*by, F.col(right_on).cast(lt).alias("_match_t"),
                      *[F.col(c).alias(prefix + c) for c in rcols])
    return matched.join(rr, [*by, "_match_t"], "left").drop("_match_t")


def l_struct_type(df: DataFrame):
    from pyspark.sql import types as T
    return T.StructType(df.schema.fields)
