"""Loading: feed union (U01), staging alignment (L01), upsert
into stored tables (L05, L07-L08).

A stored table is partitioned by a hash of its key.  A load reads only the
buckets that its rows fall into, writes the merged rows to the shared scratch
folder first, and then lets Spark replace just those partitions (dynamic
partition overwrite): a load that fails before leaves the table untouched,
and one that is repeated merges the same rows again, which changes nothing.
Loads into one table run one after the other.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DuplicateKeyError(ValueError):
    pass


def combine_feeds(*feeds: DataFrame) -> DataFrame:
    """Concatenate feeds by column name; duplicates kept, missing columns NULL."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def align_to(source: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Shape ``source`` like the target: its columns, order and types;
    absent columns get the default (or NULL)."""
    defaults = defaults or {}
    have = {c.lower(): c for c in source.columns}
    cols = []
    for f in schema.fields:
        if f.name.lower() in have:
            c = F.col(f"`{have[f.name.lower()]}`")
            if f.name in defaults:
                c = F.coalesce(c, F.lit(defaults[f.name]))
        else:
            c = F.lit(defaults.get(f.name))
        cols.append(c.cast(f.dataType).alias(f.name))
    return source.select(*cols)


def dedupe_last(df: DataFrame, key: list[str], order_by: str) -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key (L04 mode 'last').

    A grouped max_by over a struct: partially aggregated before the shuffle,
    so a key repeated millions of times never gathers in one task.
    """
    return _one_per_key(df, key, order_by, fail_on_duplicate=False)


def _one_per_key(df: DataFrame, key: list[str], order_by: str | None,
                 fail_on_duplicate: bool) -> DataFrame:
    """One row per key in a single grouped pass.  With ``fail_on_duplicate``
    a repeated key fails the job from inside the plan (``raise_error`` on the
    key column), so the batch is validated by the same job that merges it --
    no separate probe job -- and nothing is committed."""
    others = [c for c in df.columns if c not in key]
    order = [F.col(order_by)] if order_by else []
    best = F.max_by(F.struct(*others), F.struct(*order, *[F.col(c) for c in others]))
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), best.alias("_r"))
    if fail_on_duplicate:
        msg = F.concat(F.lit("duplicate key in batch: "),
                       F.concat_ws(",", *[F.col(k).cast("string") for k in key]))
        keys = [F.when(F.col("_n") > 1, F.raise_error(msg).cast(df.schema[k].dataType))
                .otherwise(F.col(k)).alias(k) for k in key]
    else:
        keys = [F.col(k) for k in key]
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def check_unique(df: DataFrame, key: list[str]) -> None:
    """Eager duplicate probe (one small job) for callers that want the error
    before planning anything else; :func:`upsert` validates in-plan instead."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key in batch: {dup[0].asDict()}")


class UpsertResult(NamedTuple):
    merged: DataFrame
    source: DataFrame


def upsert(target: DataFrame, source: DataFrame, key: str | list[str],
           on_duplicate: str = "error", order_by: str | None = None,
           defaults: dict | None = None) -> UpsertResult:
    """INSERT ... ON CONFLICT (key) DO UPDATE SET every other column.

    Updates overwrite all non-key columns, NULLs included; new keys insert;
    target rows without a matching key stay.  The batch is grouped by key
    once (validating or de-duplicating it), and that same key partitioning
    feeds the anti join with the target (sort-merge on the key at scale).
    ``on_duplicate='error'`` fails the executing job on a repeated key, as
    the database statement would; ``'last'`` keeps the greatest ``order_by``.
    """
    key = [key] if isinstance(key, str) else list(key)
    src = align_to(source, target.schema, defaults)
    if on_duplicate == "error":
        src = _one_per_key(src, key, order_by, fail_on_duplicate=True)
    elif on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        src = _one_per_key(src, key, order_by, fail_on_duplicate=False)
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")
    kept = target.join(src.select(*key), key, "left_anti")
    return UpsertResult(kept.unionByName(src), src)


def upsert_counts(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Inserted / updated / unchanged row counts, one row."""
    key = [key] if isinstance(key, str) else list(key)
    t = target.select(*key, F.lit(True).alias("_t"))
    s = source.select(*key, F.lit(True).alias("_s"))
    j = t.join(s, key, "full")
    return j.agg(F.count_if(F.col("_s") & F.col("_t").isNull()).alias("inserted"),
                 F.count_if(F.col("_s") & F.col("_t")).alias("updated"),
                 F.count_if(F.col("_t") & F.col("_s").isNull()).alias("unchanged"),
                 F.count(F.lit(1)).alias("total_after"))


# --------------------------------------------------------------------------
# Stored tables
# --------------------------------------------------------------------------

BUCKETS = 64             # partitions of a table; a table keeps its number


def _bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def _replace_buckets(df: DataFrame, root: str, key: list[str], buckets: int) -> None:
    (_bucketed(df, key, buckets).repartition("_bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(root))


def table_exists(spark: SparkSession, root: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of a stored table, None where there is none yet."""
    return spark.read.parquet(root).drop("_bucket") if table_exists(spark, root) else None


def replace_touched(batch: DataFrame, root: str, key: list[str], buckets: int, merge) -> None:
    """Replace the buckets that ``batch`` falls into by ``merge`` of their rows (None for a new table).

    The merged rows are staged before anything is replaced; an empty batch
    changes nothing.
    """
    from shopcube.session import scratch_path
    spark = batch.sparkSession
    if table_exists(spark, root):
        touched = [r[0] for r in _bucketed(batch, key, buckets).select("_bucket").distinct().collect()]      # <= buckets
        if not touched:
            return
        merged = merge(spark.read.parquet(root).where(F.col("_bucket").isin(touched)).drop("_bucket"))
    else:
        merged = merge(None)
    staged = scratch_path(spark, "merge")
    merged.write.parquet(staged)
    _replace_buckets(spark.read.schema(merged.schema).parquet(staged), root, key, buckets)


def load_with_upsert(spark: SparkSession, source: DataFrame, root: str, key: str | list[str],
                     on_duplicate: str = "error", order_by: str | None = None, buckets: int = BUCKETS) -> dict:
    """Upsert ``source`` into the table at ``root`` and report counts.

    Reads and writes the buckets of the batch's keys only; the first load
    creates the table.  An empty batch changes nothing.
    """
    from shopcube.session import scratch_path
    keys = [key] if isinstance(key, str) else list(key)
    if not table_exists(spark, root):
        src = _one_per_key(source, keys, order_by, fail_on_duplicate=on_duplicate == "error")
        _replace_buckets(src, root, keys, buckets)
        return {"inserted": read_table(spark, root).count(), "updated": 0}
    touched = [r[0] for r in _bucketed(source, keys, buckets).select("_bucket").distinct().collect()]   # <= buckets
    current = spark.read.parquet(root).where(F.col("_bucket").isin(touched)).drop("_bucket")
    res = upsert(current, source, keys, on_duplicate, order_by)
    counts = upsert_counts(current, res.source, keys).first().asDict()
    staged = scratch_path(spark, "upsert")
    res.merged.write.parquet(staged)
    _replace_buckets(spark.read.schema(res.merged.schema).parquet(staged), root, keys, buckets)
    return {"inserted": counts["inserted"], "updated": counts["updated"]}


def export_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines, written by the executors (no driver collect)."""
    df.write.mode("overwrite").json(path)


def with_load_time(df: DataFrame, load_ts, created: str = "created_at",
                   updated: str = "updated_at") -> DataFrame:
    """Stamp rows with the load time.  Pass the batch's fixed load time
    (not ``current_timestamp()`` per task) so reruns write identical rows;
    an existing ``created`` value is kept, ``updated`` is always refreshed."""
    ts = F.lit(load_ts).cast("timestamp_ntz")
    c = F.coalesce(F.col(created), ts) if created in df.columns else ts
    return df.withColumn(created, c).withColumn(updated, ts)
