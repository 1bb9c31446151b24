"""Event roll-up with bounded state: late events are set aside and reconciled into closed days.

1. A router splits arriving events by a lateness bound: an event whose day
   lies more than ``lateness`` days before the latest one seen goes to the
   late table, the others to the on-time table (both one folder a micro-batch
   and day).
2. The roll-up stream reads the on-time table with a watermark of that bound,
   so Spark releases the state of a day once no on-time event can reach it,
   and the ids kept for repeated events after that time again: the state
   holds the last days only, however long the stream runs.
3. A batch step adds the late events to the closed days, without those whose
   id the same day has already counted, and the days that are still open.

Users are kept as mergeable sketches (HyperLogLog with 4,096 registers,
standard error 1.6 %): days are merged to any period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.streaming.jobs import from_wall, to_wall

LATENESS = 2             # days
USERS_ERROR = 0.05       # three standard errors of a users sketch


def _parted(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("day", T.DateType())])


def read_routed(spark: SparkSession, root: str, schema: T.StructType, which: str = "on_time") -> DataFrame:
    return spark.read.schema(_parted(schema)).parquet(f"{root}/{which}")


def route(root: str, lateness: int = LATENESS):
    """foreachBatch sink of step 1.  The bound of a batch follows from the batches before it and itself, so a
    replayed batch is split in the same way and replaces its own folders.  Events without a time are late."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        rows = batch.withColumn("day", F.to_date("ts")).persist()
        newest = [rows.agg(F.max("day")).first()[0]]                                       # one date
        if batch_id:
            seen = read_routed(spark, root, schema).where(F.col("batch") < batch_id)
            newest.append(seen.agg(F.max("day")).first()[0])
        bound = F.date_sub(F.lit(max((d for d in newest if d), default=None)).cast("date"), lateness)
        on_time = F.coalesce(F.col("day") >= bound, F.lit(False))
        for name, part in (("on_time", rows.where(on_time)), ("late", rows.where(~on_time))):
            part.write.mode("overwrite").partitionBy("day").parquet(f"{root}/{name}/batch={batch_id}")
        rows.unpersist()
    return sink


def daily(events: DataFrame, day) -> DataFrame:
    """Events, value and users sketch per day and type; ``value`` in exact cents."""
    return events.groupBy(day.alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(28,2)").alias("value_total"),
        F.hll_sketch_agg("user_id", F.lit(12)).alias("users"))


def closed_days_stream(spark: SparkSession, root: str, schema: T.StructType, lateness: int = LATENESS,
                       files: int | None = None) -> DataFrame:
    """Step 2 as a stream in append mode: each day once, when it is closed.

    The watermark is a day wider than the router's bound, which counts whole days.
    """
    tz = spark.conf.get("spark.sql.session.timeZone")
    r = spark.readStream.schema(_parted(schema))
    if files:
        r = r.option("maxFilesPerTrigger", files)
    e = r.parquet(f"{root}/on_time").drop("day").withColumn("ts", from_wall(F.col("ts"), tz))
    e = e.withWatermark("ts", f"{lateness + 1} days").dropDuplicatesWithinWatermark(["event_id"])
    out = daily(e, F.window("ts", "1 day"))
    return out.withColumn("day", F.to_date(to_wall(F.col("day.start"), tz)))


def reconciled(spark: SparkSession, closed: DataFrame, root: str, schema: T.StructType) -> DataFrame:
    """Step 3: (day, event_type, events, value_total, users) over all events that arrived, each id once a day.

    Reads the on-time events of days that have late events or are still
    open, and no others.
    """
    on_time, late = read_routed(spark, root, schema), read_routed(spark, root, schema, "late")
    late = late.where("day IS NOT NULL").dropDuplicates(["event_id", "day"])
    same_days = on_time.join(F.broadcast(late.select("day").distinct()), "day", "left_semi")       # days, pruned by partition
    fresh = late.join(same_days.select("event_id", "day"), ["event_id", "day"], "left_anti")
    days = closed.select("day").distinct()
    still_open = on_time.join(F.broadcast(days), "day", "left_anti").dropDuplicates(["event_id", "day"])
    cols = ["day", "event_type", "events", "value_total", "users"]
    every = closed.select(cols).unionByName(daily(fresh, F.col("day")).select(cols)).unionByName(daily(still_open, F.col("day")).select(cols))
    return every.groupBy("day", "event_type").agg(
        F.sum("events").cast("bigint").alias("events"), F.sum("value_total").cast("decimal(28,2)").alias("value_total"),
        F.hll_union_agg("users").alias("users"))


def users_of(days: DataFrame, grain: str = "month") -> DataFrame:
    """(period, event_type, approx_users) from the days' sketches."""
    return (days.groupBy(F.trunc("day", grain).alias("period"), "event_type")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_users")))
