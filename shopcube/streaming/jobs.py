"""Structured Streaming versions of the ingest and roll-up jobs.

* S01 :func:`kpi_ingest_stream`   -- file-drop ingest of KPI exports.
* S02 :func:`upsert_stream`       -- incremental, idempotent upsert per micro-batch.
* S03 :func:`event_rollup_stream` -- daily event roll-up with a lateness bound.
* S04 :func:`dedup_events`        -- event de-duplication inside the watermark.
* S05 :func:`session_stream`      -- visits from live events (session windows).
* S06 :func:`alert_stream`        -- threshold alerts on the daily roll-up.

Event time: the driver's ``ts`` is TIMESTAMP_NTZ, which watermarks reject.
It is turned into a TIMESTAMP whose instant is the wall-clock time read as
UTC (:func:`from_wall`), independent of the session time zone, so day
windows align with calendar days and 30-minute gaps never cross a DST jump;
results are turned back into wall-clock values (:func:`to_wall`).  Exact distinct counts are not available
on streams; visitor counts use ``approx_count_distinct``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcube.operators.kpi import clean_kpi_feed
from shopcube.sources.kpi_csv import raw_schema
from shopcube.operators.kpi import PLATFORM_HEADERS, to_canonical


def _tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def from_wall(c, tz: str):
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP at that wall clock in UTC."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c).cast("timestamp")


def to_wall(c, tz: str):
    """Inverse of :func:`from_wall`."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), c.cast("timestamp_ntz"))


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    tz = spark.conf.get("spark.sql.session.timeZone")
    return r.parquet(path).withColumn("ts", from_wall(F.col("ts"), tz))


#: Lateness bound of a backfill: files come in any order, and no row of them is late.
BACKFILL = "36500 days"


def dedup_events(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Drop repeated event ids arriving within the watermark."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])


def event_rollup_stream(events: DataFrame, watermark: str = "1 day",
                        dedup: bool = True) -> DataFrame:
    """Per day and event type: events, value total, approximate users."""
    e = dedup_events(events, watermark) if dedup else events.withWatermark("ts", watermark)
    return (e.groupBy(F.window("ts", "1 day").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 # exact decimal sum: independent of micro-batch and partition order
                 F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("value_total"),
                 F.approx_count_distinct("user_id").alias("approx_users"))
            .select(F.to_date(to_wall(F.col("w.start"), _tz(events))).alias("day"),
                    "event_type", "events",
                    "value_total", "approx_users"))


def session_stream(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour"
                   ) -> DataFrame:
    """One row per closed session of a user (30-minute inactivity gap)."""
    return (events.withWatermark("ts", watermark)
            .groupBy(F.session_window("ts", gap).alias("s"), "user_id")
            .agg(F.count(F.lit(1)).alias("events"))
            .select("user_id", to_wall(F.col("s.start"), _tz(events)).alias("session_start"),
                    to_wall(F.col("s.end"), _tz(events)).alias("session_end"), "events"))


def alert_stream(rollup: DataFrame, event_type: str = "error", min_events: int = 100
                 ) -> DataFrame:
    """Days where an event type (default: errors) crosses a threshold."""
    return (rollup.filter((F.col("event_type") == event_type) & (F.col("events") >= min_events))
            .select("day", "event_type", "events",
                    F.lit(f"{event_type} events >= {min_events}").alias("alert")))


def kpi_ingest_stream(spark: SparkSession, source_dir: str, platform: str) -> DataFrame:
    """Raw KPI rows from files dropped into ``source_dir`` (all-string
    schema, header validated per file, malformed rows captured)."""
    header = PLATFORM_HEADERS[platform.lower()]
    raw = (spark.readStream.schema(raw_schema(header))
           .option("header", True).option("enforceSchema", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
           .csv(source_dir))
    raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
    return to_canonical(raw, platform).withColumn("platform", F.lit(platform))


def write_kpi_batches(out_root: str):
    """foreachBatch sink for S01: clean each micro-batch and append the day,
    period and quarantine rows to their tables.  Output folders are named by
    (query, batch): a replayed batch overwrites its own files only, and a
    stream with a new checkpoint adds to what an earlier one left."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        query = query_id(batch.sparkSession)
        clean = clean_kpi_feed(batch)
        for name, df in (("daily", clean.daily), ("period", clean.period),
                         ("quarantine", clean.quarantine)):
            df.write.mode("overwrite").parquet(f"{out_root}/{name}/query={query}/batch={batch_id}")
    return sink


def upsert_stream(key: str, table_root: str, on_duplicate: str = "last",
                  order_by: str | None = None):
    """foreachBatch sink that upserts each micro-batch into a stored
    table, on top of whatever it holds.  Only the buckets of the batch's keys
    are read and replaced; a batch that is replayed is merged again, which
    changes nothing as long as ``order_by`` decides between versions of a row."""
    from shopcube.operators.load import load_with_upsert
    if on_duplicate == "last" and order_by is None:
        raise ValueError("keeping the last of several rows needs order_by")

    def sink(batch: DataFrame, batch_id: int) -> None:
        load_with_upsert(batch.sparkSession, batch, table_root, key, on_duplicate, order_by)
    return sink


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query whose batch runs now; it lives as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def run_available_now(stream: DataFrame, checkpoint: str, output_mode: str = "append",
                      sink=None, path: str | None = None) -> None:
    """Process everything available, then stop (incremental batch runs)."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True)
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format("parquet").option("path", path)
    q = w.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def complete_to_table(path: str):
    """foreachBatch sink for complete-mode results: each batch carries the
    full current result, written as that batch's partition."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return sink


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch: one partition of the folder is read."""
    all_ = spark.read.parquet(path)
    return all_.where(F.col("batch") == all_.agg(F.max("batch")).scalar()).drop("batch")
