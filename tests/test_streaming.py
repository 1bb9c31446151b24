"""Streaming jobs: incremental result equals the batch result; sinks are idempotent."""

from pyspark.sql import functions as F

from shopcube.operators.kpi import clean_kpi_feed
from shopcube.session import scratch_path
from shopcube.sources.kpi_csv import read_kpi_csv
from shopcube.streaming.jobs import (alert_stream, complete_to_table, event_rollup_stream,
                                     event_stream, kpi_ingest_stream, latest_snapshot,
                                     run_available_now, upsert_stream, write_kpi_batches)
from tests.conftest import SF001
from tests.test_kpi import FILE1, FILE2, FILE3


def test_kpi_file_drop_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "drop"
    src.mkdir()
    for i, body in enumerate([FILE1, FILE2, FILE3]):
        (src / f"f{i}.csv").write_text(body + "\n")
    out = str(tmp_path / "out")
    stream = kpi_ingest_stream(spark, str(src), "Lazada")
    run_available_now(stream, str(tmp_path / "ck"), sink=write_kpi_batches(out))
    streamed = spark.read.parquet(f"{out}/daily").drop("query", "batch")
    batch = clean_kpi_feed(read_kpi_csv(spark, str(src), "Lazada")).daily
    key = lambda df: sorted(map(tuple, df.select("date", "total_sales_value").collect()))  # noqa
    assert key(streamed) == key(batch)
    # new file dropped later: only it is processed on the next run
    (src / "f9.csv").write_text(FILE1.replace("2024", "2023") + "\n")
    run_available_now(kpi_ingest_stream(spark, str(src), "Lazada"), str(tmp_path / "ck"),
                      sink=write_kpi_batches(out))
    assert spark.read.parquet(f"{out}/daily").count() == batch.count() + 3


def test_upsert_sink_is_idempotent(spark, tmp_path):
    from shopcube.operators.load import read_table
    root = str(tmp_path / "tbl")
    sink = upsert_stream("k", root, on_duplicate="last", order_by="v")
    b0 = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "k int, v int")
    b1 = spark.createDataFrame([(2, 5), (3, 30)], "k int, v int")
    for n, batch in enumerate((b0, b1, b1)):  # the last one is a replay
        sink(batch, min(n, 1))
    assert sorted(map(tuple, read_table(spark, root).collect())) == [(1, 10), (2, 5), (3, 30)]


def test_upsert_stream_on_a_loaded_table_misses_nothing(spark, tmp_path):
    from shopcube.operators.load import load_with_upsert, read_table
    root, src = str(tmp_path / "tbl"), tmp_path / "in"
    load_with_upsert(spark, spark.createDataFrame([(1, 10), (2, 20)], "k int, v int"), root, "k")

    def feed(rows, checkpoint):
        spark.createDataFrame(rows, "k int, v int").write.mode("append").parquet(str(src))
        stream = spark.readStream.schema("k int, v int").parquet(str(src))
        run_available_now(stream, str(tmp_path / checkpoint), sink=upsert_stream("k", root, "last", "v"))
        return sorted(map(tuple, read_table(spark, root).collect()))
    assert feed([(2, 25), (3, 30)], "a") == [(1, 10), (2, 25), (3, 30)]
    assert feed([(4, 40)], "a") == [(1, 10), (2, 25), (3, 30), (4, 40)]
    assert feed([(5, 50)], "new") == [(1, 10), (2, 25), (3, 30), (4, 40), (5, 50)]   # starts again at batch 0


def test_upsert_stream_needs_an_order(spark, tmp_path):
    import pytest
    with pytest.raises(ValueError):
        upsert_stream("k", str(tmp_path))
    sink = upsert_stream("k", str(tmp_path / "t"), on_duplicate="error")
    with pytest.raises(Exception, match="duplicate key"):
        sink(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), 0)


def test_out_of_order_files_equal_the_batch_result(spark, tmp_path):
    """Three files, one per micro-batch, the oldest events last: a backfill counts every row."""
    from shopcube.streaming.jobs import BACKFILL, session_stream
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = str(tmp_path / "ev")
    days = ev.select(F.expr("percentile_approx(cast(cast(ts as timestamp) as long), array(0.33, 0.66))").alias("p")).first().p
    t = F.col("ts").cast("timestamp").cast("long")
    for part in (ev.where(t > days[1]), ev.where((t > days[0]) & (t <= days[1])), ev.where(t <= days[0])):
        part.coalesce(1).write.mode("append").parquet(src)
    s = event_rollup_stream(event_stream(spark, src, 1), BACKFILL)
    out = str(tmp_path / "out")
    run_available_now(s, str(tmp_path / "ck"), "complete", sink=complete_to_table(out))
    got = {(r.day, r.event_type): r.events for r in latest_snapshot(spark, out).collect()}
    want = {(r.day, r.event_type): r.n for r in ev.groupBy(F.to_date("ts").alias("day"), "event_type")
            .agg(F.countDistinct("event_id").alias("n")).collect()}
    assert got == want
    out = str(tmp_path / "out2")
    run_available_now(session_stream(event_stream(spark, src, 1), watermark=BACKFILL), str(tmp_path / "ck2"),
                      "complete", sink=complete_to_table(out))
    assert latest_snapshot(spark, out).agg(F.sum("events")).first()[0] == ev.count()


def test_event_rollup_complete_equals_batch_and_alerts(spark):
    s = event_rollup_stream(event_stream(spark, f"{SF001}/events.parquet*"))
    out = scratch_path(spark, "t-rollup")
    run_available_now(s, scratch_path(spark, "t-rollup-ck"), "complete", sink=complete_to_table(out))
    snap = latest_snapshot(spark, out)
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    exp = ev.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("events"))
    key = lambda df: sorted(map(tuple, df.select("day", "event_type", "events").collect()))  # noqa
    assert key(snap) == key(exp)
    alerts = alert_stream(snap, "view", 1)
    assert alerts.count() == exp.filter("event_type = 'view'").count()


def test_event_days_do_not_depend_on_session_time_zone(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    exp = sorted(map(tuple, ev.groupBy(F.to_date("ts").alias("day"), "event_type")
                     .agg(F.count("*").alias("events")).collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        s = event_rollup_stream(event_stream(spark, f"{SF001}/events.parquet*"))
        out = scratch_path(spark, "tz-rollup")
        run_available_now(s, scratch_path(spark, "tz-ck"), "complete", sink=complete_to_table(out))
        got = sorted(map(tuple, latest_snapshot(spark, out).select("day", "event_type", "events")
                         .collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == exp


def test_uploads_of_both_marketplaces_are_streamed_with_their_bad_rows(spark):
    """The streams see every row of the export, one upload for each month: days and rejected rows are those of the feed."""
    from shopcube.plans.registry import QUERIES
    key = lambda df, *c: sorted(map(tuple, df.select(*c).collect()))
    cols = "platform", "date", "total_sales_value", "total_orders", "visitors"
    days = key(QUERIES["kpi_daily"](spark, SF001), *cols)
    assert {p for p, *_ in days} == {"Lazada", "Shopee"}
    assert key(QUERIES["stream_kpi_uploads"](spark, SF001), *cols) == days
    rejected = key(QUERIES["kpi_quarantine"](spark, SF001), "platform", "reason", "rows")
    assert {r for _, r, _ in rejected} >= {"malformed_row", "out_of_period"}
    assert key(QUERIES["stream_kpi_quarantine"](spark, SF001), "platform", "reason", "rows") == rejected
