"""Late events: set aside by the router, reconciled into closed days, bounded state."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from shopcube.streaming.jobs import run_available_now
from shopcube.streaming.lateness import closed_days_stream, read_routed, reconciled, route, users_of

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _files(spark, folder, days=24, per_day=30):
    r = random.Random(8)
    rows = [(d * 1000 + k, dt.datetime(2024, 1, 1 + d, r.randrange(24), r.randrange(60)), r.randrange(40), r.choice("ab"), r.randrange(10 ** 6) / 100)
            for d in range(days) for k in range(per_day)]
    files = defaultdict(list)
    for x in rows:
        at = x[1].day - 1 + (r.randrange(4, 9) if r.random() < .1 else r.randrange(2))
        files[at].append(x)
        if r.random() < .2:
            files[at + r.choice([0, 1, 6])].append(x)                     # the same event again
    files[3].append((-1, None, 1, "a", 1.0))
    for n in sorted(files):
        spark.createDataFrame(files[n], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return rows


def test_stream_and_reconciliation_equal_the_batch_result(spark, tmp_path):
    folder, root, out = str(tmp_path / "in"), str(tmp_path / "routed"), str(tmp_path / "closed")
    rows = _files(spark, folder)
    schema = spark.read.parquet(folder).schema
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run_available_now(source(), str(tmp_path / "c1"), sink=route(root))
    late = read_routed(spark, root, schema, "late")
    assert late.where("day IS NOT NULL").count() > 20 and late.where("day IS NULL").count() == 1
    before = {tuple(x) for x in read_routed(spark, root, schema).select("batch", "event_id").collect()}
    route(root)(spark.read.parquet(folder).limit(0).withColumn("ts", F.col("ts")), 999)             # an empty batch changes nothing
    again = read_routed(spark, root, schema)
    assert {tuple(x) for x in again.select("batch", "event_id").collect()} == before

    stream = closed_days_stream(spark, root, schema, files=6)
    q = (stream.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True)
         .format("parquet").option("path", out).start())
    q.awaitTermination()
    # the state holds days within the watermark and ids for twice as long: 9 of 24 days at most, however long it runs
    ids = [max(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert len(ids) > 5 and max(ids) <= 9 * 30 < len(rows) / 2 and dropped == 0

    closed = spark.read.parquet(out)
    assert 10 < closed.select("day").distinct().count() < 24
    got = {(x.day, x.event_type): (x.events, x.value_total) for x in reconciled(spark, closed, root, schema).collect()}
    want = defaultdict(lambda: [0, Decimal(0)])
    for _, ts, _, kind, value in rows:
        want[ts.date(), kind][0] += 1
        want[ts.date(), kind][1] += Decimal(str(value))
    assert got == {k: tuple(v) for k, v in want.items()}
    users = {(x.event_type): x.approx_users for x in users_of(reconciled(spark, closed, root, schema)).collect()}
    exact = {k: len({x[2] for x in rows if x[3] == k}) for k in "ab"}
    assert all(abs(users[k] - exact[k]) <= 0.05 * exact[k] + 1 for k in "ab")
