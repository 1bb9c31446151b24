"""Upsert, feed union and stored-table semantics (FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopcube.operators.load import combine_feeds, load_with_upsert, read_table, upsert, upsert_counts

SCHEMA = ("transaction_id string, product_name string, quantity int, price decimal(10,2), "
          "customer_name string, transaction_date timestamp_ntz, source string")
T0 = dt.datetime(2024, 5, 1, 10, 0)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture()
def target(spark):
    return rows(spark, [
        ("t1", "mug", 1, Decimal("100.00"), "ana", T0, "Lazada"),
        ("t2", "cup", 2, Decimal("50.00"), "ben", T0, "Shopee"),
        ("t3", "pen", 3, Decimal("10.00"), "cy", T0, "Lazada"),
    ])


def as_dict(df):
    return {r["transaction_id"]: r.asDict() for r in df.collect()}


def test_insert_update_and_null_overwrite(spark, target):
    src = rows(spark, [
        ("t2", "cup", 5, Decimal("55.00"), None, T0, "Shopee"),     # update, NULL overwrites
        ("t4", "bag", 1, Decimal("300.00"), "dee", T0, "Lazada"),   # insert
    ])
    out = as_dict(upsert(target, src, "transaction_id").merged)
    assert set(out) == {"t1", "t2", "t3", "t4"}
    assert out["t2"]["quantity"] == 5 and out["t2"]["customer_name"] is None
    assert out["t1"]["price"] == Decimal("100.00")
    c = upsert_counts(target, src, "transaction_id").first()
    assert (c["inserted"], c["updated"], c["unchanged"], c["total_after"]) == (1, 1, 2, 4)


def test_duplicate_key_error_and_last(spark, target):
    later = T0 + dt.timedelta(hours=1)
    src = rows(spark, [("t9", "a", 1, Decimal("1.00"), "x", T0, "Lazada"),
                       ("t9", "b", 2, Decimal("2.00"), "y", later, "Lazada")])
    with pytest.raises(Exception, match="duplicate key in batch"):
        upsert(target, src, "transaction_id").merged.collect()
    out = as_dict(upsert(target, src, "transaction_id", on_duplicate="last",
                         order_by="transaction_date").merged)
    assert out["t9"]["product_name"] == "b"


def test_empty_batch_and_idempotence(spark, target):
    empty = rows(spark, [])
    assert as_dict(upsert(target, empty, "transaction_id").merged) == as_dict(target)
    src = rows(spark, [("t1", "mug", 9, Decimal("99.00"), "ana", T0, "Lazada")])
    once = upsert(target, src, "transaction_id").merged
    twice = upsert(once, src, "transaction_id").merged
    assert as_dict(once) == as_dict(twice)


def test_union_by_name_with_missing_column(spark):
    a = rows(spark, [("t1", "mug", 1, Decimal("1.00"), "ana", T0, "Lazada")])
    b = spark.createDataFrame([(T0, "t2", "Shopee", 2)],
                              "transaction_date timestamp_ntz, transaction_id string, source string, "
                              "quantity int")
    u = combine_feeds(a, b)
    got = as_dict(u)
    assert got["t2"]["customer_name"] is None and got["t2"]["quantity"] == 2
    assert u.count() == 2


def test_source_aligned_to_target_types(spark, target):
    src = spark.createDataFrame([("t5", "x", "3", "7.5", T0)],
                                "transaction_id string, product_name string, quantity string, "
                                "price string, transaction_date timestamp_ntz")
    out = as_dict(upsert(target, src, "transaction_id").merged)
    assert out["t5"]["quantity"] == 3 and out["t5"]["price"] == Decimal("7.50")
    assert out["t5"]["source"] is None


def test_loads_into_a_stored_table(spark, target, tmp_path):
    root = str(tmp_path / "tx")
    assert read_table(spark, root) is None
    assert load_with_upsert(spark, target, root, "transaction_id") == {"inserted": 3, "updated": 0}
    src = rows(spark, [("t3", "pen", 4, Decimal("12.00"), "cy", T0, "Lazada"),
                       ("t7", "ink", 1, Decimal("5.00"), "eve", T0, "Shopee")])
    assert load_with_upsert(spark, src, root, "transaction_id") == {"inserted": 1, "updated": 1}
    done = as_dict(read_table(spark, root))
    assert set(done) == {"t1", "t2", "t3", "t7"} and done["t3"]["quantity"] == 4
    # the same load again, and an empty one, change nothing
    assert load_with_upsert(spark, src, root, "transaction_id") == {"inserted": 0, "updated": 2}
    assert load_with_upsert(spark, src.where("false"), root, "transaction_id") == {"inserted": 0, "updated": 0}
    assert as_dict(read_table(spark, root)) == done
    # a failing load leaves the table as it is
    dup = rows(spark, [("t8", "a", 1, Decimal("1.00"), "x", T0, "L"), ("t8", "b", 1, Decimal("1.00"), "x", T0, "L")])
    with pytest.raises(Exception, match="duplicate key in batch"):
        load_with_upsert(spark, dup, root, "transaction_id")
    assert as_dict(read_table(spark, root)) == done


def test_a_load_rewrites_only_its_buckets(spark, tmp_path):
    import os
    root = str(tmp_path / "t")
    load_with_upsert(spark, spark.range(500).select("id", (F.col("id") * 2).alias("v")), root, "id", buckets=8)
    files = lambda: {b: sorted(os.listdir(f"{root}/{b}")) for b in os.listdir(root) if b.startswith("_bucket=")}
    before = files()
    load_with_upsert(spark, spark.createDataFrame([(3, -1)], "id long, v long"), root, "id", buckets=8)
    changed = [b for b, f in files().items() if before[b] != f]
    assert len(before) == 8 and len(changed) == 1
    assert read_table(spark, root).count() == 500 and read_table(spark, root).where("id = 3").first().v == -1


def test_load_time_stamps(spark, target):
    from shopcube.operators.load import with_load_time
    t1 = with_load_time(target, "2024-05-02 00:00:00")
    t2 = with_load_time(t1, "2024-05-03 00:00:00")
    r = t2.first()
    assert str(r["created_at"]) == "2024-05-02 00:00:00"
    assert str(r["updated_at"]) == "2024-05-03 00:00:00"
