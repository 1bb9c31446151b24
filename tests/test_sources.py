"""JSON voucher scans, JSON export, the upload entry point and mart writes."""

import json

from pyspark.sql import functions as F

from shopcube.operators.load import export_json
from shopcube.operators.marts import write_mart
from shopcube.plans.upload import process_kpi_upload
from shopcube.sources.json_feeds import read_voucher_products, read_vouchers
from tests.test_kpi import FILE1, FILE3


def test_voucher_json(spark, tmp_path):
    v = tmp_path / "v.json"
    v.write_text("\n".join([
        json.dumps({"voucher_id": "V1", "voucher_type": "percentage", "discount_percentage": 10,
                    "maximum_discount": 50, "start_date": "2024-11-11 00:00:00",
                    "applicable_categories": "[\"PROMO\"]"}),
        json.dumps({"voucher_id": "V2", "voucher_type": "fixed_amount", "discount_value": 100,
                    "applicable_categories": "[]"}),
        "{not json",
    ]) + "\n")
    df = read_vouchers(spark, str(v))
    rows = {r["voucher_id"]: r for r in df.collect()}
    assert rows["V1"]["discount_percentage"] == 10 and str(rows["V1"]["start_date"]) == "2024-11-11 00:00:00"
    # Spark refuses queries that read only the corrupt-record column: keep a data column
    bad = df.filter(F.col("_corrupt_record").isNotNull()).select("voucher_id", "_corrupt_record")
    assert len(bad.collect()) == 1
    p = tmp_path / "vp.json"
    p.write_text("\n".join(json.dumps({"voucher_id": "V1", "sku_id": s}) for s in ["a", "b", "a"]))
    assert read_voucher_products(spark, str(p)).count() == 2


def test_export_json_and_mart(spark, tmp_path):
    df = spark.createDataFrame([(2024, 5, 1.5), (2024, 6, 2.0)], "year int, month int, v double")
    export_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    mart = str(tmp_path / "mart")
    write_mart(df, mart)
    write_mart(spark.createDataFrame([(2024, 6, 9.0)], "year int, month int, v double"), mart)
    got = {(r["month"], r["v"]) for r in spark.read.parquet(mart).collect()}
    assert got == {(5, 1.5), (6, 9.0)}   # only the rewritten partition changed


def test_upload_envelope_and_save(spark, tmp_path):
    f = tmp_path / "up"
    f.mkdir()
    (f / "a.csv").write_text(FILE1 + "\n")
    (f / "b.csv").write_text(FILE3 + "\n")
    r = process_kpi_upload(spark, str(f), "Lazada", save_to=str(tmp_path / "out"))
    assert r["status"] == "success" and r["rows_processed"] == 3 and r["rejected_rows"] == 4
    assert "total_sales_value" in r["columns"] and r["dataframe_shape"][0] == 3
    assert spark.read.parquet(str(tmp_path / "out" / "period")).count() == 1
    bad = process_kpi_upload(spark, str(f), "Nowhere")
    assert bad["status"] == "error"


def test_later_uploads_keep_earlier_ones(spark, tmp_path):
    save = str(tmp_path / "out")
    for name, body in (("march", FILE1), ("april", FILE1.replace("2024-03", "2024-04").replace("/03/", "/04/"))):
        (tmp_path / f"{name}.csv").write_text(body.replace("2024-04-31", "2024-04-30") + "\n")
        process_kpi_upload(spark, str(tmp_path / f"{name}.csv"), "Lazada", save_to=save)
    process_kpi_upload(spark, str(tmp_path / "april.csv"), "Lazada", save_to=save)      # again: replaces its own days
    months = spark.read.parquet(f"{save}/daily").groupBy(F.month("date").alias("m")).count()
    assert {r["m"]: r["count"] for r in months.collect()} == {3: 3, 4: 3}
    assert spark.read.parquet(f"{save}/period").count() == 2


def test_second_layout_reads_back(spark, tmp_path):
    from shopcube.operators.kpi import HEADER, PLATFORM_HEADERS, clean_kpi_feed
    from shopcube.sources.kpi_csv import read_kpi_csv, write_kpi_csv
    raw = spark.createDataFrame([tuple(["2024-05-01", "1.50"] + [str(i) for i in range(16)] + ["Shopee"])],
                                ", ".join(f"`{h}` string" for h in HEADER) + ", platform string")
    write_kpi_csv(raw, str(tmp_path / "s"), "Shopee")
    assert PLATFORM_HEADERS["shopee"] != PLATFORM_HEADERS["lazada"]
    r = clean_kpi_feed(read_kpi_csv(spark, str(tmp_path / "s"), "Shopee")).daily.collect()[0]
    assert (float(r["total_sales_value"]), r["visitors"], float(r["return_refund_amount"])) == (1.5, 0, 15.0)


def test_strict_upload_rejects_whole_file(spark, tmp_path):
    f = tmp_path / "strict"
    f.mkdir()
    (f / "a.csv").write_text(FILE1 + "\n")
    assert process_kpi_upload(spark, str(f), "Lazada", strict=True)["status"] == "success"
    (f / "b.csv").write_text(FILE3 + "\n")
    r = process_kpi_upload(spark, str(f), "Lazada", strict=True)
    assert r["status"] == "error" and r["detail"] == {"malformed_row": 2, "bad_date": 1,
                                                      "bad_number": 1}
