"""JSON scans of landed voucher master records (A04) and voucher-product
rules (A05).  Declared schemas, no inference; malformed records are kept in
``_corrupt_record`` for the quality report instead of failing the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOUCHER_SCHEMA = (
    "voucher_id string, voucher_code string, voucher_name string, voucher_type string, "
    "discount_type string, discount_value decimal(10,2), discount_percentage decimal(5,2), "
    "minimum_spend decimal(10,2), maximum_discount decimal(10,2), usage_limit int, "
    "usage_limit_per_customer int, start_date timestamp_ntz, end_date timestamp_ntz, "
    "target_audience string, applicable_categories string, applicable_products string, "
    "status string, created_by string, _corrupt_record string")

VOUCHER_PRODUCT_SCHEMA = (
    "voucher_id string, sku_id string, discount_value decimal(10,2), "
    "discount_percentage decimal(5,2), _corrupt_record string")


def _read(spark: SparkSession, path, schema: str) -> DataFrame:
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss]")
            .json(path))


def read_vouchers(spark: SparkSession, path) -> DataFrame:
    """Voucher master records (JSON lines, one voucher per line)."""
    return _read(spark, path, VOUCHER_SCHEMA)


def read_voucher_products(spark: SparkSession, path) -> DataFrame:
    """Voucher -> product rules; duplicate pairs collapse (UNIQUE pair)."""
    df = _read(spark, path, VOUCHER_PRODUCT_SCHEMA)
    good = df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return good.dropDuplicates(["voucher_id", "sku_id"])
