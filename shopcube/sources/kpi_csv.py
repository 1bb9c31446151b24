"""CSV scan of daily-KPI exports.

Many files are read in one job; every cell is read as a string (schema is
never inferred -- a single '-' row would flip a column's type), headers
are validated against the declared schema, and malformed rows land in
``_corrupt_record`` for the quarantine split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.operators.kpi import LAYOUTS, PLATFORM_HEADERS, to_canonical


def raw_schema(header: list[str]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in header]
                        + [T.StructField("_corrupt_record", T.StringType())])


def read_kpi_csv(spark: SparkSession, path: str | list[str], platform: str,
                 encoding: str = "UTF-8") -> DataFrame:
    """Raw KPI rows of one marketplace: 18 string cells, platform, source_file."""
    key = platform.strip().lower()
    if key not in PLATFORM_HEADERS:
        raise ValueError(f"unknown platform {platform!r}; expected one of {sorted(PLATFORM_HEADERS)}")
    header = PLATFORM_HEADERS[key]
    df = (spark.read.format("csv")
          .option("header", True)
          .option("enforceSchema", False)   # a header that does not match fails the scan
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .option("encoding", encoding)
          .schema(raw_schema(header))
          .load(path))
    df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return to_canonical(df, platform).withColumn("platform", F.lit(platform))


def write_kpi_csv(feed: DataFrame, path: str, platform: str) -> None:
    """Write feed rows as CSV files in the layout of a marketplace (the inverse of the scan)."""
    layout = LAYOUTS[platform.strip().lower()]
    (feed.where(F.col("platform") == platform).select(*[F.col(f"`{h}`").alias(c) for c, h in layout.items()])
     .write.option("header", True).csv(path))


def write_kpi_uploads(feed: DataFrame, path: str, platform: str) -> None:
    """Write feed rows as one CSV file for each source_file, in a folder of its name; corrupt rows as the lines they are.

    A file is one export of a period, so its lines are few.
    """
    layout = LAYOUTS[platform.strip().lower()]
    line = F.coalesce("_corrupt_record", F.to_csv(F.struct(*[F.col(f"`{h}`").alias(c) for c, h in layout.items()])))
    lines = feed.where(F.col("platform") == platform).groupBy("source_file").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    (lines.select("source_file", F.concat_ws("\n", F.lit(",".join(layout)), "lines").alias("value"))
     .write.partitionBy("source_file").text(path))
