"""The upload entry point: a KPI export (one file or a folder of them) plus
a marketplace name -> cleaned tables and a result envelope (A01-A02, B12,
L08).  Replaces the single-request handler: files are read by executors, the
records are written rather than returned, and only counts reach the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shopcube.operators.kpi import clean_kpi_feed
from shopcube.sources.kpi_csv import read_kpi_csv


def _replace(rows, folder: str, *keys: str) -> None:
    (rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(folder))


def process_kpi_upload(spark: SparkSession, path, platform: str, save_to: str | None = None,
                       strict: bool = False) -> dict:
    """Returns the envelope: status, message, rows_processed, columns, shape,
    rejected rows; with ``save_to`` the day, period and quarantine rows are
    written there as Parquet (L08), partitioned by (platform, day), (platform,
    period) and (platform, file): a later upload of the same day, period or
    file takes the earlier one's place, and all others stay.  ``strict`` rejects the whole upload when
    any row is malformed (A07), reporting the counts per reason instead."""
    try:
        clean = clean_kpi_feed(read_kpi_csv(spark, path, platform))
        if strict:
            reasons = {r["reason"]: r["n"] for r in clean.quarantine.groupBy("reason")
                       .agg(F.count(F.lit(1)).alias("n")).collect()}   # one row per reason
            if reasons:
                return {"status": "error", "message": "malformed rows", "detail": reasons}
        daily = clean.daily
        if save_to:
            # an upload replaces the days, periods and files it holds, and no others
            n = daily.count()
            _replace(daily, f"{save_to}/daily", "platform", "date")
            _replace(clean.period, f"{save_to}/period", "platform", "period_start", "period_end")
            _replace(clean.quarantine, f"{save_to}/quarantine", "platform", "source_file")
        else:
            n = daily.count()
        rejected = clean.quarantine.count()
    except ValueError as e:   # unknown platform
        return {"status": "error", "message": str(e)}
    except Exception as e:    # unreadable file, header mismatch
        return {"status": "error", "message": f"{type(e).__name__}: {str(e)[:300]}"}
    return {"status": "success", "message": f"Processed {n} rows from {platform}",
            "rows_processed": n, "rejected_rows": rejected, "columns": daily.columns,
            "dataframe_shape": (n, len(daily.columns))}
