"""Stored maps from natural keys to surrogate keys (D06 for F05, F06, F07, F12).

A map is a table of (natural key columns, sk, load): read and extended by
each load, never renumbered.  New keys are dense behind the largest stored
one, in the order of the natural key; their blocks are handed out by range
partition, from one count a partition.  A load that runs again finds its keys
in the map and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.operators.dims import assign_surrogate_keys


def read_map(spark: SparkSession, path: str, keys: list[T.StructField]) -> DataFrame:
    """The stored map; empty when nothing has been stored."""
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in keys],
                           T.StructField("sk", T.LongType()), T.StructField("load", T.StringType())])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def extend_map(batch: DataFrame, keys: list[str], path: str, load: str) -> DataFrame:
    """Give every natural key of ``batch`` a surrogate key and return the whole map.

    Rows with a null in a key column have no key.  A hot key is counted once
    by map-side combination.  The map may be extended by one load at a time.
    """
    spark = batch.sparkSession
    fields = [batch.schema[k] for k in keys]
    known = read_map(spark, path, fields)
    wanted = batch.select(*keys).dropna().distinct()
    fresh = wanted.join(known.select(*keys), keys, "left_anti").select(F.struct(*keys).alias("k"))
    base = known.agg(F.coalesce(F.max("sk"), F.lit(0)).cast("bigint")).collect()[0][0]        # one number
    made = assign_surrogate_keys(fresh, "k", distinct=True)
    (made.select("k.*", (F.col("sk") + base).cast("bigint").alias("sk"), F.lit(load).alias("load"))
     .write.mode("append").parquet(path))
    return read_map(spark, path, fields)


def with_keys(facts: DataFrame, key_map: DataFrame, keys: list[str], sk: str) -> DataFrame:
    """``facts`` with their stored key; null where a natural key column is null."""
    return facts.join(key_map.select(*keys, F.col("sk").alias(sk)), keys, "left").select(*facts.columns, sk)
