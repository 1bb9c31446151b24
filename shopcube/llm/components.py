"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    folder = scratch_path(spark, name)
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.stored_at = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``_stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each id of ``edges`` reaches; ids are longs.

    Small-star and large-star steps in turn until the edges are stars whose
    centres are their least ids, so the rounds grow with the logarithm of
    the longest path, and edges that lead to common centres take one round.
    The least neighbour of every node is stored before it is joined back: a
    node with very many edges is then a plain skewed join, which is split at
    run time.  ``edges`` is read twice.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    old: list[DataFrame] = []
    while True:
        # small star: each node links its smaller neighbours and itself to the least of them
        least = _stored(e.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = _stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(least, *old)
        # large star: each node links its larger neighbours to its least neighbour
        both = small.unionByName(small.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        e = _stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .where("u <> v"), "edges")
        discard(least, small)
        centres = _stored(e.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")), "centres")
        child = centres.select(F.col("u").alias("m"))
        if not centres.where("m < x").limit(1).count() and not centres.join(child, "m", "left_semi").limit(1).count():
            discard(e)
            return (centres.select(F.col("u").alias("id"), F.col("m").alias("component"))
                    .unionByName(centres.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct()))
        discard(centres)
        old = [e]
