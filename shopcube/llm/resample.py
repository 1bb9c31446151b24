"""Operator 12: importance resampling towards a target distribution.

Words and word pairs are hashed into buckets.  Counts of all documents and of
all target texts give every bucket a gain, an array of fixed size; a
document's weight is the mean gain of its features.  With a noise that
follows from the document's key, the highest scores are a draw without
replacement in proportion to exp(weight).  Ranks come from a parallel sort by
regular sampling (``sample_sort``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.llm.batches import map_rows
from shopcube.llm.components import _stored
from shopcube.llm.feature_hash import Features
from shopcube.llm.sample_sort import ranked
from shopcube.llm.words import chunks

BUCKETS = 10_000
LEAST_WORDS = 20         # words of a document that can be drawn
SHARE = 25               # of 100 such documents that are drawn
SEED = 7


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; each task returns its sums, at most one row for each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, part in chunks(b.column(0)):
                total += np.bincount(Features(part).buckets(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    each = texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():        # as many rows as buckets
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the logarithm of how much more frequent each bucket is in the target."""
    n = len(source)
    s, t = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t)))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_features and weight."""
    def work(texts: pa.Array) -> dict:
        f = Features(texts)
        n, total = f.sums(gains)
        return {"n_words": pa.array(np.diff(f.bounds), pa.int64()), "n_features": pa.array(n, pa.int64()),
                "weight": pa.array(np.where(n > 0, total // np.maximum(n, 1), 0), pa.int64())}

    return map_rows(docs, [key], text, work, "n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             share: int = SHARE, seed: int = SEED, least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_features, weight, score, rank.

    Words are lower-cased (A-Z only) stretches of ASCII letters, digits and
    all characters beyond ASCII.  ``rank`` counts 1, 2, 3.. from the highest
    score, ties to the smaller key, for ``share`` per cent (rounded down) of
    the rows with ``least_words`` words and more; other rows have none.

    A null or empty text, or one without words, has no features and weight 0;
    a null key counts as an empty key in the noise and comes last among ties.
    Repeated rows are rows of their own with ranks of their own.  An empty
    target gives every bucket its gain against no counts; an empty table of
    documents gives an empty result.  Extra columns are not read.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    found = weights(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), gains, "key")
    scored = _stored(found.withColumn("score", (F.col("weight") + noise).cast("long")).select(
        "key", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("down"),
        F.coalesce(F.col("key").cast("long"), F.lit(2**63 - 1)).alias("tie"), F.monotonically_increasing_id().alias("row")),
        "resample-scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = ranked(able, ["down", "tie", "row"], able.count() * share // 100)
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(others).select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", "rank")
