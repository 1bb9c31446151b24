"""The corpus pipeline: documents -> language ID -> quality rules -> near duplicates -> repeated passages -> packing.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and
works on all rows of ``docs``.  ``run`` writes what a stage returns to the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcube.llm.language_id import UNKNOWN, held_out, learn, predict
from shopcube.llm.minhash import near_duplicates
from shopcube.llm.packing import pack_documents
from shopcube.llm.quality_rules import keep_good
from shopcube.llm.registry import tokenizer_path
from shopcube.llm.repeats import remove_repeats
from shopcube.llm.ship import ship_package
from shopcube.session import scratch_path

LEAST_SCORE = 0.25       # share of a text's n-grams that its language must explain
SHINGLE = 5              # words in a shingle of the near-duplicate stage


def _packed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """doc_id and text beside ``row``, the named columns in one: their names are no concern then."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be learned; texts without letters and unexplained ones go.

    When no row has a label to learn from, nothing can be rejected.
    """
    ship_package(spark)
    filters = learn(docs.where(~held_out()))
    if not filters.langs:
        return docs
    found = predict(_packed(docs, docs.columns), filters, ["row"])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    ship_package(spark)
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Rows that share an id but not the text are judged each on their own; of
    several rows of one group that share the least id, the one with the least
    text hash stays.  Rows without an id stay.
    """
    ship_package(spark)
    own = F.xxhash64(F.col("text"))
    found = near_duplicates(docs.select("doc_id", "text", own.alias("h")), SHINGLE, keep=["h"])
    folder = scratch_path(spark, "near-duplicates")
    found.select("doc_id", "h", "group_no", "kept").write.parquet(folder)
    found = spark.read.schema("doc_id long, h long, group_no long, kept boolean").parquet(folder).where("doc_id IS NOT NULL")
    gone = found.where("NOT kept").select("doc_id", "h").distinct()
    of_group = found.where("kept").groupBy("doc_id", F.coalesce("group_no", "h").alias("g"))
    shared = of_group.agg(F.count("*").alias("n"), F.min("h").alias("first")).where("n > 1")
    if shared.limit(1).count():
        more = found.where("kept").withColumn("g", F.coalesce("group_no", "h")).join(shared, ["doc_id", "g"]).where("h <> first")
        gone = gone.unionByName(more.select("doc_id", "h")).distinct()
        docs = _without_repeats(docs, shared.select("doc_id").distinct())
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"))
    return docs.join(gone, (F.col("doc_id") == F.col("__id")) & (own == F.col("__h")), "left_anti").select(docs.columns)


def _without_repeats(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with one of the rows that share one of ``ids`` and the text."""
    some = docs.join(ids, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return docs.join(ids, "doc_id", "left_anti").select(docs.columns).unionByName(some)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings of 200 and more that occur elsewhere; n_chars follows the text."""
    ship_package(spark)
    left = remove_repeats(_packed(docs, [c for c in docs.columns if c not in ("text", "n_chars")]), keep=["row"])
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return left.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in their sequences."""
    ship_package(spark)
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("minhash_dedup", near_duplicate_stage),
    ("suffix_dedup", repeats_stage),
    ("packing", packing_stage),
]

# Learned filters, sketches and tokenizers have no SQL form: tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
