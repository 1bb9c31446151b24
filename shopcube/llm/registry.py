"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shopcube.llm import quality_rules
from shopcube.llm.ship import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1_token_counts(spark, d):
    from shopcube.llm.token_counts import token_counts
    return token_counts(_documents(spark, d), tokenizer_path())


@query("op6_bpe_codec")
def op6_bpe_codec(spark, d):
    from shopcube.llm.bpe_codec import codec_digests
    return codec_digests(_documents(spark, d), tokenizer_path())


@query("op7_token_files")
def op7_token_files(spark, d):
    from shopcube.llm.token_files import read_digests, write_token_files
    from shopcube.session import scratch_path
    folder = scratch_path(spark, "token-files")
    write_token_files(_documents(spark, d), tokenizer_path(), folder)
    return read_digests(spark, folder)


@query("op3_packing")
def op3_packing(spark, d):
    from shopcube.llm.packing import pack_documents
    return pack_documents(_documents(spark, d), tokenizer_path())


@query("op9_quality_rules", quality_rules.oracle())
def op9_quality_rules(spark, d):
    return quality_rules.quality(_documents(spark, d))


@query("op5_language_id")
def op5_language_id(spark, d):
    from shopcube.llm.language_id import identify
    return identify(_documents(spark, d))


@query("op8_minhash_dedup")
def op8_minhash_dedup(spark, d):
    from shopcube.llm.minhash import near_duplicates
    return near_duplicates(_documents(spark, d), width=2).drop("group_no")


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark, d):
    from shopcube.llm.repeats import remove_repeats
    return remove_repeats(_documents(spark, d), texts=False)


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark, d):
    from shopcube.llm.embed_dedup import near_vectors
    return near_vectors(spark.read.parquet(f"{d}/embeddings.parquet"))


@query("op4_html_text")
def op4_html_text(spark, d):
    from shopcube.llm.html_text import main_text
    return main_text(spark.read.parquet(f"{d}/pages.parquet"))


@query("op11_exact_topk")
def op11_exact_topk(spark, d):
    from shopcube.llm.topk import top_k
    return top_k(spark.read.parquet(f"{d}/embeddings.parquet"))


@query("op12_target_resampling")
def op12_target_resampling(spark, d):
    from shopcube.llm.resample import resample
    found = resample(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_periodic_runs")
def op13_periodic_runs(spark, d):
    from shopcube.llm.runs import periodic_runs, run_digests
    return run_digests(periodic_runs(_documents(spark, d), planted=True))
