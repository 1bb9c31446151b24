"""The corpus pipeline, stage by stage and as a whole, against brute force."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.test_duplicates import near_brute, repeats_brute
from tests.llm.test_tokens import check_packing


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()), key=repr)


def test_stages_on_documents(spark):
    import corpus_pipeline as P
    from shopcube.llm.quality_rules import quality
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    (_, language), (_, rules), (_, near), (_, repeats), (_, packing) = P.STAGES

    kept = language(spark, docs, SF001)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert not [k for k in gone if k in labels and labels[k].quality == 1]         # clean documents stay

    good = rules(spark, kept, SF001)
    assert rows_of(good) == rows_of(kept.join(quality(kept).where("kept").select("doc_id"), "doc_id", "left_semi"))

    texts = {r.doc_id: r.text for r in good.collect()}
    _, root = near_brute(texts, 5)
    unique = near(spark, good, SF001)
    assert unique.columns == docs.columns
    assert rows_of(unique) == sorted(((k, texts[k]) for k in texts if root[k] == k), key=repr)

    left = repeats(spark, unique, SF001)
    assert left.columns == docs.columns
    want = {k: (n, r) for k, n, r, _, _ in repeats_brute(unique.collect())}
    for r in left.collect():
        n, removed = want[r.doc_id]
        assert n - removed - 6 * (removed > 0) <= len(r.text.encode()) <= n - removed and r.n_chars == len(r.text)
        if not removed:
            assert r.text == texts[r.doc_id]
    check_packing(left.collect(), packing(spark, left, SF001).collect())


def test_run_packs_what_the_stages_leave(spark):
    """run() gives the pieces of exactly the documents that the four filtering stages leave, one after the other."""
    import corpus_pipeline as P
    got = P.run(spark, SF001)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF001).checkpoint()
    left = docs.collect()
    assert 0 < len(left) < spark.read.parquet(f"{SF001}/documents.parquet").count()
    check_packing(left, got.collect())


@pytest.mark.parametrize("k", range(5))
def test_stage_on_edges_and_on_nothing(spark, edge_docs, no_docs, k):
    import corpus_pipeline as P
    name, stage = P.STAGES[k]
    out = stage(spark, edge_docs, SF001)
    if k < 4:
        assert out.columns == edge_docs.columns
    rows = out.collect()
    ids = [r.doc_id for r in rows]
    if name == "language_id":
        assert 3 not in ids and 5 not in ids and 13 not in ids and 8 in ids     # no text, no letters
    if name == "minhash_dedup":
        assert ids.count(1) == 1 and 2 not in ids and ids.count(6) == 1 and 7 not in ids and None in ids and 3 in ids
    if name == "suffix_dedup":
        assert len(rows) == edge_docs.count()
    assert stage(spark, no_docs, SF001).count() == 0
    assert edge_docs.where(F.col("doc_id") == 1).count() == 2
