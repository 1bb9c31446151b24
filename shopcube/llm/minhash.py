"""Operator 8: near duplicates by fast similarity sketching, banding and exact verification.

Rows of equal shingle sets form a class.  Classes meet in band buckets of their sketches.  In a bucket, all
members are compared with its least member only; after the links found so
far are joined to components, the members of buckets in which several
components are left are compared with each other, block by block inside the
tasks, which give back one row for each linked member and never a list of
pairs.  So a bucket of copies costs as many comparisons as it has members,
and no link that could join two components is left out.  Every link is
confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.llm.batches import map_rows
from shopcube.llm.components import _stored, components, discard
from shopcube.llm.shingles import K1, K2, mix, shingle_sets, sketch

BANDS, ROWS = 32, 5      # at similarity 0.8 a pair is missed with probability 3e-6, above it with less
LEAST = 80               # similarity in percent
BLOCK = 1024             # members of a bucket in one block, at most about
BLOCK_SHINGLES = 2 << 20 # and shingles of all of them


def sketches(docs: DataFrame, width: int, keys: list[str], text: str = "text") -> DataFrame:
    """Per row: keys, n_shingles, two sums that identify its set, and one hash for each band."""
    def work(texts: pa.Array) -> dict:
        sets, bounds = shingle_sets(texts, width)
        n = np.diff(bounds)
        s = sketch(sets, bounds, BANDS * ROWS).reshape(len(n), BANDS, ROWS)
        band = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(n), 1))
        for k in range(ROWS):
            band = mix(band * K1 + s[:, :, k] * K2)
        held = n > 0
        ends = np.concatenate([[0], np.cumsum(np.where(held, BANDS, 0))]).astype(np.int32)
        return {**identity_columns(sets, bounds),
                "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(band[held].reshape(-1).view(np.int64)))}

    return map_rows(docs, keys, text, work, "n_shingles long, sum1 long, sum2 long, bands array<long>")


def set_table(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, the identity of its set, and its sorted distinct shingle hashes."""
    def work(texts: pa.Array) -> dict:
        sets, bounds = shingle_sets(texts, width)
        return {**identity_columns(sets, bounds),
                "shingles": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))}

    return map_rows(docs, [key], text, work, "n_shingles long, sum1 long, sum2 long, shingles array<long>")


def identity_columns(sets: np.ndarray, bounds: np.ndarray) -> dict:
    """Size and two sums of mixed hashes of each set."""
    total = lambda x: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])[bounds])
    return {"n_shingles": pa.array(np.diff(bounds), pa.int64()), "sum1": pa.array(total(mix(sets * K1)).view(np.int64)),
            "sum2": pa.array(total(mix(sets * K2 + K1)).view(np.int64))}


def linked(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of ``least`` percent or more."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"))
    both = both.withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("i") >= least * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b")


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows of a bucket dealt to the pairs of its chunks: bucket, ci, cj, own, id."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select("bucket", F.least("own", "other").alias("ci"), F.greatest("own", "other").alias("cj"), "own", "id")


def block_links(blocked: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b): each linked member of a block with the least id of its group there."""
    names = ["bucket", "ci", "cj", "own", "id", "shingles"]

    def work(t: pa.Table) -> pa.RecordBatch:
        key = np.stack([t.column(n).to_numpy() for n in names[:3]])
        at = np.append(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))), t.num_rows)
        ids, own = t.column(4).to_numpy(), t.column(3).to_numpy()
        col = t.column(5).combine_chunks()
        off, flat = col.offsets.to_numpy().astype(np.int64), col.values.to_numpy()
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a < 2:
                continue
            i, j = similar(flat[off[a]:off[b]], off[a:b + 1] - off[a], least)
            if key[1, a] != key[2, a]:
                cross = own[a:b][i] != own[a:b][j]
                i, j = i[cross], j[cross]
            if len(i):
                root = least_ids(ids[a:b], i, j)
                used = np.unique(np.concatenate([i, j]))
                out.append((ids[a:b][used], root[used]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64), pa.int64())
             for k in range(2)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size < 32 << 20:
                continue
            t = pa.Table.from_batches(waiting)
            key = [t.column(n).to_numpy() for n in names[:3]]
            cut = int(np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0)))[-1])
            if cut:
                yield work(t.slice(0, cut))
            waiting = [pa.Table.from_batches(t.slice(cut).to_batches()).combine_chunks().to_batches()[0]]
            size = waiting[0].nbytes
        if waiting:
            yield work(pa.Table.from_batches(waiting))

    rows = blocked.join(sets, "id").select(names)
    return (rows.repartition("bucket", "ci", "cj").sortWithinPartitions("bucket", "ci", "cj")
            .mapInArrow(run, "a long, b long").where("a <> b").distinct())


def similar(flat: np.ndarray, off: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i < j of sorted sets with a similarity of ``least`` percent or more, from exact intersections."""
    n = np.diff(off)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.argsort(flat, kind="stable")
    value, owner = flat[order], owner[order]
    same = np.zeros(len(value) + 1, bool)
    same[1:-1] = value[1:] == value[:-1]
    shared = same[:-1] | same[1:]                       # only values of two sets or more can be common
    value, owner = value[shared], owner[shared]
    column = np.cumsum(np.append(False, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    common = np.zeros((len(n), len(n)), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for k in range(0, total, 4096):
        a, b = np.searchsorted(column, [k, k + 4096])
        held = np.zeros((len(n), min(4096, total - k)), np.float32)
        held[owner[a:b], column[a:b] - k] = 1
        common += held @ held.T
    both = common.astype(np.int64)
    i, j = np.nonzero(np.triu(100 * both >= least * (n[:, None] + n[None, :] - both), 1))
    return i, j


def least_ids(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least id of each group that the pairs (i, j) connect."""
    root = ids.copy()
    while True:
        low, new = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            return root
        root = new


def near_duplicates(docs: DataFrame, width: int = 5, least: int = LEAST, key: str = "doc_id",
                    text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept, and ``group_no``, a number of the row's group.

    A null, empty or blank text has an empty set and is linked with nothing
    (its group_no is null); a row without a key likewise (its component_id is
    null and it is kept).  Repeated rows share their key and group; rows of
    one key with different texts are documents of their own, whose groups may
    differ.  ``keep`` names further columns to carry along.  An empty table
    gives an empty result.  Ties do not arise: the component is the least key.
    """
    extra = {f"keep_{i}": c for i, c in enumerate(keep or [])}
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
                       *[F.col(f"`{c}`").alias(k) for k, c in extra.items()])
    drawn = _stored(sketches(rows, width, ["id", *extra]), "sketches")
    able = drawn.where("id IS NOT NULL AND n_shingles > 0")
    identity = ["n_shingles", "sum1", "sum2"]
    # equal sets are one class with a number of its own; one of its rows stands for it
    classes = _stored(able.groupBy(identity).agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"))
                      .withColumn("cls", F.monotonically_increasing_id()), "classes")

    # one row for each class and band; buckets of one are of no use
    banded = classes.select(F.col("cls").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    buckets = _stored(banded.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count("*").alias("m"))
                      .where("m > 1").select("bucket", "pivot"), "buckets")
    members = _stored(banded.join(buckets, "bucket"), "members")

    # each member against the least one of its bucket
    pairs = _stored(members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(),
                    "pairs")
    met = classes.select(*identity, "rep", "cls").join(members.select(F.col("id").alias("cls")).distinct(), "cls", "left_semi")
    texts = rows.select("id", "text").join(met.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    sets = set_table(texts, width, "id").withColumnRenamed("id", "rep")
    sets = _stored(sets.join(met, ["rep", *identity]).dropDuplicates(["cls"]).select(F.col("cls").alias("id"), "shingles"),
                   "shingles")
    links = _stored(linked(pairs, sets, least), "links")
    groups = _stored(components(links), "groups")

    # members of one bucket that are still apart (the least one has met all others already)
    open_ = (members.where("id <> pivot").join(groups, "id", "left")
             .select("bucket", "id", "n", F.coalesce("component", "id").alias("c")))
    several = _stored(open_.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                                     F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES).alias("m"))
                      .where("lo < hi").select("bucket", F.ceil("m").cast("int").alias("chunks")), "open-buckets")
    more = _stored(block_links(_blocked(open_.join(several, "bucket").select("bucket", "id", "chunks")), sets, least),
                   "links")
    tables = [buckets, members, pairs, sets, links, groups, several, more]
    if more.limit(1).count():
        groups = _stored(components(links.unionByName(more)), "groups")
        tables.append(groups)

    # the least key of each group, at every class of it
    grouped = classes.select("cls", "rep").join(groups.withColumnRenamed("id", "cls"), "cls", "left").withColumn(
        "group_no", F.coalesce("component", "cls"))
    least_key = grouped.groupBy("group_no").agg(F.min("rep").alias("component_id"))
    known = _stored(classes.select(*identity, "cls").join(grouped.select("cls", "group_no").join(least_key, "group_no"), "cls")
                    .drop("cls"), "class-groups")
    discard(classes, *tables)
    found = drawn.join(known, identity, "left")
    own = F.col("id").isNotNull()
    component = F.when(own, F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
                        F.when(own, F.col("group_no")).alias("group_no"),
                        *[F.col(k).alias(c) for k, c in extra.items()])
