"""Operator 10: near duplicates of vectors by random hyperplanes, exact cosines and components.

Vectors meet when all sign bits of one table agree.  Every pair that meets is
checked by its exact cosine, in blocks of a bucket; a pair that meets in
several tables counts in the first of them only, which both can tell from
their codes.  So the links of each vector are added up without a list of
pairs.  Equal vectors are one class and take part once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.components import _stored, components, discard
from shopcube.llm.minhash import least_ids
from shopcube.llm.shingles import K1, K2, mix

COSINE = 0.93
MISSED = 1e-5            # probability that a pair at the threshold meets in no table
CHUNK = 1024             # vectors of a bucket in one block


def tables_for(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """(sign bits, tables) for ``n`` vectors: buckets keep about their size, pairs their chance to meet."""
    bits = min(32, max(6, int(math.log2(max(n, 1) / 64)) if n > 64 else 6))      # codes have 32 bits: up to 2**38 vectors
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log1p(-meet))


def vectors(table: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Per row: id, label, dim, two hashes of the vector, its bytes (null where it links with nothing)."""
    kind = table.schema[vector].dataType.elementType
    small = isinstance(kind, T.FloatType)
    array = F.col(f"`{vector}`") if small else F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
                        array.alias("v"))
    form = np.float32 if small else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, h1, h2, raw = [], [], [], []
            labelled = b.column(1).is_valid().to_pylist()
            known = b.column(0).is_valid().to_pylist()
            for i, v in enumerate(b.column(2)):
                x = None
                if v.is_valid and labelled[i] and known[i] and v.values.null_count == 0:
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), form) + form(0)    # -0 becomes 0
                    if not len(x) or not np.isfinite(x).all() or not x.any():
                        x = None
                if x is None:
                    dims.append(None), h1.append(None), h2.append(None), raw.append(None)
                    continue
                one = x.tobytes()
                h = xxhash.xxh3_128_digest(one)
                dims.append(len(x)), raw.append(one)
                h1.append(int.from_bytes(h[:8], "little", signed=True))
                h2.append(int.from_bytes(h[8:], "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(dims, pa.int32()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.array(raw, pa.binary())], names=["id", "label", "dim", "h1", "h2", "raw"])

    return rows.mapInArrow(run, "id long, label string, dim int, h1 long, h2 long, raw binary")


def unit_rows(raw: pa.Array, dim: int, form) -> np.ndarray:
    """The vectors as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(raw.to_pylist()), form).reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Sign code of each vector in each table."""
    planes = np.random.default_rng(x.shape[1]).standard_normal((x.shape[1], tables * bits))
    sign = (x @ planes >= 0).reshape(len(x), tables, bits)
    return (sign * (1 << np.arange(bits))).sum(axis=2).astype(np.uint32)


def bucket_rows(reps: DataFrame, bits: int, tables: int, form) -> DataFrame:
    """One row for each vector and table: bucket, table, id, m, dim, raw, code (all codes of the vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == dim))
                for at in range(0, part.num_rows, 512):
                    rows = part.slice(at, 512)
                    c = codes(unit_rows(rows.column(4), dim, form), bits, tables)
                    label = np.array([xxhash.xxh3_64_intdigest(f"{dim}/{s}") for s in rows.column(1).to_pylist()],
                                     np.uint64)
                    blob = pa.array([r.tobytes() for r in c], pa.binary())
                    for t in range(tables):
                        h = mix(label * K1 + c[:, t].astype(np.uint64) * K2 + np.uint64(t))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h.view(np.int64)), pa.array(np.full(len(c), t, np.int32)), rows.column(0),
                             rows.column(2), rows.column(3), rows.column(4), blob],
                            names=["bucket", "t", "id", "m", "dim", "raw", "code"])

    return reps.select("id", "label", "m", "dim", "raw").mapInArrow(
        run, "bucket long, t int, id long, m long, dim int, raw binary, code binary")


def segment_links(ids, m, x, c, t: int, side, cosine: float):
    """Links inside one block: (id, links counted here, least id of its group) of the vectors that have any.

    ``side`` is None for all pairs, or tells the two sides of which only
    cross pairs are looked at.
    """
    cos = x @ x.T
    hit = np.triu(cos >= cosine, 1) if side is None else (cos >= cosine) & (~side[:, None] & side[None, :])
    i, j = np.nonzero(hit)
    if not len(i):
        return None
    fresh = ~(c[i, :t] == c[j, :t]).any(axis=1) if t else np.ones(len(i), bool)
    links = np.bincount(i[fresh], m[j[fresh]], len(ids)) + np.bincount(j[fresh], m[i[fresh]], len(ids))
    root = least_ids(ids, i, j)
    used = np.unique(np.concatenate([i, j]))
    return ids[used], links[used].astype(np.int64), root[used]


def block_links(blocked: DataFrame, form, cosine: float) -> DataFrame:
    """(id, links, root) from rows sorted by (bucket, ci, cj)."""
    def work(t: pa.Table):
        col = {n: t.column(n).combine_chunks() for n in t.column_names}
        key = np.stack([col[n].to_numpy() for n in ("bucket", "ci", "cj")])
        new = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
        at = np.append(np.flatnonzero(new), t.num_rows)
        ids, m, dim, tab = (col[n].to_numpy() for n in ("id", "m", "dim", "t"))
        own = col["own"].to_numpy()
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a < 2:
                continue
            x = unit_rows(col["raw"].slice(a, b - a), int(dim[a]), form)
            c = np.frombuffer(b"".join(col["code"].slice(a, b - a).to_pylist()), np.uint32).reshape(b - a, -1)
            side = None if key[1, a] == key[2, a] else own[a:b] == key[2, a]
            got = segment_links(ids[a:b], m[a:b], x, c, int(tab[a]), side, cosine)
            if got is not None:
                out.append(got)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64), pa.int64()) for k in range(3)],
            names=["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for b in batches:
            waiting.append(b)
            rows += b.num_rows
            if rows < 8 * CHUNK:
                continue
            t = pa.Table.from_batches(waiting)
            key = [t.column(n).to_numpy() for n in ("bucket", "ci", "cj")]
            new = np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0))
            cut = int(np.flatnonzero(new)[-1])                 # the last block may go on
            if cut:
                yield work(t.slice(0, cut))
            waiting, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if rows:
            yield work(pa.Table.from_batches(waiting))

    cols = ["bucket", "ci", "cj", "own", "t", "id", "m", "dim", "raw", "code"]
    return (blocked.select(cols).repartition("bucket", "ci", "cj").sortWithinPartitions("bucket", "ci", "cj", "id")
            .mapInArrow(run, "id long, links long, root long"))


def near_vectors(table: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label") -> DataFrame:
    """Per row: key, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null, and their
    lengths are equal.  A vector that is null, empty or zero, or holds a null
    or non-finite component, links with nothing, as does one without label
    or key.  Repeated rows are vectors of their own that share their key.
    An empty table gives an empty result.
    """
    form = np.float32 if isinstance(table.schema[vector].dataType.elementType, T.FloatType) else np.float64
    drawn = _stored(vectors(table, key, vector, label), "vectors")
    able = drawn.where("dim IS NOT NULL")
    same = ["label", "dim", "h1", "h2"]
    classes = _stored(able.groupBy(same).agg(F.min("id").alias("rep"), F.count("*").alias("m")), "vector-classes")
    bits, tables = tables_for(classes.count(), cosine)
    picked = classes.select(*same, F.col("rep").alias("id"), "m")
    reps = _stored(able.join(picked, [*same, "id"]).dropDuplicates([*same, "id"])
                   .select("id", "label", "m", "dim", "raw").repartition("id"), "vector-reps")

    # blocks of at most about CHUNK vectors; a large bucket is every pair of its chunks
    rows = bucket_rows(reps, bits, tables, form)
    chunks = _stored(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
                     .select("bucket", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")), "vector-buckets")
    rows = rows.join(chunks, "bucket").withColumn("own", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocked = rows.withColumn("ci", F.least("own", "other")).withColumn("cj", F.greatest("own", "other"))
    found = _stored(block_links(blocked, form, cosine), "vector-links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    of_rep = _stored(links.join(groups, "id", "left").withColumnRenamed("id", "rep"), "vector-groups")
    discard(reps, chunks, found)
    out = drawn.select("id", *same).join(classes, same, "left").join(of_rep, "rep", "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "rep", "id"))
    return out.select(
        F.col("id").alias(key),
        F.coalesce(F.col("m") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
