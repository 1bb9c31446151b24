"""Operator 7: token ids in Huffman-coded files.

File format: a folder with two Parquet tables.  ``codes`` has the code
length of every id (from counts over all documents; canonical codes, so the
lengths say all).  ``blocks`` has independent blocks: the file part and the
ids before the block in it, the documents of the block with their id counts,
the bit stream, and the bit offset of every 512th id, from which decoding can
start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcube.llm.bpe import merges
from shopcube.llm.bpe_codec import encode_batch
from shopcube.llm.components import discard
from shopcube.llm.huffman import MAX_BITS, canonical_codes, code_lengths, decoding_table, pack, unpack
from shopcube.llm.words import chunks
from shopcube.session import scratch_path

END_ID = 0
ID = np.uint16           # staged ids


def id_counts(staged: DataFrame) -> DataFrame:
    """(id, n) over all staged ids; at most one row per vocabulary entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                n = np.bincount(np.frombuffer(raw.as_buffer(), ID), minlength=len(total))
                n[:len(total)] += total
                total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
                                         names=["id", "n"])

    return staged.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def stage_ids(docs: DataFrame, path: str, end_id: int, key: str, text: str) -> DataFrame:
    """The ids of all texts in key order, one row for each block to be."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                ids, bounds = encode_batch(texts, path, by_library=True)
                n = np.diff(bounds) + 1
                ids = np.insert(ids, bounds[1:], end_id)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([before], pa.int64()),
                    pa.array([batch.column(0).slice(at, len(texts)).to_pylist()], pa.list_(pa.int64())),
                    pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                    pa.array([ids.astype(ID).tobytes()], pa.binary())],
                    names=["part", "part_start", "doc_ids", "doc_tokens", "n_ids", "ids"])
                before += len(ids)

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.repartitionByRange("k").sortWithinPartitions("k").mapInArrow(run, STAGED_SCHEMA)


STAGED_SCHEMA = "part int, part_start long, doc_ids array<long>, doc_tokens array<long>, n_ids long, ids binary"
BLOCK_SCHEMA = ("part int, part_start long, doc_ids array<long>, doc_tokens array<long>, n_ids long, "
                "stream binary, checkpoints array<long>")


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = END_ID,
                      key: str = "doc_id", text: str = "text") -> None:
    """Encode all texts, each followed by ``end_id``, in ascending ``key`` order into ``folder``.

    Null texts count as empty (the end id alone); a null key comes first;
    rows with equal keys stand side by side; an empty table gives files
    without blocks.
    """
    spark = docs.sparkSession
    size = merges(path).size
    if size > 1 << 16:
        raise ValueError("ids are staged in 16 bits")
    staged = scratch_path(spark, "token-ids")
    stage_ids(docs, path, end_id, key, text).write.option("compression", "zstd").parquet(staged)
    rows = spark.read.schema(STAGED_SCHEMA).parquet(staged)
    rows.stored_at = staged
    counts = np.zeros(size, np.int64)
    for r in id_counts(rows).toLocalIterator():           # bounded by the vocabulary
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    spark.createDataFrame(
        pa.table({"id": pa.array(np.arange(size), pa.int32()), "bits": pa.array(lengths, pa.int32())})
    ).coalesce(1).write.parquet(f"{folder}/codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(5)[i].as_buffer(), ID)
                stream, marks = pack(ids, lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, 1) for k in range(5)), pa.array([stream], pa.binary()),
                     pa.array([marks.tolist()], pa.list_(pa.int64()))],
                    names=["part", "part_start", "doc_ids", "doc_tokens", "n_ids", "stream", "checkpoints"])

    rows.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{folder}/blocks")
    discard(rows)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Decode ``folder`` again.  Per document: doc_id, start (ids of all documents before it), ids."""
    return _read(spark, folder, "ids array<int>",
                 lambda ids, a, b: ids[a:b].tolist(), pa.list_(pa.int32()))


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_token_files``, with n_tokens and ids_crc32 in place of the ids."""
    return _read(spark, folder, "ids_crc32 long", lambda ids, a, b: zlib.crc32(ids[a:b]), pa.int64())


def _read(spark: SparkSession, folder: str, column: str, of, kind: pa.DataType) -> DataFrame:
    codes = spark.read.parquet(f"{folder}/codes")
    lengths = np.zeros(codes.count(), np.uint8)
    for r in codes.toLocalIterator():                                    # bounded by the vocabulary
        lengths[r.id] = r.bits
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    # ids before each part: one number for each part that the writer had
    before, total = {}, 0
    for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toLocalIterator():
        before[r.part] = total
        total += r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths) if lengths.any() else None
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                ids = unpack(cols["stream"][i].as_py(), np.array(cols["checkpoints"][i].values),
                             cols["n_ids"][i].as_py(), table)
                n = np.array(cols["doc_tokens"][i].values)
                ends = np.cumsum(n)
                start = before[cols["part"][i].as_py()] + cols["part_start"][i].as_py()
                got = [of(ids, a, b) for a, b in zip((ends - n).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [cols["doc_ids"][i].values, pa.array(start + ends - n, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(got, kind)],
                    names=["doc_id", "start", "n_tokens", column.split()[0]])

    return blocks.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")
