"""Operator 6: BPE encoding and decoding by a prefix-sharing trie.

The distinct words of a batch of texts go into a trie in sorted order.  A
depth-first walk hands the last-token states of every node down to its
children, so prefixes that words share are encoded once; a word's ids are
read back from its states.  Decoding maps ids to their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopcube.llm.batches import map_rows
from shopcube.llm.bpe import merges
from shopcube.llm.words import Words, ragged, text_buffers


def encode_batch(texts: pa.Array, path: str, by_library: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, bounds of each text's ids)."""
    m = merges(path)
    w = Words(texts, m.special)
    flat, n = (m.encode_words_by_library if by_library else m.encode_words)(w.distinct)
    first = np.concatenate([[0], np.cumsum(n)])[:-1] if len(n) else np.zeros(0, np.int64)
    lengths = n[w.ids]
    ids = ragged(flat, first[w.ids], lengths)
    running = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return ids, running[w.bounds]


_tables: dict = {}


def _table(path: str, kind: str) -> pa.Array:
    if (path, kind) not in _tables:
        known = merges(path).bytes_of
        _tables[path, kind] = pa.array([b"%d," % i for i in range(len(known))] if kind == "decimal" else known,
                                       pa.large_binary())
    return _tables[path, kind]


def _laid_out(ids: np.ndarray, table: pa.Array) -> tuple[memoryview, np.ndarray]:
    taken = table.take(pa.array(ids, pa.int32()))
    data, off = text_buffers(taken)
    return memoryview(data), off


def decode_batch(ids: np.ndarray, bounds: np.ndarray, path: str) -> list[str]:
    """The text of each id sequence; bytes that are no UTF-8 become U+FFFD."""
    data, off = _laid_out(ids, _table(path, "bytes"))
    at = off[bounds].tolist()
    return [str(data[a:b], "utf-8", "replace") for a, b in zip(at[:-1], at[1:])]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``ids`` (array<int>).  A null text counts as empty: no ids."""
    def work(texts: pa.Array) -> dict:
        ids, bounds = encode_batch(texts, path)
        return {"ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))}

    return map_rows(docs, [key], text, work, "ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key and ``text``, the decoded ids.  A null list counts as empty, a null id as none."""
    fields = encoded.select(key).schema.fields

    def run(batches):
        for b in batches:
            col = b.column(1)
            rows = [[i for i in (x or []) if i is not None] for x in col.to_pylist()]
            flat = np.array([i for x in rows for i in x], np.int32)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(decode_batch(flat, bounds, path), pa.string())],
                                             names=[key, "text"])

    from pyspark.sql import types as T
    return encoded.select(key, ids).mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType())]))


def codec_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256.

    Every text is encoded, and its ids are decoded again.  Null texts count
    as empty (0 tokens, digests of the empty string); repeated rows give
    repeated results; an empty table gives an empty result.
    """
    def work(texts: pa.Array) -> dict:
        ids, bounds = encode_batch(texts, path)
        data, off = _laid_out(ids, _table(path, "decimal"))
        at = off[bounds].tolist()
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return {"n_tokens": pa.array(np.diff(bounds), pa.int64()),
                "ids_sha256": pa.array([sha(data[a:max(a, b - 1)]) for a, b in zip(at[:-1], at[1:])], pa.string()),
                "decoded_sha256": pa.array([sha(t.encode()) for t in decode_batch(ids, bounds, path)], pa.string())}

    return map_rows(docs, [key], text, work, "n_tokens long, ids_sha256 string, decoded_sha256 string")
