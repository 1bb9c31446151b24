"""Token counts, BPE codec, token files and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shopcube.llm.registry import tokenizer_path
from tests.conftest import SF001

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_words_and_trie_equal_the_library_on_random_text():
    from shopcube.llm.bpe_codec import decode_batch, encode_batch
    r = random.Random(5)
    bits = ["'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "'", " '", "<|endoftext|>", "<|end", "1", "é", "ing", "!",
            "　", " ", "😀", "中文", "the", "'ve", "²", "\x85"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(4000)]
    for by_library in (False, True):
        ids, bounds = encode_batch(pa.array(texts), PATH, by_library)
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == ids_of(t), repr(t)
    assert decode_batch(ids, bounds, PATH) == texts


def test_every_prefix_count_is_exact():
    from shopcube.llm.bpe import merges
    from shopcube.llm.token_counts import count_prefixes
    r = random.Random(6)
    bits = ["'s", "'re", " ", "  ", "\n", "a", "'", "<|endoftext|>", "1", "é", "don't they're", "!", "　"]
    for _ in range(200):
        t = "".join(r.choice(bits) for _ in range(r.randrange(9)))
        want = [len(ids_of(t[:p])) for p in range(len(t) + 1)]
        assert count_prefixes(t, merges(PATH)) == want, repr(t)


def test_token_counts(edge_docs, no_docs):
    from shopcube.llm.token_counts import token_counts
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(edge_docs, PATH).collect())
    want = Counter((r.doc_id, len((r.text or "").encode()), len(ids_of(r.text)), len(ids_of(r.text)) > 512)
                   for r in edge_docs.collect())
    assert got == want
    assert token_counts(no_docs, PATH).count() == 0


def test_prefix_counts_of_a_table(edge_docs, no_docs):
    from shopcube.llm.token_counts import prefix_counts
    short = "text IS NULL OR length(text) < 200"
    got = Counter((r.doc_id, tuple(r.counts)) for r in prefix_counts(edge_docs.where(short), PATH).collect())
    want = Counter((r.doc_id, tuple(len(ids_of((r.text or "")[:p])) for p in range(len(r.text or "") + 1)))
                   for r in edge_docs.where(short).collect())
    assert got == want
    assert prefix_counts(no_docs, PATH).count() == 0


def test_cut_bytes_is_the_truncation(edge_docs):
    from shopcube.llm.token_counts import token_counts
    texts = {r.doc_id: r.text for r in edge_docs.where("doc_id IN (8, 9, 11, 12)").collect()}
    for r in token_counts(edge_docs.where("doc_id IN (8, 9, 11, 12)"), PATH, limit=40).collect():
        kept = LIBRARY.decode(ids_of(texts[r.doc_id])[:40])
        assert r.cut_bytes == len(kept.encode())


def test_codec(edge_docs, no_docs):
    from shopcube.llm.bpe_codec import codec_digests, decode, encode
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = Counter(map(tuple, codec_digests(edge_docs, PATH).collect()))
    want = Counter()
    for r in edge_docs.collect():
        ids = ids_of(r.text)
        want[r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()),
             sha(LIBRARY.decode(ids, skip_special_tokens=False).encode())] += 1
    assert got == want
    assert codec_digests(no_docs, PATH).count() == 0
    back = decode(encode(edge_docs.where("doc_id <> 1"), PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {
        r.doc_id: r.text or "" for r in edge_docs.where("doc_id <> 1").collect()}


@pytest.mark.parametrize("counts", [[0, 5, 0, 1], [7], [1] * 300, [2 ** k for k in range(40)], [0, 0, 3, 3]])
def test_huffman_round_trip(counts):
    from shopcube.llm.huffman import MAX_BITS, canonical_codes, code_lengths, decoding_table, pack, unpack
    counts = np.array(counts, np.int64)
    lengths = code_lengths(counts)
    used = np.flatnonzero(counts)
    assert lengths.max() <= MAX_BITS and (lengths[used] > 0).all()
    assert sum(2.0 ** -int(b) for b in lengths[used]) <= 1
    ids = np.random.default_rng(1).choice(used, 3000).astype(np.int32)
    stream, marks = pack(ids, lengths, canonical_codes(lengths))
    assert (unpack(stream, marks, len(ids), decoding_table(lengths)) == ids).all()


def test_code_lengths_are_optimal_without_a_limit():
    import heapq
    from shopcube.llm.huffman import code_lengths
    counts = np.random.default_rng(2).integers(1, 1000, 200)
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert int((code_lengths(counts) * counts).sum()) == cost


def test_token_files(spark, edge_docs, no_docs, tmp_path):
    from shopcube.llm.token_files import read_digests, read_token_files, write_token_files
    docs = edge_docs.dropDuplicates(["doc_id"])
    folder = f"file://{tmp_path}/files"
    write_token_files(docs, PATH, folder)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got, start = {r.doc_id: r for r in read_digests(spark, folder).collect()}, 0
    assert set(got) == set(texts)
    for k in sorted(texts, key=lambda k: (k is not None, k)):
        ids = np.array([*ids_of(texts[k]), 0], np.uint32)
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: r.ids for r in read_token_files(spark, folder).collect()} == {
        k: [*ids_of(t), 0] for k, t in texts.items()}
    write_token_files(no_docs, PATH, f"file://{tmp_path}/none")
    assert read_digests(spark, f"file://{tmp_path}/none").count() == 0


def check_packing(docs, rows):
    ids = defaultdict(list)
    for r in docs:
        ids[r.doc_id].append(np.array([*ids_of(r.text), 1], np.uint32))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][0]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        pieces[r.doc_id].extend(range(r.start, r.start + r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for k, texts in ids.items():
        assert sorted(pieces[k]) == sorted(list(range(len(texts[0]))) * len(texts))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 2048 - at if at & (at - 1) else 0
    return padding / total


def test_packing(spark, edge_docs, no_docs):
    from shopcube.llm.packing import pack_documents
    check_packing(edge_docs.collect(), pack_documents(edge_docs, PATH).collect())
    assert pack_documents(no_docs, PATH).count() == 0
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert check_packing(docs.collect(), pack_documents(docs, PATH).collect()) < 0.01


def test_column_generation_reaches_the_bound():
    from shopcube.llm.packing import GAP, Plan, patterns
    sizes, demand = np.array([3, 4, 5, 7]), np.array([90, 60, 80, 40])
    columns, x = patterns(sizes, demand.astype(float), 10)
    assert ((columns * sizes[:, None]).sum(axis=0) <= 10).all()
    assert (columns @ x >= demand - 1e-6).all()
    assert x.sum() <= (demand * sizes).sum() / 10 * (1 + GAP) * 1.12
    plan = Plan(dict(zip(sizes.tolist(), demand.tolist())), 10)
    filled = defaultdict(list)
    for c, n in zip(sizes.tolist(), demand.tolist()):
        seq, slot = plan.place(c, np.arange(n))
        assert (seq < 0).sum() == plan.leftover.get(c, 0)
        for q, s in zip(seq[seq >= 0].tolist(), slot[seq >= 0].tolist()):
            filled[q].append((s, c))
    assert all(sum(c for _, c in v) <= 10 and len({s for s, _ in v}) == len(v) for v in filled.values())
