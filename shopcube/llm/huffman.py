"""Canonical length-limited Huffman codes over token ids, with numpy."""

from __future__ import annotations

import numpy as np

MAX_BITS = 18            # longest code; the decoding table has 2**18 entries
STRIDE = 512             # ids between two checkpoints


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (0 for ids that never occur).

    Package-merge: the leaves taken at each level are the lightest ones, so
    a count per level gives every length.
    """
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} ids have no code of {limit} bits")
    if n <= 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    levels = []                                  # for each level: which merged items are leaves
    packages = np.zeros(0)
    for _ in range(limit):
        weight = np.concatenate([leaf, packages])
        is_leaf = np.concatenate([np.ones(n, bool), np.zeros(len(packages), bool)])
        by = np.argsort(weight, kind="stable")
        weight, is_leaf = weight[by], is_leaf[by]
        levels.append(is_leaf)
        even = len(weight) // 2 * 2
        packages = weight[:even:2] + weight[1:even:2]
    take, lengths = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of each id: shorter codes first, then by id."""
    codes = np.zeros(len(lengths), np.uint32)
    code, bits = 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[i]) - bits
        bits = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """For every ``limit``-bit window: id << 5 | code length."""
    table = np.zeros(1 << limit, np.int32)
    codes = canonical_codes(lengths).astype(np.int64)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    span = 1 << (limit - lengths[used].astype(np.int64))
    filled = np.repeat((used << 5) | lengths[used], span)
    first = int(codes[used[0]]) << (limit - int(lengths[used[0]])) if len(used) else 0
    table[first:first + len(filled)] = filled
    return table


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bit stream, bit offset of every ``STRIDE``-th id)."""
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    at = end - n
    total = int(end[-1]) if len(end) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    if len(ids):
        code, word = codes[ids].astype(np.uint64), at >> 6
        room = 64 - (at & 63) - n                       # free bits after the code; negative: it goes on
        head = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64),
                        code >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[first]] = np.add.reduceat(head, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[:(total + 7) // 8], at[::STRIDE].copy()


def unpack(stream: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray,
           limit: int = MAX_BITS) -> np.ndarray:
    """The ``n`` ids of a stream; the spans between checkpoints are decoded side by side."""
    if not n:
        return np.zeros(0, np.int32)
    raw = np.frombuffer(stream + bytes(STRIDE * limit // 8 + 8), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    pos = checkpoints.astype(np.int64).copy()
    out = np.empty((STRIDE, len(pos)), np.int32)
    shift = np.uint32(32 - limit)
    for k in range(min(STRIDE, n)):
        got = table[(window[pos >> 3] << (pos & 7).astype(np.uint32)) >> shift]
        out[k] = got >> 5
        pos += got & 31
    return out.T.reshape(-1)[:n]
