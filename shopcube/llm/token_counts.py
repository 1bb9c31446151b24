"""Operator 1: token counts by prefix dynamic programming.

For every prefix of a distinct word the last token of its encoding and the
exact token count are kept: ``count[i] = count[i - len(last[i])] + 1``
(``bpe.Merges.prefix_counts``).  Counts of a text are sums over its words,
and the stored counts answer where a budget of tokens cuts a text without
encoding it again.  ``prefix_counts`` returns the count of every prefix of a
text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopcube.llm.batches import map_rows
from shopcube.llm.bpe import Merges, merges
from shopcube.llm.words import Words

LIMIT = 512


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_tokens, over_limit, cut_bytes.

    ``cut_bytes`` is the number of bytes that the first ``limit`` tokens
    cover (all bytes when the text has no more tokens).  A null text counts
    as empty: 0 bytes, 0 tokens.  Repeated rows give repeated results, an
    empty table an empty result; texts of any length are read whole.
    """
    def work(texts: pa.Array) -> dict:
        m = merges(path)
        w = Words(texts, m.special)
        counts, size = m.prefix_counts(w.distinct)
        return count_columns(w, counts, size, limit)

    return map_rows(docs, [key], text, work,
                    "n_bytes long, n_tokens long, over_limit boolean, cut_bytes long")


def count_columns(w: Words, counts: np.ndarray, size: np.ndarray, limit: int) -> dict:
    """``counts``: the prefix counts of all distinct words, ``size`` of each; negative where a token of the word ends."""
    n_bytes = np.diff(w.offsets)
    first = np.concatenate([[0], np.cumsum(size)])
    n = np.abs(counts[first[1:] - 1]).astype(np.int64) if len(size) else np.zeros(0, np.int64)     # whole words
    running = np.concatenate([[0], np.cumsum(n[w.ids], dtype=np.int64)])   # tokens before each word
    n_tokens = running[w.bounds[1:]] - running[w.bounds[:-1]]
    cut = n_bytes.copy()
    for i in np.flatnonzero(n_tokens > limit).tolist():
        goal = running[w.bounds[i]] + limit                    # tokens up to the cut
        at = int(np.searchsorted(running, goal, "left")) - 1   # word in which the last kept token ends
        word = w.ids[at]
        inside = counts[first[word]:first[word + 1]]
        cut[i] = w.starts[at] + int(np.flatnonzero(inside == running[at] - goal)[0]) - w.offsets[i]
    return {"n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
            "over_limit": pa.array(n_tokens > limit), "cut_bytes": pa.array(cut, pa.int64())}


def prefix_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``counts``, the exact token count of every prefix of the text.

    ``counts[p]`` is the number of tokens of the first ``p`` characters
    encoded alone, for p = 0 .. length.  A null text counts as empty: [0].
    """
    def work(texts: pa.Array) -> dict:
        m = merges(path)
        return {"counts": pa.array([count_prefixes(t or "", m) for t in texts.to_pylist()],
                                   pa.list_(pa.int32()))}

    return map_rows(docs, [key], text, work, "counts array<int>")


def count_prefixes(text: str, m: Merges) -> list[int]:
    """Token count of each prefix ``text[:p]``.

    Inside a word the prefix counts of its dynamic program hold.  Where the
    end of the prefix changes how the words before it are split -- a run of
    white space, a cut contraction, a cut special string -- the changed word
    gets a program of its own.
    """
    w = Words(pa.array([text]), m.special)
    raw = text.encode()
    starts = [*w.starts.tolist(), len(raw)]
    words = w.distinct.to_pylist()
    flat, size = m.prefix_counts(w.distinct)
    progs = [p.tolist() for p in np.split(np.abs(flat), np.cumsum(size)[:-1])] if words else []
    out, before, k = [0], 0, 0
    run_start = run_before = 0      # white-space run that ends here, and the tokens before it
    q = 0
    for ch in text:
        if q == starts[k + 1]:
            before += progs[w.ids[k]][-1]
            k += 1
        was_space = q > 0 and text[len(out) - 2].isspace() and _is_space(text[len(out) - 2])
        if _is_space(ch) and not (was_space and run_start >= 0):
            run_start, run_before = q, before
        q += len(ch.encode())
        word, s = words[w.ids[k]], starts[k]
        if word == m.special and q < starts[k + 1]:
            out.append(_count_split(raw[:q], m))
        elif _is_space(ch) and run_start < s:
            out.append(run_before + _program(raw[run_start:q], m)[-1])
        elif word in (b"'re", b"'ve", b"'ll") and q - s == 2:
            out.append(before + 2)
        else:
            out.append(before + progs[w.ids[k]][q - s])
    return out


def _is_space(ch: str) -> bool:
    from shopcube.llm.words import SPACE, class_table
    return class_table()[ord(ch)] == SPACE


def _program(word: bytes, m: Merges) -> list[int]:
    if word == m.special:
        return [0] + [1] * len(word)
    last = [-1]
    m.extend(word, last, len(word))
    counts = [0]
    for i in range(1, len(last)):
        counts.append(counts[i - len(m.bytes_of[last[i]])] + 1)
    return counts


def _count_split(raw: bytes, m: Merges) -> int:
    w = Words(pa.array([raw.decode()]), m.special)
    progs = [_program(x, m)[-1] for x in w.distinct.to_pylist()]
    return sum(progs[i] for i in w.ids.tolist())
