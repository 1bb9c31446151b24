"""Byte-level BPE by last-token states.

The encoding of a byte string ``w`` is fixed by one token per prefix: the
*last* token of the encoding of ``w[:i]``.  A token ``t`` that ends at ``i``
is that last token exactly if it and the last token of the prefix before it
stay apart when their bytes are merged (``Merges.apart``); one such token
exists for every prefix.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa


KEPT_WORDS = 600_000           # encodings a Python worker keeps between batches
KEPT_BYTES = 256               # of words up to this length


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in set(shown)):
        table[chr(256 + k)] = b
    return table


class Merges:
    """Vocabulary and merge order of a byte-level BPE file."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        back = byte_alphabet()
        raw = lambda s: bytes(back[c] for c in s)
        model = spec["model"]
        special = [(a["content"], a["id"]) for a in spec.get("added_tokens", []) if a.get("special")]
        self.special = special[0][0].encode() if special else None
        self.special_id = special[0][1] if special else None
        names = {s for s, _ in special}
        self.size = max(max(model["vocab"].values()), *(i for _, i in special), 0) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for s, i in model["vocab"].items():
            self.bytes_of[i] = s.encode() if s in names else raw(s)
        for s, i in special:
            self.bytes_of[i] = s.encode()
        self.id_of = {b: i for i, b in enumerate(self.bytes_of) if i != self.special_id and b}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = (pair.split(" ") if isinstance(pair, str) else pair)
            ia, ib = self.id_of[raw(a)], self.id_of[raw(b)]
            made = self.id_of[raw(a) + raw(b)]
            self.rank[ia, ib] = k
            self.parts.setdefault(made, (ia, ib, k))
        self.longest = max(map(len, self.id_of))
        self._apart: dict[int, bool] = {}

    def apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of the two tokens gives these two tokens again."""
        key = left * self.size + right
        known = self._apart.get(key)
        if known is None:
            known = self._apart[key] = self._stay(left, right)
            if len(self._apart) > 4_000_000:
                self._apart.clear()
        return known

    def _stay(self, left: int, right: int) -> bool:
        # how the tokens beside the border grow: right edge of `left`, left edge of `right`
        grow_l, grow_r, never = [(left, -1)], [(right, -1)], len(self.rank) + 1
        while (p := self.parts.get(grow_l[-1][0])) is not None:
            grow_l.append((p[1], p[2]))
        while (p := self.parts.get(grow_r[-1][0])) is not None:
            grow_r.append((p[0], p[2]))
        i, j = len(grow_l) - 1, len(grow_r) - 1
        while True:
            step_l = grow_l[i][1] if i else never
            step_r = grow_r[j][1] if j else never
            cross = self.rank.get((grow_l[i][0], grow_r[j][0]), never)
            if cross < step_l and cross <= step_r and cross < never:
                return False
            if not i and not j:
                return True
            if step_l <= step_r:      # of equal merges the left one comes first
                i -= 1
            else:
                j -= 1

    def extend(self, word: bytes, last: list[int], upto: int) -> None:
        """Append the last-token state of each further prefix of ``word`` up to ``upto`` bytes."""
        get, apart, longest = self.id_of.get, self.apart, self.longest
        memo, size = self._apart.get, self.size
        for i in range(len(last), upto + 1):
            for j in range(max(0, i - longest), i):
                t = get(word[j:i])
                if t is not None:
                    if not j:
                        break
                    ok = memo(last[j] * size + t)
                    if ok or (ok is None and apart(last[j], t)):
                        break
            last.append(t)

    def walk(self, words: list[bytes]):
        """Depth-first pass through the trie of the words.

        Sorted words come in depth-first order; the states on the path to
        the branching node are kept, so every shared prefix is worked out
        once.  Yields (index of the word, its last-token states).
        """
        order = sorted(range(len(words)), key=words.__getitem__)
        prev, last = b"", [-1]
        for k in order:
            w = words[k]
            n, m = 0, min(len(prev), len(w))
            if w[:m] == prev[:m]:
                n = m
            else:
                while w[n] == prev[n]:
                    n += 1
            del last[n + 1:]
            if w == self.special:
                yield k, None
                prev, last = b"", [-1]
                continue
            self.extend(w, last, len(w))
            yield k, last
            prev = w

    def remember(self, cache: dict, words: list[bytes], missing: list[bytes]) -> None:
        """Put the encodings of ``missing`` into ``cache`` by the trie walk."""
        size = [len(b) for b in self.bytes_of]
        for k, last in self.walk(missing):
            if last is None:
                cache[missing[k]] = array("i", [self.special_id]).tobytes()
                continue
            i, out = len(last) - 1, []
            while i:
                out.append(last[i])
                i -= size[last[i]]
            out.reverse()
            cache[missing[k]] = array("i", out).tobytes()

    def encode_words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each word), by the trie."""
        return self._through_cache(distinct, self.__dict__.setdefault("_walked", {}), self.remember)

    def encode_words_by_library(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same ids from the compiled merge loop of the tiktoken library."""
        return self._through_cache(distinct, self.__dict__.setdefault("_merged", {}), self._remember_by_library)

    def _remember_by_library(self, cache: dict, words: list[bytes], missing: list[bytes]) -> None:
        enc = self.__dict__.get("_library")
        if enc is None:
            import tiktoken
            ranks = {b: i for i, b in enumerate(self.bytes_of) if b and i != self.special_id}
            enc = self._library = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks,
                                                    special_tokens={})
        for w in missing:
            ids = [self.special_id] if w == self.special else enc.encode_ordinary(w.decode())
            cache[w] = array("i", ids).tobytes()

    def prefix_counts(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(token counts of all prefixes of all words one after the other, bytes + 1 of each word).

        ``count[i] = count[i - len(last[i])] + 1``, filled along the trie walk,
        so a shared prefix is counted once.  The counts of prefixes that end
        with a token of the whole word are negative.
        """
        return self._through_cache(distinct, self.__dict__.setdefault("_counts", {}), self._remember_counts)

    def _remember_counts(self, cache: dict, words: list[bytes], missing: list[bytes]) -> None:
        size = self.__dict__.get("_sizes")
        if size is None:
            size = self._sizes = [len(b) for b in self.bytes_of]
        count, before = [0], b""
        for k, last in self.walk(missing):
            word = missing[k]
            if last is None:
                cache[word] = array("i", [0] + [1] * (len(word) - 1) + [-1]).tobytes()
                count, before = [0], b""
                continue
            n, m = 0, min(len(before), len(word))          # the prefix shared with the word before is counted
            if word[:m] == before[:m]:
                n = m
            else:
                while word[n] == before[n]:
                    n += 1
            del count[n + 1:]
            for i in range(len(count), len(last)):
                count.append(count[i - size[last[i]]] + 1)
            marked, i = array("i", count), len(word)
            while i:
                marked[i] = -marked[i]
                i -= size[last[i]]
            cache[word], before = marked.tobytes(), word

    @staticmethod
    def _through_cache(distinct: pa.Array, cache: dict, remember) -> tuple[np.ndarray, np.ndarray]:
        """Work out only words this Python worker has not met; the memory kept is bounded."""
        words = distinct.to_pylist()
        if len(cache) > KEPT_WORDS:
            cache.clear()
        missing = [w for w in words if w not in cache]
        remember(cache, words, missing)
        found = [cache[w] for w in words]
        for w in missing:
            if len(w) > KEPT_BYTES:
                del cache[w]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        return np.frombuffer(b"".join(found), np.int32), lengths


@lru_cache(4)
def merges(path: str) -> Merges:
    """The parsed vocabulary, once per Python worker."""
    return Merges(path)
