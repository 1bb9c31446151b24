"""Operator 5: language identification by language-bitmask n-gram filters.

One Bloom filter serves all languages: a slot holds a bitmask with a bit for
each language, so the AND of an n-gram's slots is the set of languages that
contain it (a bit-sliced filter).  A text's votes are the popcounts of its
n-grams per language, corrected for the share of false positives that each
language's slots give; the language with the most corrected votes wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.components import _stored, discard
from shopcube.llm.shingles import K1, K2, mix
from shopcube.llm.words import LETTER, Words, chunks, class_table

SLOTS = 1 << 20          # slots of the filter, each a bitmask of languages
HASHES = 3
FLOOR = 5e-5             # least share of a language's n-grams; so at most 1 / FLOOR n-grams of each language are kept
TYPICAL = 0.25           # and least share against the language in which the n-gram is most frequent
LANGUAGES = 1024         # labels that are learned at most, those with the most text; so the filter has a bound
UNKNOWN = "und"


def word_grams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letter trigrams of all words as 63-bit codes, first trigram of each word and the end).

    Words are lower-cased; every run of letters stands between two borders
    (code 0), so the first and last letters make trigrams of their own.
    """
    text = b"\n".join(distinct.to_pylist() + [b""]).decode("utf-8", "replace")
    low = _lower(text)
    cp = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    # a word may hold line breaks itself: its borders come from its length in characters
    chars = np.array([len(w.decode("utf-8", "replace")) for w in distinct.to_pylist()], np.int64)
    first = np.concatenate([[0], np.cumsum(chars + 1)])
    cp[class_table()[raw] != LETTER] = 0
    cp = np.concatenate([[0], cp, [0]])
    mid = np.flatnonzero(cp[1:-1])                       # a trigram for each letter
    grams = cp[mid] | (cp[mid + 1] << 21) | (cp[mid + 2] << 42)
    return grams, np.searchsorted(mid, first[:len(distinct) + 1])


def _lower(text: str) -> str:
    """Lower case, character by character where the whole would change its length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def gram_counts(docs: DataFrame, label: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, n) over all rows of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                w = Words(part)
                grams, bounds = word_grams(w.distinct)
                each, back = np.unique(grams, return_inverse=True)
                codes = batch.column(0).slice(at, len(part)).dictionary_encode()
                lang = np.repeat(codes.indices.to_numpy(), np.diff(w.bounds))
                for i, name in enumerate(codes.dictionary.to_pylist()):
                    times = np.bincount(w.ids[lang == i], minlength=len(w.distinct))
                    n = np.bincount(back, weights=np.repeat(times, np.diff(bounds)),
                                    minlength=len(each)).astype(np.int64)
                    used = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(used), pa.string()), pa.array(each[used]), pa.array(n[used])],
                        names=["lang", "gram", "n"])

    rows = docs.select(F.col(f"`{label}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("t"))
    counted = rows.where("lang IS NOT NULL AND t IS NOT NULL").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slots_of(grams: np.ndarray) -> list[np.ndarray]:
    """The slots of each n-gram, one for each hash: independent, also for n-grams that differ in a letter only."""
    x = mix(grams.astype(np.uint64) * K1)
    return [(mix(x + np.uint64((k + 1) * int(K2) % (1 << 64))) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    """The learned filter: ``masks[w, slot]`` has the bits of languages 64 w .. 64 w + 63."""
    langs: list[str]
    masks: np.ndarray
    false_share: np.ndarray

    @staticmethod
    def build(langs: list[str], kept: list[tuple[int, int]]) -> Filters:
        masks = np.zeros((max(1, -(-len(langs) // 64)), SLOTS), np.uint64)
        by: dict[int, list[int]] = {}
        for lang, gram in kept:
            by.setdefault(lang, []).append(gram)
        fill = np.zeros(len(langs))
        for i, grams in by.items():
            bit = np.uint64(1) << np.uint64(i % 64)
            for s in slots_of(np.array(grams, np.int64)):
                masks[i // 64, s] |= bit
            fill[i] = np.count_nonzero(masks[i // 64] & bit) / SLOTS
        return Filters(langs, masks, fill ** HASHES)

    def votes(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text, its n-grams found in each language)."""
        grams, bounds = word_grams(w.distinct)
        slots = slots_of(grams)
        total = w.per_text(np.diff(bounds))
        found = np.zeros((len(total), len(self.langs)), np.int64)
        for k in range(len(self.masks)):
            hit = self.masks[k][slots[0]]
            for s in slots[1:]:
                hit = hit & self.masks[k][s]
            for i in range(64 * k, min(64 * k + 64, len(self.langs))):
                one = ((hit >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
                running = np.concatenate([[0], np.cumsum(one)])
                found[:, i] = w.per_text(running[bounds[1:]] - running[bounds[:-1]])
        return total, found

    def decide(self, total: np.ndarray, found: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text: the largest corrected share of its n-grams."""
        n = np.maximum(total, 1)[:, None]
        if not self.langs:
            return [UNKNOWN] * len(total), np.zeros(len(total))
        true = (found / n - self.false_share) / (1 - np.minimum(self.false_share, 0.999))
        true = np.clip(true, 0, 1)
        best = true.argmax(axis=1)
        score = np.where(total > 0, true[np.arange(len(best)), best], 0.0)
        return [self.langs[b] if t else UNKNOWN for b, t in zip(best.tolist(), total.tolist())], score


def learn(docs: DataFrame, label: str = "lang", text: str = "text") -> Filters:
    """Filters from all rows of ``docs`` with a label.

    The counts cover every text; what comes to the driver are the kept
    n-grams, at most 1 / FLOOR for each of at most LANGUAGES labels (a dirty
    label column makes no larger filter; labels beyond them are not learned).
    """
    counts = _stored(gram_counts(docs, label, text), "language-grams")
    most = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    totals = {r.lang: r.n for r in most.collect()}
    langs = sorted(totals)
    if not langs:
        discard(counts)
        return Filters.build([], [])
    share = counts.join(F.broadcast(docs.sparkSession.createDataFrame(
        [(k, float(n)) for k, n in totals.items()], "lang string, total double")), "lang")
    share = share.withColumn("p", F.col("n") / F.col("total")).where(F.col("p") >= FLOOR)
    top = share.groupBy("gram").agg(F.max("p").alias("top"))
    kept = share.join(top, "gram").where(F.col("p") >= TYPICAL * F.col("top")).select("lang", "gram").toArrow()
    discard(counts)
    at = {name: i for i, name in enumerate(langs)}
    return Filters.build(langs, [(at[k], g) for k, g in zip(kept.column(0).to_pylist(), kept.column(1).to_pylist())])


def predict(docs: DataFrame, filters: Filters, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` beside lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)     # SLOTS bitmasks, whatever the corpus
    rows = docs.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    n = len(keep)
    out = T.StructType([*rows.schema.fields[:n], T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            for at, part in chunks(batch.column(n)):
                lang, score = f.decide(*f.votes(Words(part)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(at, len(part)) for i in range(n)),
                     pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=out.names)

    return rows.mapInArrow(run, out)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", label: str = "lang", text: str = "text") -> DataFrame:
    """Per row: key, held_out, lang_pred, score.

    Learns from rows with a label that are not held out.  A null text, or
    one without letters, is ``und`` with score 0, as is every text when
    nothing can be learned; of equal votes the first language by name wins.
    Repeated rows give repeated results; an empty table an empty result.
    """
    filters = learn(docs.where(~held_out(key)).select(label, text), label, text)
    found = predict(docs, filters, [key], text)
    return found.select(key, held_out(key).alias("held_out"), "lang_pred", "score")
