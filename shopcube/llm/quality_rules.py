"""Operator 9: quality rules, one table of thresholds compiled into a projection.

Only built-in SQL functions run: words and lines are arrays, repeated
five-word windows are found through 64-bit hashes of the windows of one text,
and every rule of the table becomes one boolean expression of the measures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"

# Frequent function words of four languages, and the codes of these.
LISTED = ["de", "en", "es", "fr"]
STOP_WORDS = sorted({
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "für", "auf", "ist", "im", "dem", "nicht",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "est", "pour", "dans", "qui", "au", "par",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "una", "su", "para", "al", "lo", "es", "os",
})


@dataclass(frozen=True)
class Rule:
    """``low * of <= measure <= high * of`` (either bound may be missing), for texts of at least ``least`` words."""
    name: str
    measure: str
    of: str
    low: float | None = None
    high: float | None = None
    least: int = 0
    listed: bool = False         # judges only texts in a language that STOP_WORDS covers


BASE_RULES = (
    Rule("length", "n_words", "one", low=10),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.20),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2, high=15),
    Rule("symbols", "n_symbols", "n_words", high=0.10),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, least=50, listed=True),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.50),
)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines"]


def holds(rule: Rule) -> Column:
    """The rule as an expression over integers (bounds in parts of 100)."""
    m = F.col(rule.measure).cast("long") * 100
    of = F.lit(1).cast("long") if rule.of == "one" else F.col(rule.of).cast("long")
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (m >= of * F.lit(round(rule.low * 100)).cast("long"))
    if rule.high is not None:
        ok = ok & (m <= of * F.lit(round(rule.high * 100)).cast("long"))
    if rule.listed:
        ok = ~F.col("listed") | ok
    return ok if not rule.least else (F.col("n_words") < rule.least) | ok


def measures(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """The measures of the whole text of each row (null: empty), beside ``row``, a struct of all its columns.

    ``listed``: whether the row names a language that the stop words cover; it
    does not where the column is missing or null.
    """
    n = F.size("words")
    listed = F.lower(F.col(f"`{language}`").cast("string")).isin(LISTED) if language in docs.columns else F.lit(False)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                     F.coalesce(listed, F.lit(False)).alias("listed"),
                     F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"))
    df = df.select(
        "row", "listed",
        F.array_remove(F.split("__t", BLANKS, -1), "").alias("words"),
        F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace("__t", BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size(F.filter(F.split(F.lower("__t"), r"[^\p{L}]+", -1), lambda x: x.isin(STOP_WORDS)))
        .cast("long").alias("n_stop_words"),
    )
    df = df.withColumn("h", F.transform("words", lambda x: F.xxhash64(x)))
    later = lambda i, k: F.get(F.col("h"), i + k)
    df = df.withColumn("windows", F.transform(
        F.slice("h", 1, F.greatest(n - 4, F.lit(0))),
        lambda x, i: F.xxhash64(x, later(i, 1), later(i, 2), later(i, 3), later(i, 4))))
    # only a text that has a window twice is sorted
    df = df.withColumn("twice", F.size(F.array_distinct("windows")) < F.size("windows"))
    df = df.withColumn("sorted", F.when(F.col("twice"), F.array_sort(
        F.transform("windows", lambda x, i: F.struct(x.alias("w"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get(F.col("sorted"), k)["w"] == x["w"], F.lit(False))
    df = df.withColumn("at", F.array_sort(F.transform(
        F.filter("sorted", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("at", lambda x, k: F.least(F.lit(5), F.coalesce(F.get(F.col("at"), k + 1) - x, F.lit(5)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(
        "row", "listed", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("twice"), covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        "n_stop_words", F.size("lines").cast("long").alias("n_lines"),
        F.monotonically_increasing_id().alias("number"))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", language: str = "lang") -> DataFrame:
    """``measures`` with the verdicts base_failed and kept.

    The verdicts hang on the row number, which holds a later filter on them
    above the projections: pushed below, it would repeat the expressions of
    every step inside those of the next.
    """
    base, own = F.lit(True), F.lit(True)
    for r in BASE_RULES:
        base = base & holds(r)
    for r in rules:
        own = own & holds(r)
    return (measures(docs, text, language).withColumn("base_failed", ~(base & (F.col("number") >= 0)))
            .withColumn("kept", ~F.col("base_failed") & own))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text",
            language: str = "lang") -> DataFrame:
    """Per row: key, the measures, base_failed and kept.

    Stop words are asked for only in texts whose language column names a
    language of the list; a text in another or no language is not judged by
    them.  No rule has an upper bound on the length of a text.

    A null or empty text has no words and fails the base rules.  Repeated
    rows give repeated results; an empty table gives an empty result; texts
    are measured whole, of any length.
    """
    known = F.col(f"`{language}`") if language in docs.columns else F.lit(None)
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), known.cast("string").alias("lang"))
    return judged(narrow, rules).select(F.col("row.key").alias(key), *MEASURES, "base_failed", "kept")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", language: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass all rules, with all their columns."""
    return judged(docs, rules, text, language).where("kept").select("row.*")


def oracle(table: str = "documents") -> str:
    """DuckDB SQL for ``quality``."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    part = lambda r: " AND ".join(
        f"100 * {r.measure} {sign} {round(bound * 100)} * {r.of}"
        for sign, bound in ((">=", r.low), ("<=", r.high)) if bound is not None)
    spared = lambda r: " OR ".join([*([f"n_words < {r.least}"] if r.least else []), *(["NOT listed"] if r.listed else [])])
    both = lambda rules: " AND ".join(f"({part(r)})" if not spared(r) else f"({spared(r)} OR ({part(r)}))" for r in rules)
    codes = ", ".join(f"'{x}'" for x in LISTED)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lower(lang) IN ({codes}), FALSE) AS listed FROM {table}),
w AS (SELECT doc_id, t, listed, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id),
m AS (SELECT doc_id, listed, CAST(len(ws) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
      CAST(len(list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}]+'),
                           lambda x: x IN ({stops}))) AS BIGINT) AS n_stop_words,
      CAST(len(ls) AS BIGINT) AS n_lines, 1 AS one
      FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines,
       NOT ({both(BASE_RULES)}) AS base_failed, ({both(BASE_RULES)}) AND ({both(RULES)}) AS kept
FROM m"""
