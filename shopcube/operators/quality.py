"""Data-quality checks (Q01-Q07, J06): the constraints the DDL declares but
Spark does not enforce, evaluated as aggregates.

Key uniqueness and the row rules of a table (NOT NULL, enumerations, ranges,
identities) share a single grouped pass; an orphan check is one anti join of
counted keys.  The rules look at batches as they come in.  Every result row is
``(table_name, rule, column_name, failures)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RowRule = tuple[str, str, Column]   # (rule, column_name, failing condition)


def not_null(*cols: str) -> list[RowRule]:
    """Q03."""
    return [("not_null", c, F.col(c).isNull()) for c in cols]


def one_of(col: str, values: list[str]) -> list[RowRule]:
    """Q07: value outside the allowed set (NULL is a NOT NULL question)."""
    return [("allowed_values", col, F.col(col).isNotNull() & ~F.col(col).isin(*values))]


def holds(name: str, col: str, ok: Column) -> list[RowRule]:
    """Q05/Q06: an identity that must hold (NULL counts as failure)."""
    return [(name, col, ~F.coalesce(ok, F.lit(False)))]


def in_range(name: str, col: str, ok: Column) -> list[RowRule]:
    """A declared bound (NULL is a NOT NULL question)."""
    return [(name, col, F.col(col).isNotNull() & ~ok)]


def _report(counts: DataFrame, table: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"),
                              F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("failures")) for r, c, n in rules])
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def keyed_checks(df: DataFrame, table: str, key: list[str], rules: list[RowRule]) -> DataFrame:
    """Q01/Q02 (keys that occur more than once) and all row rules of a table in
    one pass: failures are counted per key first, so repeated keys and row
    failures come from the same grouped rows."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.count_if(cond).alias(f"_r{i}") for i, (_, _, cond) in enumerate(rules)])
    counts = per_key.agg(F.count_if(F.col("_n") > 1).alias("_u"),
                         *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(rules))])
    return _report(counts, table, [("unique", ",".join(key), "_u")]
                   + [(r, c, f"_r{i}") for i, (r, c, _) in enumerate(rules)])


def orphan_check(df: DataFrame, table: str, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows whose foreign key has no parent (what a FOREIGN KEY rejects).

    Rows are counted per key before the anti join, so a hot key crosses it once."""
    per_key = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_key.join(ref.select(F.col(ref_col).alias(col)), col, "left_anti")
    return _report(orphans.agg(F.sum("_n").alias("_o")), table, [("foreign_key", col, "_o")])


def quality_report(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "rule", "column_name", F.col("failures").cast("bigint"))
