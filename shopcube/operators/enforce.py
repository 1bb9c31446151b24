"""Enforcing the declared constraints on a batch of several tables.

A batch is split into accepted and rejected rows.  A rejected row carries its
first cause: a row rule, then a key that several rows hold, then a parent
that is not there.  Tables are taken in the order of their references, so a
rejected parent takes its children along, and theirs; tables that refer to
each other (or to themselves) are repeated until nothing more is rejected.
What is accepted violates no rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.operators.dims import checkpointed
from shopcube.operators.quality import RowRule


@dataclass(frozen=True)
class Parent:
    """``column`` names a row of ``table`` by its ``key``; null names none."""
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Constraints:
    table: str
    key: list[str]
    rules: list[RowRule] = field(default_factory=list)
    parents: list[Parent] = field(default_factory=list)


def _groups(tables: list[Constraints]) -> list[list[Constraints]]:
    """Tables in the order of their references; those that refer to each other stand together."""
    left, out = {t.table: t for t in tables}, []
    reach = {t.table: {p.table for p in t.parents if p.table in left} for t in tables}
    while any(not reach[p] <= r for r in reach.values() for p in r):
        reach = {t: r | {q for p in r for q in reach[p]} for t, r in reach.items()}
    while left:
        first = next(t for t in left if all(p not in left or t in reach[p] for p in reach[t]))
        group = [t for t in left if t == first or (t in reach[first] and first in reach[t])]
        out.append([left.pop(t) for t in group])
    return out


def _own_causes(rows: DataFrame, c: Constraints) -> DataFrame:
    """``rows`` with ``reason``: the first row rule broken, else a key held by several rows that break none."""
    first = F.coalesce(*[F.when(bad, f"{rule}:{column}") for rule, column, bad in c.rules], F.lit(None).cast("string"))
    marked = rows.withColumn("reason", first)
    twice = (marked.where("reason IS NULL").groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(c.key)])
             .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(c.key)]
    return (marked.join(twice, same, "left").withColumn(
        "reason", F.coalesce("reason", F.when(F.col("_n").isNotNull(), "unique:" + ",".join(c.key))))
        .select(*rows.columns, "reason"))


def _orphans(rows: DataFrame, c: Constraints, accepted: dict[str, DataFrame], known: dict[str, DataFrame]) -> DataFrame:
    """``rows`` (with reason) with the references that lead nowhere as a reason."""
    for p in c.parents:
        parts = [d.select(F.col(p.key).alias("_p")) for d in (accepted.get(p.table), known.get(p.table)) if d is not None]
        if not parts:
            raise ValueError(f"{c.table}.{p.column}: neither the batch nor the stored tables hold {p.table}")
        there = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        there = there.where("_p IS NOT NULL").distinct().withColumn("_there", F.lit(True))
        joined = rows.join(there, F.col(p.column) == F.col("_p"), "left")
        lost = F.col(p.column).isNotNull() & F.col("_there").isNull()
        rows = joined.withColumn("reason", F.coalesce("reason", F.when(lost, f"foreign_key:{p.column}"))).drop("_p", "_there")
    return rows


def enforce(batch: dict[str, DataFrame], tables: list[Constraints],
            known: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(accepted rows, rejected rows with ``reason``) of each table of the batch.

    ``known``: rows of the stored tables that parents may be found in.  Every
    row of the batch is in exactly one of the two results, repeated rows as
    often as they come; an empty table gives empty results.  A key column that
    is null is equal to itself; a reference that is null leads nowhere and is
    allowed (a NOT NULL rule forbids it).
    """
    known, accepted, rejected = known or {}, {}, {}
    for group in _groups(tables):
        own = {c.table: checkpointed(_own_causes(batch[c.table], c)) for c in group}
        circular = any(p.table in own for c in group for p in c.parents)
        while True:
            good = {t: r.where("reason IS NULL").drop("reason") for t, r in own.items()}
            judged = {c.table: _orphans(own[c.table], c, {**accepted, **good}, known) for c in group}
            if not circular:
                break
            judged = {t: checkpointed(r) for t, r in judged.items()}
            more = sum(judged[t].where("reason IS NULL").count() != own[t].where("reason IS NULL").count() for t in own)
            own = judged
            if not more:
                break
        for t, rows in judged.items():
            rows = rows if circular else checkpointed(rows)
            accepted[t] = rows.where("reason IS NULL").drop("reason")
            rejected[t] = rows.where("reason IS NOT NULL")
    return accepted, rejected
