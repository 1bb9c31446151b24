"""Star join of facts to versioned dimensions, with inferred members.

Every foreign key of the fact is looked up in its dimension: the version in
force at the fact's time where the dimension keeps versions, else the member.
A business key that the dimension does not know yet gets an inferred member:
one row with a key of its own and no attributes, so no fact is lost or left
without a key.  When the member arrives later, its row is completed in place:
the key stays, so facts loaded before need no change.

Dimension rows are (sk, business key, valid_from, is_inferred, attributes);
``valid_from`` is the first day of a version, null for a version without a
beginning (and in dimensions without versions).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcube.operators.dims import assign_surrogate_keys, stored
from shopcube.operators.sequence import asof_join


@dataclass(frozen=True)
class Lookup:
    """How a fact finds its member: ``column`` of the fact names it, ``sk`` is the key the fact gets.

    ``at``: date column of the fact whose version counts (strictly before that
    day), None for a dimension without versions.
    """
    name: str
    column: str
    sk: str
    at: str | None = None


def new_dimension(members: DataFrame, key: str, sk: str = "sk") -> DataFrame:
    """A dimension without versions: dense keys in the order of the business key."""
    keys = assign_surrogate_keys(members.select(key), key, sk_col=sk)
    return (members.dropDuplicates([key]).join(keys, key)
            .select(sk, key, F.lit(None).cast("date").alias("valid_from"), F.lit(False).alias("is_inferred"),
                    *[c for c in members.columns if c != key]))


def new_versions(versions: DataFrame, key: str, sk: str = "sk") -> DataFrame:
    """A dimension of versions (key, valid_from, attributes): dense keys in the order of key and valid_from."""
    one = F.struct(key, "valid_from")
    versions = stored(versions)                               # numbered, then joined
    keys = assign_surrogate_keys(versions.select(one.alias("v")), "v", sk_col=sk)
    return (versions.withColumn("v", one).join(keys, "v")
            .select(sk, key, "valid_from", F.lit(False).alias("is_inferred"),
                    *[c for c in versions.columns if c not in (key, "valid_from")]))


def inferred_members(facts: DataFrame, lookup: Lookup, dim: DataFrame, key: str, sk: str = "sk") -> DataFrame:
    """Rows for the business keys of ``facts`` that ``dim`` does not hold, with keys behind the largest one.

    Keys are counted once by map-side combination, so a hot unknown member is
    no hot group.
    """
    unknown = (facts.select(F.col(lookup.column).alias(key)).where(F.col(key).isNotNull()).distinct()
               .join(dim.select(key).distinct(), key, "left_anti"))
    base = dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar()
    keys = assign_surrogate_keys(unknown, key, sk_col=sk, distinct=True)
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields
            if f.name not in (sk, key, "valid_from", "is_inferred")]
    return keys.select((base + F.col(sk)).cast("bigint").alias(sk), key, F.lit(None).cast("date").alias("valid_from"),
                       F.lit(True).alias("is_inferred"), *rest).select(*dim.columns)


def resolve(facts: DataFrame, lookup: Lookup, dim: DataFrame, key: str, sk: str = "sk") -> DataFrame:
    """``facts`` with ``lookup.sk``; null only where the business key is null or no version is in force."""
    if lookup.at is None:
        keys = dim.select(F.col(key).alias(lookup.column), F.col(sk).alias(lookup.sk))
        return facts.join(keys, lookup.column, "left").select(*facts.columns, lookup.sk)
    # a version without a beginning is in force from the first day that can be written
    versions = dim.select(F.col(key).alias(lookup.column), F.coalesce("valid_from", F.lit("0001-01-01").cast("date")).alias("_from"),
                          F.col(sk).alias(lookup.sk))
    return asof_join(facts, versions, [lookup.column], lookup.at, "_from", strict=True).select(*facts.columns, lookup.sk)


def star_join(facts: DataFrame, lookups: list[tuple[Lookup, DataFrame, str]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(facts with all keys, dimensions with their inferred members).

    ``lookups``: for each foreign key the rule, the dimension and the name of
    its business key.  Fact rows are neither lost nor multiplied: a
    dimension holds a business key once (for each ``valid_from``).  Dimensions
    are stored before they are looked up, as they are read several times; the
    facts are not.
    """
    out, dims = facts, {}
    for lookup, dim, key in lookups:
        dim = stored(dim)
        dims[lookup.name] = stored(dim.unionByName(inferred_members(facts, lookup, dim, key)))
        out = resolve(out, lookup, dims[lookup.name], key)
    return out, dims


def complete_members(dim: DataFrame, arrived: DataFrame, key: str, sk: str = "sk") -> DataFrame:
    """The dimension after the members of ``arrived`` (key, attributes) came in.

    An inferred row takes the attributes and keeps its key; a row known
    before stays as it is; a member without row gets a new key.
    """
    attributes = [c for c in arrived.columns if c != key]
    late = arrived.dropDuplicates([key]).select(key, F.lit(True).alias("_came"), *[F.col(c).alias(f"_new_{c}") for c in attributes])
    both = dim.join(late, key, "left")
    here = F.col("is_inferred") & F.coalesce("_came", F.lit(False))
    kept = both.select(*[F.when(here, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in attributes
                         else F.when(here, False).otherwise(F.col(c)).alias(c) if c == "is_inferred" else F.col(c)
                         for c in dim.columns])
    fresh = arrived.dropDuplicates([key]).join(dim.select(key).distinct(), key, "left_anti")
    base = dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar()
    keys = assign_surrogate_keys(fresh.select(key), key, sk_col=sk)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields
               if f.name not in (sk, key, "valid_from", "is_inferred", *attributes)]
    added = (fresh.join(keys, key)
             .select((base + F.col(sk)).cast("bigint").alias(sk), key, F.lit(None).cast("date").alias("valid_from"),
                     F.lit(False).alias("is_inferred"), *attributes, *missing))
    return kept.unionByName(added)
