"""Order-preserving packed keys.

``min(struct(ts, key))`` is a correct "first by time, ties by key", but a
struct aggregation buffer forces a sort-based aggregate (every input
partition sorted by the grouping key).  Packing (time, key) into one exact
decimal(38,0) keeps the aggregate hash-based and the result identical.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SPACE = 10 ** 18   # keys must satisfy 0 <= key < 10^18


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ wall-clock value,
    independent of the session time zone (the wall clock is read as UTC)."""
    return F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts)
                         .cast("timestamp"))


def pack_time_key(ts: Column, key: Column) -> Column:
    """(ts, key) -> decimal(38,0) with the same order, for non-negative keys
    below 10^18 and timestamps within +-10^19 microseconds of 1970."""
    return (wall_micros(ts).cast("decimal(38,0)") * F.lit(KEY_SPACE).cast("decimal(38,0)")
            + key.cast("decimal(38,0)")).cast("decimal(38,0)")


def unpack_key(packed: Column) -> Column:
    return F.pmod(packed, F.lit(KEY_SPACE).cast("decimal(38,0)")).cast("bigint")
