"""Exact money arithmetic.

Money is DECIMAL end to end (as in the DDL).  Per-row arithmetic uses
decimal precisions that stay long-backed; grouped sums accumulate integer
cents (exact and independent of summation order); only final ratios leave
decimal, as ``double(sum) / double(count)``, which every engine rounds the
same way.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(20,2)"      # sums over all rows of a key
WIDE = "decimal(28,2)"       # sums over a feed
PRICE = "decimal(10,2)"
RATE = "decimal(5,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c, t: str = MONEY) -> Column:
    """Cast to a money decimal (HALF_UP when scale shrinks)."""
    return col_(c).cast(t)


def dec(v: str) -> Column:
    """Exact decimal literal, e.g. ``dec('0.6')``."""
    return F.lit(Decimal(v))


def safe_div(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (SQL ``x / NULLIF(y,0)``)."""
    d = col_(den).cast("double")
    return col_(num).cast("double") / F.nullif(d, F.lit(0.0))


def sum_d(c) -> Column:
    """Exact decimal sum, reported as double."""
    return F.sum(col_(c)).cast("double")


def avg_d(c) -> Column:
    """Average of a decimal column: double(sum) / double(count), NULL when empty."""
    return safe_div(F.sum(col_(c)), F.count(col_(c)))


def cents_from_double(c) -> Column:
    """A non-negative 2-decimal amount stored as double -> integer cents.
    floor(x*100 + 0.5) stays in primitive arithmetic (a double->decimal cast
    goes through BigDecimal for every row)."""
    return F.floor(col_(c) * 100 + 0.5).cast("long")


def cents_to_money(cents, t: str = MONEY) -> Column:
    """Integer cents -> decimal(p,2).  decimal(p,0) x 0.01 is decimal(p+3,2):
    long-backed ("compact") arithmetic for p <= 15."""
    p = int(t.split("(")[1].split(",")[0])
    return (col_(cents).cast(f"decimal({p},0)") * dec("0.01")).cast(t)


def money_from_double(c, t: str = MONEY) -> Column:
    """A non-negative 2-decimal amount stored as double -> exact decimal."""
    return cents_to_money(cents_from_double(c), t)


def to_cents(c) -> Column:
    """decimal(p,2) -> long cents (decimal(p,2) x decimal(3,0): compact for p <= 15)."""
    return (col_(c) * dec("100")).cast("long")


def msum(c, t: str = "decimal(20,2)") -> Column:
    """Exact sum of a scale-2 decimal, accumulated as long cents.

    ``sum(decimal(12,2))`` keeps a decimal(22,2) buffer (BigDecimal per row);
    a long buffer keeps the aggregation compact.  Overflow (beyond 9.2e16 in
    currency units per group) raises under ANSI mode instead of wrapping.
    """
    cents = F.sum(to_cents(c))
    return (cents.cast("decimal(19,0)") * dec("0.01")).cast(t)


def half_up_div(num: str, den: str) -> Column:
    """round(num / den) half-up for non-negative integer columns ``num`` and
    ``den`` (given by name), as long integer division; NULL when den is 0."""
    return F.expr(f"CASE WHEN {den} = 0 THEN NULL "
                  f"ELSE (CAST({num} AS BIGINT) * 2 + {den}) div (CAST({den} AS BIGINT) * 2) END")
