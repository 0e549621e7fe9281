"""Exact money aggregates.

Money is NUMERIC(..,2) at the source and DOUBLE from bronze on.  Summing
doubles makes the last bits depend on summation order (and so on partitioning);
summing the same values as DECIMAL(18,2) is exact and order-free, and the
result is cast to DOUBLE only at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """The value in cents; NULL where it doesn't fit (``not_money`` counts those)."""
    return _col(c).try_cast(MONEY)


def not_money(c: str | Column) -> Column:
    """True for an amount that is out of range or has more than two decimals."""
    col = _col(c)
    exact = money(col)
    return col.isNotNull() & (exact.isNull() | (exact.cast("double") != col))


def money_sum(c: str | Column) -> Column:
    """SUM of a money column as an exact decimal (cast to double by the caller)."""
    return F.sum(money(c))


def cents(c: str | Column) -> Column:
    """The value as a whole number of cents; NULL where it doesn't fit. A third of a decimal sum's bytes in a shuffle."""
    return (money(c) * F.lit(100).cast("decimal(3,0)")).cast("bigint")


#: Cents are summed as multiples of this and a rest, which stay far from a long's limits (10^9 rows of any amounts).
CENTS_PART = 1 << 32


def cents_parts(c: str | Column) -> tuple[Column, Column]:
    """Cents in multiples of ``CENTS_PART`` (rounded down) and the rest: sums of both give the exact sum (``from_parts``)."""
    return F.shiftright(_col(c), 32), _col(c).bitwiseAND(F.lit(CENTS_PART - 1))


def from_parts(high: str | Column, low: str | Column) -> Column:
    """The exact amount, as a decimal with two digits, whose cents' parts were summed up."""
    whole = _col(high).cast("decimal(19,0)") * F.lit(CENTS_PART).cast("decimal(10,0)") + _col(low).cast("decimal(19,0)")
    return whole * F.lit("0.01").cast("decimal(3,2)")


def money_avg(c: str | Column) -> Column:
    """AVG of a money column: exact decimal sum / count of the summed values, in DOUBLE."""
    return F.sum(money(c)).cast("double") / F.count(money(c))


def round_half_up_pct(part: str | Column, whole: str | Column) -> Column:
    """ROUND(part * 100.0 / whole, 2) computed exactly in integers, as DOUBLE.

    hundredths = floor((200 * 100 * part + whole) / (2 * whole)) is the
    half-up rounding of 10000 * part / whole for non-negative counts.
    """
    p, w = _col(part).cast("bigint"), _col(whole).cast("bigint")
    hundredths = F.call_function("div", p * F.lit(20000) + w, w * F.lit(2))
    return hundredths.cast("double") / F.lit(100.0)
