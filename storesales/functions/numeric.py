"""Arithmetic that stays whole-stage compiled and gives NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_units(column: Column, scale: int | None) -> Column:
    """``column`` as a whole number of 10^-scale units, or as a double without a scale.

    Sums of whole numbers do not depend on the order of the rows, so a result is
    the same whatever the partitioning and however often a task was retried.
    They stay longs all the way, where decimals would leave primitive code.
    """
    if scale is None:
        return column.cast("double")
    return F.rint(column * F.lit(float(10**scale))).cast("bigint")


# Bits of a whole number that are added up apart from the higher ones.
_LOW_BITS = 20


def sum_units(column: Column, scale: int | None) -> Column:
    """Sum of :func:`to_units` that cannot overflow: a decimal, or a double without a scale.

    High and low bits are added up as longs, which stays primitive code and is
    exact for 8e12 rows of any size; only the two sums are put together as a decimal.
    """
    if scale is None:
        return F.sum(column)
    high = F.sum(F.shiftright(column, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(column.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    return high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low


def from_units(column: Column, scale: int | None) -> Column:
    """Undo :func:`to_units` on a sum."""
    value = column.cast("double")
    return value if scale is None else value / F.lit(float(10**scale))


def pct_change(new: Column, base: Column) -> Column:
    """Change from ``base`` to ``new`` in percent; NULL when the base is zero."""
    return F.try_divide(F.lit(100.0) * (new - base), base)


def pct_of(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``, rounded; 0.0 when there is no whole."""
    share = F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
    return F.coalesce(F.round(share, digits), F.lit(0.0))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL for fewer than two pairs or a constant side.

    ``corr`` itself raises on a constant column under ANSI. Pairs with a NULL do
    not count.
    """
    paired = x.isNotNull() & y.isNotNull()
    x, y = F.when(paired, x), F.when(paired, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
