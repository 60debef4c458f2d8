"""Filling gaps in ordered series: linear interpolation, forward and backward fill.

A series may be longer than one task can hold, with or without keys, so it is
cut into contiguous ranges. Windows run inside a range; the last value before
it, the first value after it and the number of rows before it come from a
summary of one row per range and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storesales.operators.ranges import BUCKET, ROW, range_buckets

METHODS = ("linear", "forward", "backward")


def _neighbours(df: DataFrame, value: str, order: list[str], by: list[str]) -> DataFrame:
    """``df`` with its row position and the nearest valid (position, value) on both sides."""
    # The value itself breaks ties, so equal dates cannot come out in a different order.
    sequence = [*order, value]
    ranged = range_buckets(df, *by, *sequence, label="series")
    point = F.struct(F.col(ROW).alias("at"), F.col(value).alias("value"))
    valid = F.when(F.col(value).isNotNull(), point)
    summary = ranged.groupBy(BUCKET, *by).agg(
        F.count("*").alias("rows"), F.min(ROW).alias("start"), F.min(valid).alias("first"), F.max(valid).alias("last")
    )
    # Looking ahead is looking back in reverse order: frames that end at the
    # current row grow by one row each, frames that start there are computed
    # anew for every row.
    earlier = W.partitionBy(*by).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy(*by).orderBy(F.desc(BUCKET)).rowsBetween(W.unboundedPreceding, -1)
    # Turns a row number within the bucket into one within the series.
    summary = summary.withColumn(
        "__offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("start")
    )

    def moved(name: str) -> Column:
        whole = F.struct(
            (F.col(name)["at"] + F.col("__offset")).alias("at"), F.col(name)["value"].alias("value")
        )
        return F.when(F.col(name).isNotNull(), whole)

    carried = summary.select(
        F.col(BUCKET).alias("__b"),
        *[F.col(c).alias(f"__by_{c}") for c in by],
        "__offset",
        F.last(moved("last"), True).over(earlier).alias("__before"),
        F.last(moved("first"), True).over(later).alias("__after"),
    )
    same = F.col(BUCKET) == F.col("__b")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    local = W.partitionBy(BUCKET, *by)
    behind = local.orderBy(ROW).rowsBetween(W.unboundedPreceding, W.currentRow)
    ahead = local.orderBy(F.desc(ROW)).rowsBetween(W.unboundedPreceding, W.currentRow)
    here = F.when(
        F.col(value).isNotNull(), F.struct(F.col("__pos").alias("at"), F.col(value).alias("value"))
    )
    placed = ranged.join(carried, same).withColumn("__pos", F.col(ROW) + F.col("__offset"))
    return placed.select(
        *df.columns,
        "__pos",
        F.coalesce(F.last(here, True).over(behind), F.col("__before")).alias("__prev"),
        F.coalesce(F.last(here, True).over(ahead), F.col("__after")).alias("__next"),
    )


def fill_series(
    df: DataFrame, value: str, order: list[str], by: list[str] = (), methods: tuple[str, ...] = METHODS
) -> DataFrame:
    """Fill the NULLs of ``value`` by the first of ``methods`` that applies.

    Positions count rows, not days: a gap over a weekend is one step wide.
    ``linear`` applies between two valid values, ``forward`` after one and
    ``backward`` before one.
    """
    prev, after = F.col("__prev"), F.col("__next")
    between = prev["value"] + (after["value"] - prev["value"]) * (F.col("__pos") - prev["at"]) / F.when(
        after["at"] > prev["at"], after["at"] - prev["at"]
    )
    fills = {"linear": between, "forward": prev["value"], "backward": after["value"]}
    filled = F.coalesce(F.col(value), *[fills[m] for m in methods])
    return _neighbours(df, value, list(order), list(by)).withColumn(value, filled).select(*df.columns)


def interpolate_linear(df: DataFrame, value: str, order: list[str], by: list[str] = ()) -> DataFrame:
    """Fill the NULLs that lie between two valid values, on the line through both."""
    return fill_series(df, value, order, by, ("linear",))


def fill_forward(df: DataFrame, value: str, order: list[str], by: list[str] = ()) -> DataFrame:
    """Repeat the last valid value into the NULLs after it."""
    return fill_series(df, value, order, by, ("forward",))


def fill_backward(df: DataFrame, value: str, order: list[str], by: list[str] = ()) -> DataFrame:
    """Repeat the next valid value into the NULLs before it."""
    return fill_series(df, value, order, by, ("backward",))
