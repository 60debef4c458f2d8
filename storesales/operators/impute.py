"""Filling NULLs with a constant, the mode or the median.

Statistics enter the plan as scalar subqueries: one value, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storesales.operators.ranges import BUCKET, range_buckets
from storesales.sources.shared import cut


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULLs by the given constants."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the most frequent non-NULL value of each column; the smallest on a tie.

    All columns go through one counting aggregate, so neither a hot value nor
    many distinct values collect anywhere.
    """
    values = df.unpivot([], [F.col(c) for c in columns], "name", "value").where("value IS NOT NULL")
    counted = values.groupBy("name", "value").agg(F.count("*").alias("n"))
    best = counted.groupBy("name").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    )
    return best.agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in columns])


def fill_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULLs in the categorical ``columns`` by the column's mode.

    Values are counted only of columns that have a NULL, which one aggregate
    without a shuffle of values tells.
    """
    found = df.agg(*[F.bool_or(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    with_nulls = [c for c, some in zip(columns, found, strict=True) if some]
    if not with_nulls:
        return df
    best = modes(df, with_nulls).select(F.struct(*with_nulls)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), best[c]) for c in with_nulls})


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one double ``median``: the exact median of the non-NULL values.

    The values are first counted, then cut into ranges. The ranks at the range
    borders tell which one or two buckets hold the middle, and only these are
    ranked row by row.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    ranged = range_buckets(counted, "value", label="median", ties=False)
    # One row per bucket: as many as there are shuffle partitions.
    borders = ranged.groupBy(BUCKET).agg(F.sum("n").alias("inside"))
    upto = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("inside").over(everything)
    borders = borders.select(
        BUCKET,
        (F.sum("inside").over(upto) - F.col("inside")).alias("before"),
        F.sum("inside").over(upto).alias("last"),
        F.floor((total + 1) / 2).alias("low_rank"),
        F.floor((total + 2) / 2).alias("high_rank"),
    )
    middle = borders.where("low_rank <= last AND high_rank > before")
    rank = F.sum("n").over(W.partitionBy(BUCKET).orderBy("value")) + F.col("before")
    ranked = ranged.join(middle, BUCKET).withColumn("rank", rank)
    low = F.min(F.when(F.col("rank") >= F.col("low_rank"), F.col("value")))
    high = F.min(F.when(F.col("rank") >= F.col("high_rank"), F.col("value")))
    return ranked.agg(((low + high) / 2).alias("median"))


def fill_median(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """Replace NULLs by the column's median; the columns become doubles either way.

    Without NULLs there is nothing to order, and the check for them filters at
    the scan. Otherwise ``df`` is read twice, so it is written once. ``approx``
    takes the median from a quantile sketch: one pass.
    """
    filled = {c: F.col(c).cast("double") for c in columns}
    with_nulls = [c for c in columns if not df.where(F.col(c).isNull()).isEmpty()]
    if with_nulls:
        df = cut(df, "median-input")
    for c in with_nulls:
        if approx:
            median = df.agg(F.percentile_approx(F.col(c).cast("double"), 0.5).alias("median"))
        else:
            median = exact_median(df, c)
        filled[c] = F.coalesce(F.col(c).cast("double"), median.scalar())
    return df.withColumns(filled)
