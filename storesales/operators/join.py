"""Left joins onto a large fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is sent to every executor only if it is measured to be no larger.
BROADCAST_BYTES = 256 * 1024 * 1024


def _size(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = F.count("*") * (8 * (len(df.columns) + 1))
    return df.agg(sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text), fixed).alias("bytes"))


def measured_bytes(*sides: DataFrame) -> list[int]:
    """The size of the rows of each side, by counting: 8 bytes a value, and the bytes of all text."""
    one = sides[0].sparkSession.range(1)
    return list(one.select(*[_size(df).scalar().alias(f"s{i}") for i, df in enumerate(sides)]).first())


def small_sides(*sides: DataFrame, limit: int = BROADCAST_BYTES) -> list[DataFrame]:
    """The sides, each with a broadcast hint if its measured size allows it.

    Without the hint Spark joins by sorting both sides, and adaptive execution
    splits the partitions of hot keys. The sides are read twice, so they should
    be written tables.
    """
    return [
        F.broadcast(df) if size <= limit else df for df, size in zip(sides, measured_bytes(*sides))
    ]


def left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join; a right column whose name is taken gets the suffix ``_right``."""
    taken = {c: f"{c}_right" for c in right.columns if c in left.columns and c not in keys}
    return left.join(right.withColumnsRenamed(taken), keys, "left")


def check_cardinality(base: DataFrame, out: DataFrame) -> DataFrame:
    """One row that tells whether the joins kept the number of rows."""
    rows = base.agg(F.count("*").alias("base_rows"))
    return rows.select(
        "base_rows", out.agg(F.count("*")).scalar().alias("output_rows")
    ).withColumn("preserved", F.col("base_rows") == F.col("output_rows"))
