"""Deduplication without sorting: hash aggregates, combined before the shuffle.

The partial aggregate folds the copies inside each input split, so a row that
makes up a third of the table reaches the shuffle once per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates (NULL equals NULL)."""
    return df.distinct()


def dedup_keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per ``keys``: the one with the lowest ``order``, NULLs in keys being equal.

    Unlike ``dropDuplicates`` the surviving row is defined.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    if not rest:
        # A plain minimum of a fixed-width column stays a hash aggregate.
        return df.groupBy(*keys).agg(F.min(order).alias(order)).select(*df.columns)
    first = F.min(F.struct(order, *rest))
    return df.groupBy(*keys).agg(first.alias("first")).select(*keys, "first.*").select(*df.columns)
