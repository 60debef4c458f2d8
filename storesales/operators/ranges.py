"""Order-based work on tables of any size, without one task holding the whole order.

``range_buckets`` cuts a table into contiguous, numbered ranges. What has to
cross a range border is then one small row per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.sources.shared import cut

BUCKET = "__bucket"
ROW = "__row"
TIE = "__tie"

# monotonically_increasing_id() holds the row within the partition in its lower 33 bits.
ROW_BITS = 33


def range_buckets(df: DataFrame, *order: str, label: str, ties: bool = True) -> DataFrame:
    """``df`` with the number of the range it falls into and its row there, in the order given (NULLs first).

    No number of partitions is given, so adaptive execution picks it from the
    bytes shuffled: one bucket for a small table, evenly filled ones for a large
    one. The result is written out because the range borders come from a sample
    and must not move when a lost partition is computed again.

    With ``ties``, rows that are equal in ``order`` may be split too, or many of
    them would overfill a bucket. They are told apart by their place in a written
    table, which is the same however often a lost partition is read again.
    """
    columns = [F.col(c) for c in order]
    apart = df
    if ties:
        apart = cut(df, f"{label}-input").withColumn(TIE, F.monotonically_increasing_id())
        columns.append(F.col(TIE))
    ranged = apart.repartitionByRange(*columns).sortWithinPartitions(*columns)
    numbered = ranged.select(*df.columns, F.monotonically_increasing_id().alias("__id")).select(
        *df.columns,
        F.shiftright("__id", ROW_BITS).alias(BUCKET),
        F.col("__id").bitwiseAND(2**ROW_BITS - 1).alias(ROW),
    )
    return cut(numbered, label)
