"""Lenient casts: a value that does not fit its type becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def lenient_cast(column: Column, source: str, target: str) -> Column:
    """Cast ``column`` from type ``source`` to ``target``; what does not fit is NULL."""
    if source == target:
        return column
    if target == "date":
        if source == "string":
            # The cast alone would also read '2013' as the first of January.
            return F.when(column.rlike(ISO_DATE), column.try_cast("date"))
        return column.cast("date")
    if source == "string" and target in INTEGERS:
        # Identifiers may be written as floats ('7.0'), but long keys would lose
        # digits in a double. The pattern decides, because a cast that fails
        # costs an exception per row.
        direct = F.when(column.rlike(WHOLE_NUMBER), column.try_cast(target))
        return direct.otherwise(column.try_cast("double").try_cast(target))
    return column.try_cast(target)


def safe_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Leniently cast the named columns; the others stay as they are."""
    source = dict(df.dtypes)
    return df.withColumns(
        {name: lenient_cast(F.col(name), source[name], target) for name, target in types.items()}
    )


def to_date_col(df: DataFrame, column: str = "date") -> DataFrame:
    """Make ``column`` a date; nothing happens if it is absent or already one."""
    if column not in df.columns or isinstance(df.schema[column].dataType, T.DateType):
        return df
    return safe_cast(df, {column: "date"})
