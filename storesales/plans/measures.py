"""Sales measures that can be summed at any grain.

Every analytic table is a sum or a mean, so it can be computed from the
consolidated rows or from any coarser sums of them. The job scans the
consolidated table twice, once per rollup, instead of once per table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storesales.functions.numeric import from_units, sum_units, to_units

SUMS = ["sales_units", "sales_n", "rows_n", "oil_units", "oil_n", "traffic_sum", "traffic_n"]

# The grains of the two rollups, fine enough for all tables between them.
DAY_FAMILY = ["date", "es_feriado", "family", "tiene_promocion"]
STORE_YEAR = ["store_nbr", "city", "state", "anio"]


def _calendar() -> list[Column]:
    """Year and month follow from the date, so they need not be grouped by."""
    return [F.year("date").alias("anio"), F.month("date").alias("mes")]


@dataclass(frozen=True)
class Measures:
    """Rows with partial sums. ``scale`` and ``oil_scale`` are decimal places, see ``to_units``."""

    frame: DataFrame
    scale: int | None = None
    oil_scale: int | None = None

    @classmethod
    def of(cls, consolidated: DataFrame, scale: int | None = None, oil_scale: int | None = None) -> Measures:
        """The consolidated rows, each as a sum over itself. A projection: only used columns are read."""

        def counted(column: str) -> Column:
            return F.col(column).isNotNull().cast("bigint")

        frame = consolidated.select(
            "date",
            *_calendar(),
            "store_nbr",
            "family",
            "city",
            "state",
            "es_feriado",
            (F.col("onpromotion") > 0).alias("tiene_promocion"),
            to_units(F.col("sales"), scale).alias("sales_units"),
            counted("sales").alias("sales_n"),
            F.lit(1).cast("bigint").alias("rows_n"),
            to_units(F.col("dcoilwtico"), oil_scale).alias("oil_units"),
            counted("dcoilwtico").alias("oil_n"),
            F.col("transactions").cast("double").alias("traffic_sum"),
            counted("transactions").alias("traffic_n"),
        )
        return cls(frame, scale, oil_scale)

    def rollup(self, *keys: str) -> Measures:
        """The same measures summed up per ``keys``: partial sums before the shuffle, hot keys included."""
        summed = self.frame.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])
        return self.on(summed.select("*", *_calendar()) if "date" in keys else summed)

    def on(self, frame: DataFrame) -> Measures:
        return Measures(frame, self.scale, self.oil_scale)

    def by(self, *keys: str, **columns: Column) -> DataFrame:
        """One row per ``keys`` with the named aggregates."""
        return self.frame.groupBy(*keys).agg(*[c.alias(name) for name, c in columns.items()])

    def total(self) -> Column:
        """Total sales; 0 where there are only NULLs."""
        return F.coalesce(from_units(sum_units(F.col("sales_units"), self.scale), self.scale), F.lit(0.0))

    def mean(self, when: Column | None = None) -> Column:
        """Mean sales, of the rows that meet ``when``; NULL without any."""
        units, n = F.col("sales_units"), F.col("sales_n")
        if when is not None:
            units, n = F.when(when, units), F.when(when, n)
        return F.try_divide(from_units(sum_units(units, self.scale), self.scale), F.sum(n).cast("double"))

    def mean_oil(self) -> Column:
        return F.try_divide(
            from_units(sum_units(F.col("oil_units"), self.oil_scale), self.oil_scale), F.sum("oil_n").cast("double")
        )

    def mean_traffic(self) -> Column:
        return F.try_divide(F.sum("traffic_sum"), F.sum("traffic_n").cast("double"))
