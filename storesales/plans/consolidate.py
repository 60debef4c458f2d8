"""One wide table: sales with store, transactions, oil price and holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.operators.join import BROADCAST_BYTES, left_join, small_sides


def summarise_holidays(holidays: DataFrame) -> DataFrame:
    """One row per date, so that several holidays on a day do not multiply its sales.

    A holiday of any locale counts. The three descriptive fields belong
    together: they are taken from the smallest such triple of the day.
    """
    first = F.min(F.struct("locale", "locale_name", "description"))

    def any_true(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    return (
        holidays.groupBy("date")
        .agg(
            any_true(F.col("type") == "Holiday").alias("es_feriado"),
            any_true(F.col("transferred")).alias("feriado_transferido"),
            first.alias("first"),
        )
        .select(
            "date",
            "es_feriado",
            "feriado_transferido",
            F.col("first.locale").alias("feriado_locale"),
            F.col("first.locale_name").alias("feriado_locale_name"),
            F.col("first.description").alias("feriado_descripcion"),
        )
    )


def consolidate(
    sales: DataFrame,
    stores: DataFrame,
    transactions: DataFrame,
    oil: DataFrame,
    holidays: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Sales left-joined with everything else, at the grain of ``sales``.

    ``transactions`` grows with sales, so it is joined first, while the rows are
    still narrow: the only shuffle of sales. The other sides are broadcast if
    they measure small enough. The order of left joins does not matter for the
    rows, and the final projection sets the order of columns.
    """
    with_traffic = left_join(sales, transactions, ["store_nbr", "date"])
    daily = summarise_holidays(holidays)
    stores, oil, daily = small_sides(stores, oil, daily, limit=broadcast_bytes)
    with_stores = left_join(with_traffic, stores, ["store_nbr"])
    with_oil = left_join(with_stores, oil, ["date"])
    out = left_join(with_oil, daily, ["date"]).withColumns(
        {c: F.coalesce(F.col(c), F.lit(False)) for c in ("es_feriado", "feriado_transferido")}
    )

    def added(after: DataFrame, before: DataFrame) -> list[str]:
        return [c for c in after.columns if c not in before.columns]

    return out.select(
        *sales.columns,
        *added(with_stores, with_traffic),
        *added(with_traffic, sales),
        *added(out, with_stores),
    )
