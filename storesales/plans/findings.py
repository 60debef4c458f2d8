"""The summary findings: single figures and short rankings read off the analytic tables.

Rankings keep a fixed number of rows because that is what they are; they rank
non-NULL values only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storesales.functions.numeric import safe_corr
from storesales.plans.analytics import OIL_FALL

# Lengths of the rankings, lags in months.
STORES_RANKED = 10
OTHERS_RANKED = 5
LAGS = (1, 2, 3)


def _top(table: DataFrame, value: str, key: str, n: int) -> DataFrame:
    return table.where(F.col(value).isNotNull()).orderBy(F.desc(value), key).limit(n)


def _bottom(table: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The last rows of the descending ranking, still descending."""
    last = table.where(F.col(value).isNotNull()).orderBy(F.asc(value), F.desc(key)).limit(n)
    return last.orderBy(F.desc(value), key)


def top_family(by_family: DataFrame) -> DataFrame:
    """The family with the highest sales; no row for an empty table."""
    return _top(by_family, "ventas_totales", "family", 1)


def top_stores(by_store: DataFrame) -> DataFrame:
    return _top(by_store, "ventas_totales", "store_nbr", STORES_RANKED)


def bottom_stores(by_store: DataFrame) -> DataFrame:
    return _bottom(by_store, "ventas_totales", "store_nbr", STORES_RANKED)


def top_holiday_families(sensitivity: DataFrame) -> DataFrame:
    return _top(sensitivity, "variacion_porcentual", "family", OTHERS_RANKED)


def top_promo_families(effect: DataFrame) -> DataFrame:
    return _top(effect, "efecto_promocion_pct", "family", OTHERS_RANKED)


def most_sensitive_cities(sensitivity: DataFrame) -> DataFrame:
    """The cities whose sales changed least for the better during the fall of the oil price."""
    ranked = sensitivity.where("variacion_pct IS NOT NULL").orderBy("variacion_pct", "city")
    return ranked.limit(OTHERS_RANKED)


def high_ticket_stores(ticket: DataFrame) -> DataFrame:
    return _top(ticket, "ticket_promedio", "store_nbr", OTHERS_RANKED)


def low_ticket_stores(ticket: DataFrame) -> DataFrame:
    return _bottom(ticket, "ticket_promedio", "store_nbr", OTHERS_RANKED)


def corr_oil_sales(monthly: DataFrame) -> DataFrame:
    """Correlation of monthly sales with the monthly oil price."""
    r = safe_corr(F.col("ventas_totales"), F.col("precio_petroleo_promedio"))
    return monthly.agg(r.alias("correlacion"))


def corr_oil_sales_lags(
    monthly: DataFrame, years: tuple[int, int] = OIL_FALL, lags: tuple[int, ...] = LAGS
) -> DataFrame:
    """Correlation of sales with the oil price some months earlier; lags with fewer than 2 pairs are left out.

    One row per calendar month of a few years, so one window over all of them.
    """
    months = monthly.where(F.col("anio").between(*years))
    order = W.orderBy("anio", "mes")
    paired = months.withColumns({f"p{k}": F.lag("precio_petroleo_promedio", k).over(order) for k in lags})

    def result(k: int) -> Column:
        sales, oil = F.col("ventas_totales"), F.col(f"p{k}")
        return F.struct(
            F.lit(k).alias("lag_meses"), safe_corr(sales, oil).alias("correlacion"), F.count(oil).alias("n")
        )

    found = paired.agg(F.array(*[result(k) for k in lags]).alias("found"))
    return found.selectExpr("inline(found)").where("n >= 2").select("lag_meses", "correlacion")


def corr_transactions_sales(ticket: DataFrame) -> DataFrame:
    """Correlation over stores of mean transactions with total sales."""
    r = safe_corr(F.col("transacciones_promedio"), F.col("ventas_totales"))
    return ticket.agg(r.alias("correlacion"))


def _records(rows: DataFrame) -> Column:
    """The rows of a short ranking as an array, in order."""
    numbered = rows.select(
        F.monotonically_increasing_id().alias("at"), F.struct(*[F.col(c) for c in rows.columns]).alias("row")
    )
    pairs = F.array_sort(F.collect_list(F.struct("at", "row")))
    return numbered.agg(F.transform(pairs, lambda pair: pair["row"])).scalar()


# The public names of the tables that the summary reads.
SUMMARY_TABLES = (
    "ventas_por_familia",
    "ventas_por_tienda",
    "ventas_feriado_vs_normal",
    "sensibilidad_familias_feriados",
    "efecto_promocion_por_familia",
    "ventas_vs_petroleo_mensual",
    "sensibilidad_ciudades_petroleo",
    "ticket_promedio_por_tienda",
)


def summary(tables: dict[str, DataFrame], years: tuple[int, int] = OIL_FALL) -> DataFrame:
    """All findings in one nested row, under their public names; ``tables`` has those of ``SUMMARY_TABLES``."""
    spark = tables["ventas_por_familia"].sparkSession
    by_store = tables["ventas_por_tienda"]
    monthly = tables["ventas_vs_petroleo_mensual"]
    ticket = tables["ticket_promedio_por_tienda"]
    lags = corr_oil_sales_lags(monthly, years).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct(F.format_string("lag_%d_meses", "lag_meses"), F.col("correlacion"))
            )
        )
    )
    # The public names of the findings.
    findings = {
        "familia_mayor_volumen": F.try_element_at(_records(top_family(tables["ventas_por_familia"])), F.lit(1)),
        "top_10_tiendas": _records(top_stores(by_store)),
        "bottom_10_tiendas": _records(bottom_stores(by_store)),
        "impacto_feriados": _records(tables["ventas_feriado_vs_normal"]),
        "familias_mas_sensibles_a_feriados": _records(
            top_holiday_families(tables["sensibilidad_familias_feriados"])
        ),
        "familias_con_mayor_efecto_promocion": _records(
            top_promo_families(tables["efecto_promocion_por_familia"])
        ),
        "correlacion_petroleo_ventas": corr_oil_sales(monthly).scalar(),
        f"correlacion_lag_petroleo_{years[0]}_{years[1]}": lags.scalar(),
        "ciudades_mas_sensibles_caida_petroleo": _records(
            most_sensitive_cities(tables["sensibilidad_ciudades_petroleo"])
        ),
        "correlacion_transacciones_ventas": corr_transactions_sales(ticket).scalar(),
        "tiendas_ticket_alto": _records(high_ticket_stores(ticket)),
        "tiendas_ticket_bajo": _records(low_ticket_stores(ticket)),
    }
    one = spark.range(1)
    return one.select(*[value.alias(name) for name, value in findings.items()])
