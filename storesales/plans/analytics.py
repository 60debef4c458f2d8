"""The fifteen analytic tables.

Each takes :class:`Measures` at any grain that has its keys and returns its
table sorted, ties broken by the key. Means of two subsets side by side are
conditional aggregates: one pass and one shuffle, no pivot, no self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storesales.functions.numeric import pct_change
from storesales.plans.measures import Measures

# First and last year of the fall of the oil price.
OIL_FALL = (2015, 2016)

# Days before and after a holiday, labels of the two oil periods.
EVENT_DAYS = 3
FALL_LABEL = "caida_petroleo"
OTHER_LABEL = "otro_periodo"


def sales_by_family(m: Measures) -> DataFrame:
    """Total sales by product family."""
    return m.by("family", ventas_totales=m.total()).orderBy(F.desc("ventas_totales"), "family")


def sales_by_store(m: Measures) -> DataFrame:
    """Total sales by store."""
    return m.by("store_nbr", ventas_totales=m.total()).orderBy(F.desc("ventas_totales"), "store_nbr")


def avg_sales_by_city(m: Measures) -> DataFrame:
    """Mean sales by city; sales without a known city are a group of their own."""
    return m.by("city", ventas_promedio=m.mean()).orderBy(F.desc_nulls_first("ventas_promedio"), "city")


def avg_sales_by_state(m: Measures) -> DataFrame:
    """Mean sales by state."""
    return m.by("state", ventas_promedio=m.mean()).orderBy(F.desc_nulls_first("ventas_promedio"), "state")


def sales_monthly(m: Measures) -> DataFrame:
    """Total sales by month."""
    return m.by("anio", "mes", ventas_totales=m.total()).orderBy("anio", "mes")


def sales_yearly(m: Measures) -> DataFrame:
    """Total sales by year."""
    return m.by("anio", ventas_totales=m.total()).orderBy("anio")


def holiday_vs_normal(m: Measures) -> DataFrame:
    """Mean, total and number of sales rows, on holidays and otherwise."""
    return m.by(
        "es_feriado", ventas_promedio=m.mean(), ventas_totales=m.total(), num_registros=F.sum("rows_n")
    ).orderBy("es_feriado")


def around_events(events: DataFrame, facts: DataFrame, days: int = EVENT_DAYS) -> DataFrame:
    """``facts`` within ``days`` of each event date, once per event and offset.

    The offsets are spelled out, so the window is an equi-join on the date.
    """
    offsets = F.explode(F.sequence(F.lit(-days), F.lit(days)))
    windows = events.select(F.col("date").alias("date_feriado"), offsets.alias("offset_dias"))
    dated = windows.withColumn("date", F.date_add("date_feriado", F.col("offset_dias")))
    return facts.join(dated, "date")


def sales_around_holidays(m: Measures, days: int = EVENT_DAYS) -> DataFrame:
    """Mean sales by family and day relative to a holiday.

    Sales are summed per day and family first, in the only scan; these sums are
    dealt to the days whose windows they fall into. A day is a holiday if its own
    sales say so, so nothing is joined. A day's part of the window has a few
    rows per family.
    """
    daily = m.rollup("date", "family", "es_feriado").frame
    offsets = F.explode(F.sequence(F.lit(-days), F.lit(days)))
    dealt = daily.withColumn("offset_dias", offsets).withColumn(
        "date_feriado", F.date_sub("date", F.col("offset_dias"))
    )
    own = F.coalesce("es_feriado", F.lit(False)) & (F.col("offset_dias") == 0)
    flagged = dealt.withColumn("__event", F.max(own).over(Window.partitionBy("date_feriado")))
    near = m.on(flagged.where("__event").drop("__event"))
    table = near.by("offset_dias", "family", ventas_promedio=near.mean())
    return table.orderBy("family", "offset_dias")


def holiday_sensitivity(m: Measures) -> DataFrame:
    """Change of a family's mean sales on holidays, for families sold on both kinds of day."""
    means = m.by(
        "family",
        ventas_promedio_normal=m.mean(~F.col("es_feriado")),
        ventas_promedio_feriado=m.mean(F.col("es_feriado")),
    )
    change = pct_change(F.col("ventas_promedio_feriado"), F.col("ventas_promedio_normal"))
    return (
        means.where("ventas_promedio_normal IS NOT NULL AND ventas_promedio_feriado IS NOT NULL")
        .withColumn("variacion_porcentual", change)
        .orderBy(F.desc_nulls_first("variacion_porcentual"), "family")
    )


def sales_promo_split(m: Measures) -> DataFrame:
    """Mean sales by family, with and without promotion."""
    return m.by("family", "tiene_promocion", ventas_promedio=m.mean()).orderBy("family", "tiene_promocion")


def promo_effect(m: Measures) -> DataFrame:
    """The split side by side, with the effect of promotion; NULL for families without both sides."""
    promoted = F.col("tiene_promocion")
    means = m.by("family", true=m.mean(promoted), false=m.mean(~promoted))
    effect = pct_change(F.col("true"), F.col("false"))
    return means.withColumn("efecto_promocion_pct", effect).orderBy(
        F.desc_nulls_first("efecto_promocion_pct"), "family"
    )


def sales_vs_oil_monthly(m: Measures) -> DataFrame:
    """Total sales and mean oil price by month, complete months only."""
    months = m.by("anio", "mes", ventas_totales=m.total(), precio_petroleo_promedio=m.mean_oil())
    complete = " AND ".join(f"{c} IS NOT NULL" for c in months.columns)
    return months.where(complete).orderBy("anio", "mes")


def _in_fall(years: tuple[int, int]):
    return F.coalesce(F.col("anio").between(*years), F.lit(False))


def sales_city_period(m: Measures, years: tuple[int, int] = OIL_FALL) -> DataFrame:
    """Mean sales by city, during the fall of the oil price and in other years."""
    period = F.when(_in_fall(years), F.lit(FALL_LABEL)).otherwise(F.lit(OTHER_LABEL))
    dated = m.on(m.frame.withColumn("periodo", period))
    return dated.by("city", "periodo", ventas_promedio=m.mean()).orderBy("city", "periodo")


def city_period_sensitivity(m: Measures, years: tuple[int, int] = OIL_FALL) -> DataFrame:
    """Both periods side by side, with the change during the fall."""
    means = m.by(
        "city",
        **{FALL_LABEL: m.mean(_in_fall(years)), OTHER_LABEL: m.mean(~_in_fall(years))},
    )
    change = pct_change(F.col(FALL_LABEL), F.col(OTHER_LABEL))
    return means.withColumn("variacion_pct", change).orderBy("variacion_pct", "city")


def avg_ticket_by_store(m: Measures) -> DataFrame:
    """Total sales per mean daily transaction count, by store."""
    stores = m.by("store_nbr", transacciones_promedio=m.mean_traffic(), ventas_totales=m.total())
    ticket = F.try_divide("ventas_totales", "transacciones_promedio")
    return stores.withColumn("ticket_promedio", ticket).orderBy(
        F.desc_nulls_first("ticket_promedio"), "store_nbr"
    )


# Public table names.
DAY_FAMILY_TABLES = {
    "ventas_por_familia": sales_by_family,
    "evolucion_ventas_mensual": sales_monthly,
    "evolucion_ventas_anual": sales_yearly,
    "ventas_feriado_vs_normal": holiday_vs_normal,
    "ventas_alrededor_feriados_por_familia": sales_around_holidays,
    "sensibilidad_familias_feriados": holiday_sensitivity,
    "ventas_con_sin_promocion_por_familia": sales_promo_split,
    "efecto_promocion_por_familia": promo_effect,
    "ventas_vs_petroleo_mensual": sales_vs_oil_monthly,
}
STORE_YEAR_TABLES = {
    "ventas_por_tienda": sales_by_store,
    "ventas_promedio_por_ciudad": avg_sales_by_city,
    "ventas_promedio_por_provincia": avg_sales_by_state,
    "ventas_ciudad_periodo_petroleo": sales_city_period,
    "sensibilidad_ciudades_petroleo": city_period_sensitivity,
    "ticket_promedio_por_tienda": avg_ticket_by_store,
}
ANALYTIC_TABLES = {**DAY_FAMILY_TABLES, **STORE_YEAR_TABLES}
