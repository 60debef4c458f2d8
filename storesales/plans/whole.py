"""What the job does around its tables, over the test tables: load, store, summarise, export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.fixtures import FIXTURE_FALL
from storesales.plans.analytics import ANALYTIC_TABLES, DAY_FAMILY_TABLES, around_events, city_period_sensitivity, sales_city_period
from storesales.plans.findings import SUMMARY_TABLES, summary
from storesales.plans.measures import DAY_FAMILY, STORE_YEAR
from storesales.plans.warehouse import Warehouse
from storesales.sources.csv import load_all
from storesales.sources.schemas import RAW_FILES
from storesales.sources.shared import checkpoint, concurrently, cut, new_path
from storesales.sources.sinks import export_all, parquet_sink

# Public table names, and the main measure of each.
MEASURES = {
    "ventas_por_familia": "ventas_totales",
    "ventas_por_tienda": "ventas_totales",
    "ventas_promedio_por_ciudad": "ventas_promedio",
    "ventas_promedio_por_provincia": "ventas_promedio",
    "evolucion_ventas_mensual": "ventas_totales",
    "evolucion_ventas_anual": "ventas_totales",
    "ventas_feriado_vs_normal": "ventas_promedio",
    "ventas_alrededor_feriados_por_familia": "ventas_promedio",
    "sensibilidad_familias_feriados": "variacion_porcentual",
    "ventas_con_sin_promocion_por_familia": "ventas_promedio",
    "efecto_promocion_por_familia": "efecto_promocion_pct",
    "ventas_vs_petroleo_mensual": "ventas_totales",
    "ventas_ciudad_periodo_petroleo": "ventas_promedio",
    "sensibilidad_ciudades_petroleo": "variacion_pct",
    "ticket_promedio_por_tienda": "ticket_promedio",
}

# Public names of findings, and the columns that name their rows and hold their measure.
RANKINGS = {
    "top_10_tiendas": ("store_nbr", "ventas_totales"),
    "bottom_10_tiendas": ("store_nbr", "ventas_totales"),
    "impacto_feriados": ("es_feriado", "ventas_totales"),
    "familias_mas_sensibles_a_feriados": ("family", "variacion_porcentual"),
    "familias_con_mayor_efecto_promocion": ("family", "efecto_promocion_pct"),
    "ciudades_mas_sensibles_caida_petroleo": ("city", "variacion_pct"),
    "tiendas_ticket_alto": ("store_nbr", "ticket_promedio"),
    "tiendas_ticket_bajo": ("store_nbr", "ticket_promedio"),
}


def csv_load(w: Warehouse) -> DataFrame:
    """The raw tables written as CSV and loaded again: the sales."""
    source = new_path(w.spark, "csv")
    for name, df in w.all_raw().items():
        df.write.csv(f"{source}/{RAW_FILES[name]}", header=True)
    return load_all(w.spark, source, new_path(w.spark, "csv-loaded"))["train"]


def partitioned_checkpoint(w: Warehouse) -> DataFrame:
    """Rows per year of the wide table stored by year, of the years from the fall on."""
    dated = w.consolidated().withColumn("anio", F.year("date"))
    stored = checkpoint(dated, new_path(w.spark, "by-year"), ("anio",))
    return stored.where(F.col("anio") >= FIXTURE_FALL[0]).groupBy("anio").agg(F.count("*").alias("filas"))


def event_windows(w: Warehouse) -> DataFrame:
    """Sales rows in the window of each holiday."""
    rows = w.consolidated()
    holidays = rows.where("es_feriado").select("date").distinct()
    daily = rows.groupBy("date").agg(F.count("*").alias("n"))
    near = around_events(holidays, daily)
    return near.select("date_feriado", "offset_dias", F.col("n").alias("num_registros"))


def _tables(w: Warehouse) -> dict[str, DataFrame]:
    """The analytic tables by way of the two rollups, as in the job."""
    rows = w.measures()
    grains = {"dia_familia": DAY_FAMILY, "tienda_anio": STORE_YEAR}
    sums = concurrently(w.spark, lambda grain: rows.on(cut(rows.rollup(*grains[grain]).frame, grain)), grains)

    def table(name: str) -> DataFrame:
        make = ANALYTIC_TABLES[name]
        source = sums["dia_familia" if name in DAY_FAMILY_TABLES else "tienda_anio"]
        return make(source, FIXTURE_FALL) if make in (sales_city_period, city_period_sensitivity) else make(source)

    return {name: table(name) for name in ANALYTIC_TABLES}


def _union(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def job_tables(w: Warehouse) -> DataFrame:
    """Rows and the largest value of every analytic table."""
    return _union(
        [
            df.agg(
                F.lit(name).alias("tabla"), F.count("*").alias("filas"), F.max(MEASURES[name]).alias("valor_maximo")
            )
            for name, df in _tables(w).items()
        ]
    )


def summary_report(w: Warehouse) -> DataFrame:
    """The rankings of the summary, a row per entry."""
    tables = _tables(w)
    read = concurrently(w.spark, lambda name: cut(tables[name], name), SUMMARY_TABLES)
    found = cut(summary(read, FIXTURE_FALL), "summary")
    return _union(
        [
            found.select(F.explode(name).alias("entry")).select(
                F.lit(name).alias("hallazgo"),
                F.col(f"entry.{key}").cast("string").alias("clave"),
                F.col(f"entry.{value}").alias("valor"),
            )
            for name, (key, value) in RANKINGS.items()
        ]
    )


def exported_tables(w: Warehouse) -> DataFrame:
    """Names and rows of what an export of the wide and the analytic tables stores."""
    folder = new_path(w.spark, "export")
    names = export_all(parquet_sink(folder), w.consolidated(), _tables(w))
    stored = [w.spark.read.parquet(f"{folder}/{name}") for name in names]
    return _union(
        [df.agg(F.lit(name).alias("tabla"), F.count("*").alias("filas")) for name, df in zip(names, stored, strict=True)]
    )
