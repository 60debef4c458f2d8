"""Data-quality profile of a table, taken before cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storesales.functions.casts import lenient_cast
from storesales.functions.numeric import pct_of

# Output columns of the quality table.
QUALITY_COLUMNS = [
    "archivo",
    "filas",
    "columnas",
    "filas_duplicadas",
    "porcentaje_duplicadas",
    "fecha_minima",
    "fecha_maxima",
]


def profile_table(
    df: DataFrame, name: str, ignore: tuple[str, ...] = (), unique: DataFrame | None = None
) -> DataFrame:
    """One row: row and column count, duplicate rows, date range.

    Two rows are duplicates if they agree in all columns but the technical keys
    in ``ignore``, NULL being equal to NULL. The rows are counted per distinct
    row first, and everything else is read off these counts: one scan, one
    shuffle. If ``unique`` has as many rows as ``df`` has distinct ones, as its
    cleaned version does, that table is counted instead and nothing is shuffled.
    """
    if "date" in df.columns:
        day = lenient_cast(F.col("date"), dict(df.dtypes)["date"], "date")
    else:
        day = F.lit(None).cast("date")
    span = [F.min(day).cast("string").alias("fecha_minima"), F.max(day).cast("string").alias("fecha_maxima")]
    if unique is None:
        compared = [c for c in df.columns if c not in ignore]
        rows = F.coalesce(F.sum("__copies"), F.lit(0))
        counted = df.groupBy(*compared).agg(F.count("*").alias("__copies"))
        seen = counted.agg(rows.alias("filas"), F.count("*").alias("distintas"), *span)
    else:
        distinct = unique.agg(F.count("*")).scalar()
        seen = df.agg(F.count("*").alias("filas"), *span).withColumn("distintas", distinct)
    duplicated = F.col("filas") - F.col("distintas")
    return seen.select(
        F.lit(name).alias("archivo"),
        "filas",
        F.lit(len(df.columns)).alias("columnas"),
        duplicated.alias("filas_duplicadas"),
        pct_of(duplicated, F.col("filas"), 4).alias("porcentaje_duplicadas"),
        "fecha_minima",
        "fecha_maxima",
    )


def profile_columns(df: DataFrame, name: str) -> DataFrame:
    """One row per column: type, NULL count and NULL share in percent. One scan, no shuffle of rows."""
    counts = df.agg(F.count("*").alias("filas"), F.array(*[F.count(F.col(c)) for c in df.columns]).alias("validos"))
    described = F.array(
        *[F.struct(F.lit(c).alias("columna"), F.lit(t).alias("tipo")) for c, t in df.dtypes]
    )
    rows = counts.select("filas", F.explode(F.arrays_zip(described.alias("c"), F.col("validos").alias("v"))).alias("z"))
    nulls: Column = F.col("filas") - F.col("z.v")
    return rows.select(
        F.lit(name).alias("archivo"),
        F.col("z.c.columna").alias("columna"),
        F.col("z.c.tipo").alias("tipo"),
        nulls.alias("nulos"),
        pct_of(nulls, F.col("filas"), 2).alias("porcentaje_nulos"),
    )


def quality_table(
    tables: dict[str, DataFrame],
    ignore: dict[str, tuple[str, ...]],
    unique: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``profile_table`` of all ``tables``, one row each."""
    known = unique or {}
    rows = [profile_table(df, name, ignore.get(name, ()), known.get(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def column_table(tables: dict[str, DataFrame]) -> DataFrame:
    """``profile_columns`` of all ``tables``, one row per table and column."""
    return reduce(DataFrame.unionByName, [profile_columns(df, name) for name, df in tables.items()])


def profile_report(quality: DataFrame, columns: DataFrame, names: list[str]) -> DataFrame:
    """The profile as one nested, time-stamped row, ready to be written as JSON."""
    detail = columns.groupBy("archivo").agg(
        F.map_from_entries(
            F.collect_list(F.struct("columna", F.struct("tipo", "nulos", "porcentaje_nulos")))
        ).alias("columnas_detalle")
    )
    dated = F.col("fecha_minima").isNotNull()
    span = F.struct(F.col("fecha_minima").alias("minimo"), F.col("fecha_maxima").alias("maximo"))
    described = quality.join(detail, "archivo").select(
        "archivo",
        F.struct(
            "archivo",
            "filas",
            "columnas",
            "columnas_detalle",
            "filas_duplicadas",
            "porcentaje_duplicadas",
            F.when(dated, span).alias("rango_fechas"),
        ).alias("perfil"),
    )
    perfiles = described.agg(
        F.map_from_entries(F.collect_list(F.struct("archivo", "perfil"))).alias("todos")
    )
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return perfiles.select(
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("generado_en"),
        F.lit("eda_inicial (antes de limpiar)").alias("etapa"),
        F.struct(*[F.col("todos")[n].alias(n) for n in names]).alias("archivos"),
    )
