"""The whole job: load, clean, profile, consolidate, analyse, export.

Stages are cut at written tables, so a stage never computes an earlier one
again, and a failing stage stops the job with the earlier results in place.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from storesales.operators.join import check_cardinality
from storesales.operators.profile import column_table, profile_report, quality_table
from storesales.plans.analytics import (
    ANALYTIC_TABLES,
    DAY_FAMILY_TABLES,
    OIL_FALL,
    city_period_sensitivity,
    sales_city_period,
)
from storesales.plans.clean import CLEANERS, clean_table, metrics_report, metrics_table
from storesales.plans.consolidate import consolidate
from storesales.plans.findings import summary
from storesales.plans.measures import DAY_FAMILY, STORE_YEAR, Measures
from storesales.sources.csv import load_all
from storesales.sources.schemas import TECHNICAL_KEYS
from storesales.sources.shared import checkpoint, concurrently, scratch
from storesales.sources.sizing import size_shuffles, size_tasks
from storesales.sources.sinks import Sink, export_all, write_report

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobResult:
    raw: dict[str, DataFrame]
    cleaned: dict[str, DataFrame]
    consolidated: DataFrame
    tables: dict[str, DataFrame]
    quality: DataFrame
    metrics: DataFrame
    summary: DataFrame


def profile_stage(raw: dict[str, DataFrame], out: str) -> DataFrame:
    """Profile all raw tables, before and apart from cleaning; returns the quality table."""
    quality = checkpoint(quality_table(raw, TECHNICAL_KEYS), f"{out}/reports/calidad_datos_inicial")
    write_report(profile_report(quality, column_table(raw), list(raw)), f"{out}/reports/eda_inicial")
    return quality


def clean_stage(raw: dict[str, DataFrame], out: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean all raw tables; returns them with their metrics."""
    spark = raw["train"].sparkSession
    cleaned = concurrently(
        spark, lambda name: checkpoint(clean_table(name, raw[name]), f"{out}/clean/{name}"), CLEANERS
    )
    metrics = checkpoint(metrics_table(raw, cleaned), f"{out}/reports/metricas_limpieza_tabla")
    write_report(metrics_report(metrics), f"{out}/reports/metricas_limpieza")
    return cleaned, metrics


def consolidate_stage(cleaned: dict[str, DataFrame], out: str) -> DataFrame:
    """Write the wide table; warns if the joins changed the number of rows."""
    sales = cleaned["train"]
    wide = consolidate(
        sales, cleaned["stores"], cleaned["transactions"], cleaned["oil"], cleaned["holidays"]
    )
    written = checkpoint(wide, f"{out}/consolidated")
    rows = check_cardinality(sales, written).first()
    if not rows["preserved"]:
        logger.warning(
            "the joins changed the number of rows from %d to %d: look for duplicate keys in the joined tables",
            rows["base_rows"],
            rows["output_rows"],
        )
    return written


def analyse_stage(
    consolidated: DataFrame, out: str, scale: int | None, oil_scale: int | None, years: tuple[int, int]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write all analytic tables and the summary, from two scans of the wide table."""
    rows = Measures.of(consolidated, scale, oil_scale)
    grains = {"dia_familia": DAY_FAMILY, "tienda_anio": STORE_YEAR}
    spark = consolidated.sparkSession

    def rollup(grain: str) -> Measures:
        return rows.on(checkpoint(rows.rollup(*grains[grain]).frame, f"{out}/rollups/{grain}"))

    sums = concurrently(spark, rollup, grains)

    def table(name: str) -> DataFrame:
        make = ANALYTIC_TABLES[name]
        source = sums["dia_familia" if name in DAY_FAMILY_TABLES else "tienda_anio"]
        dated = make in (sales_city_period, city_period_sensitivity)
        return checkpoint(make(source, years) if dated else make(source), f"{out}/tables/{name}")

    tables = concurrently(spark, table, ANALYTIC_TABLES)
    findings = checkpoint(summary(tables, years), f"{out}/reports/eda_profundo_tabla")
    write_report(findings, f"{out}/reports/eda_profundo")
    return tables, findings


def _saved(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def export_saved(spark: SparkSession, out: str, sink: Sink) -> list[str]:
    """Export what an earlier run left in ``out``; only the consolidated table must be there."""
    consolidated = spark.read.parquet(f"{out}/consolidated")
    found = {name: _saved(spark, f"{out}/tables/{name}") for name in ANALYTIC_TABLES}
    return export_all(
        sink,
        consolidated,
        {name: df for name, df in found.items() if df is not None},
        _saved(spark, f"{out}/reports/calidad_datos_inicial"),
        _saved(spark, f"{out}/reports/metricas_limpieza_tabla"),
    )


def run_job(
    spark: SparkSession,
    source_dir: str,
    out: str,
    sink: Sink | None = None,
    scale: int | None = None,
    oil_scale: int | None = None,
    years: tuple[int, int] = OIL_FALL,
    multi_line: bool = False,
) -> JobResult:
    """All stages in order, from the CSV files in ``source_dir`` to ``out`` and ``sink``."""
    with scratch(spark):
        raw = load_all(spark, source_dir, f"{out}/raw", multi_line)
        size_shuffles(spark, raw.values())
        size_tasks(spark)
        quality = profile_stage(raw, out)
        cleaned, metrics = clean_stage(raw, out)
        consolidated = consolidate_stage(cleaned, out)
        tables, findings = analyse_stage(consolidated, out, scale, oil_scale, years)
        if sink is not None:
            export_all(sink, consolidated, tables, quality, metrics)
    return JobResult(raw, cleaned, consolidated, tables, quality, metrics, findings)
