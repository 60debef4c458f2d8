"""The five table cleaners and their metrics.

A cleaner works in two steps: ``stage`` (deduplicate, then fix types) and
``fill`` (impute NULLs). Deduplication comes first, so rows that become equal
only through a cast or an imputed value both stay. NULLs are counted between
the steps: a failed cast counts as imputed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.functions.casts import safe_cast, to_date_col
from storesales.operators.dedup import dedup, dedup_keep_first
from storesales.operators.impute import fill_constant, fill_median, fill_mode
from storesales.operators.series import fill_series

PLACES = ["city", "state", "type"]
HOLIDAY_TEXTS = ["type", "locale", "locale_name", "description"]


@dataclass(frozen=True)
class Cleaner:
    stage: Callable[[DataFrame], DataFrame]
    fill: Callable[[DataFrame], DataFrame]
    # Metric name -> columns whose NULLs it counts.
    imputed: dict[str, list[str]]

    def clean(self, raw: DataFrame) -> DataFrame:
        return self.fill(self.stage(raw))


def _stage_sales(raw: DataFrame) -> DataFrame:
    business = [c for c in raw.columns if c != "id"]
    # As text, '10' would come before '9'. The minimum leaves out ids that are no number.
    raw = safe_cast(raw, {"id": "bigint"})
    types = {"store_nbr": "int", "sales": "double", "onpromotion": "int", "family": "string"}
    return safe_cast(to_date_col(dedup_keep_first(raw, business, "id")), types)


def _stage_stores(raw: DataFrame) -> DataFrame:
    types = {"store_nbr": "int", "cluster": "int", "city": "string", "state": "string", "type": "string"}
    return safe_cast(dedup(raw), types)


def _stage_transactions(raw: DataFrame) -> DataFrame:
    return safe_cast(to_date_col(dedup(raw)), {"store_nbr": "int", "transactions": "bigint"})


def _stage_oil(raw: DataFrame) -> DataFrame:
    return safe_cast(to_date_col(dedup(raw)), {"dcoilwtico": "double"})


def _stage_holidays(raw: DataFrame) -> DataFrame:
    types = {**{c: "string" for c in HOLIDAY_TEXTS}, "transferred": "boolean"}
    return safe_cast(to_date_col(dedup(raw)), types)


# The metric names that reports and dashboards read.
CLEANERS = {
    "train": Cleaner(
        _stage_sales,
        lambda df: fill_constant(df, {"sales": 0.0, "onpromotion": 0}),
        {
            "nulos_sales_imputados_con_0": ["sales"],
            "nulos_onpromotion_imputados_con_0": ["onpromotion"],
        },
    ),
    "stores": Cleaner(
        _stage_stores,
        lambda df: fill_mode(df, PLACES),
        {"nulos_categoricos_imputados_con_moda": PLACES},
    ),
    "transactions": Cleaner(
        _stage_transactions,
        lambda df: fill_median(df, ["transactions"]),
        {"nulos_transactions_imputados_con_mediana": ["transactions"]},
    ),
    "oil": Cleaner(
        _stage_oil,
        lambda df: fill_series(df, "dcoilwtico", ["date"]),
        {"nulos_oil_imputados_con_interpolacion_lineal": ["dcoilwtico"]},
    ),
    "holidays": Cleaner(
        _stage_holidays,
        lambda df: fill_constant(fill_mode(df, HOLIDAY_TEXTS), {"transferred": False}),
        {
            "nulos_categoricos_imputados_con_moda": HOLIDAY_TEXTS,
            "nulos_transferred_imputados_con_false": ["transferred"],
        },
    ),
}


def clean_table(name: str, raw: DataFrame) -> DataFrame:
    """The cleaned version of source table ``name``."""
    return CLEANERS[name].clean(raw)


def table_metrics(name: str, raw: DataFrame, cleaned: DataFrame | None = None) -> DataFrame:
    """One row: duplicates removed, NULLs imputed per rule, final rows.

    Row counts of written tables come from the Parquet footers. The NULL counts
    filter before they deduplicate, so only rows with a NULL are shuffled.
    """
    cleaner = CLEANERS[name]
    staged = cleaner.stage(raw)
    final = staged if cleaned is None else cleaned
    counted = [c for columns in cleaner.imputed.values() for c in columns]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in counted])
    nulls = staged.where(any_null).agg(
        *[
            sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0)).cast("bigint").alias(metric)
            for metric, columns in cleaner.imputed.items()
        ]
    )
    before, after = (df.agg(F.count("*")).scalar() for df in (raw, final))
    return nulls.select(
        F.lit(name).alias("archivo"),
        (before - after).alias("duplicados_removidos"),
        *cleaner.imputed,
        after.alias("filas_finales"),
    )


def metrics_table(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame] | None = None) -> DataFrame:
    """The metrics of all tables; a metric that a table does not have is NULL."""
    rows = [table_metrics(name, raw[name], cleaned and cleaned[name]) for name in CLEANERS]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def metrics_report(metrics: DataFrame) -> DataFrame:
    """The metrics as one nested row: table -> its own metrics."""
    kinds = {
        name: ["duplicados_removidos", *cleaner.imputed, "filas_finales"]
        for name, cleaner in CLEANERS.items()
    }
    return metrics.agg(
        *[
            F.max(F.when(F.col("archivo") == name, F.struct(*columns))).alias(name)
            for name, columns in kinds.items()
        ]
    )
