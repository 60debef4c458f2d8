"""Every operator and table as a query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storesales.fixtures import FIXTURE_FALL
from storesales.functions.casts import safe_cast, to_date_col
from storesales.operators.dedup import dedup, dedup_keep_first
from storesales.operators.impute import fill_median, fill_mode
from storesales.operators.join import check_cardinality
from storesales.operators.profile import column_table, quality_table
from storesales.operators.series import fill_backward, fill_forward, interpolate_linear
from storesales.plans import analytics as a
from storesales.plans import findings as f
from storesales.plans import whole
from storesales.plans.clean import CLEANERS, clean_table, metrics_table
from storesales.plans.consolidate import summarise_holidays
from storesales.plans.warehouse import Warehouse
from storesales.sources.schemas import TECHNICAL_KEYS

Query = Callable[[SparkSession, str], DataFrame]


def _lenient_casts(w: Warehouse) -> DataFrame:
    """Sales as text with values that do not fit, cast back."""
    key = F.col("id")
    text = w.raw("train").select(
        "id",
        F.when(key % 7 == 0, "no date").otherwise(F.col("date").cast("string")).alias("date"),
        F.when(key % 11 == 0, "x")
        .otherwise(F.concat(F.col("store_nbr").cast("string"), F.lit(".0")))
        .alias("store_nbr"),
        F.when(key % 13 == 0, "")
        .otherwise(F.col("sales").cast("decimal(18,2)").cast("string"))
        .alias("sales"),
        F.when(key % 17 != 0, (F.col("onpromotion") > 0).cast("string")).alias("tiene_promocion"),
    )
    return safe_cast(
        to_date_col(text), {"store_nbr": "int", "sales": "double", "tiene_promocion": "boolean"}
    )


def _rounded(table: DataFrame) -> DataFrame:
    """Correlations to the six places in which two engines agree."""
    return table.withColumn("correlacion", F.round("correlacion", 6))


def _oil(w: Warehouse) -> DataFrame:
    return CLEANERS["oil"].stage(w.raw("oil"))


OPERATORS = {
    "profile_tables": lambda w: quality_table(w.all_raw(), TECHNICAL_KEYS),
    "profile_columns": lambda w: column_table(w.all_raw()),
    "dedup_full_row": lambda w: dedup(w.raw("stores")),
    "dedup_keep_first": lambda w: dedup_keep_first(
        w.raw("train"), ["date", "store_nbr", "family", "sales", "onpromotion"], "id"
    ),
    "lenient_casts": _lenient_casts,
    "impute_mode": lambda w: fill_mode(dedup(w.raw("stores")), ["city", "state", "type"]),
    "impute_median": lambda w: fill_median(dedup(w.raw("transactions")), ["transactions"]),
    "interpolate_oil": lambda w: interpolate_linear(_oil(w), "dcoilwtico", ["date"]),
    "fill_forward": lambda w: fill_forward(_oil(w), "dcoilwtico", ["date"]),
    "fill_backward": lambda w: fill_backward(_oil(w), "dcoilwtico", ["date"]),
    "clean_sales": lambda w: clean_table("train", w.raw("train")),
    "clean_stores": lambda w: clean_table("stores", w.raw("stores")),
    "clean_transactions": lambda w: clean_table("transactions", w.raw("transactions")),
    "clean_oil": lambda w: clean_table("oil", w.raw("oil")),
    "clean_holidays": lambda w: clean_table("holidays", w.raw("holidays")),
    "cleaning_metrics": lambda w: metrics_table(w.all_raw(), w.all_clean()),
    "holiday_summary": lambda w: summarise_holidays(w.clean("holidays")),
    "flagship_consolidated": lambda w: w.joined(),
    "csv_load": whole.csv_load,
    "partitioned_checkpoint": whole.partitioned_checkpoint,
    "event_windows": whole.event_windows,
    "job_tables": whole.job_tables,
    "summary_report": whole.summary_report,
    "exported_tables": whole.exported_tables,
    "join_cardinality": lambda w: check_cardinality(w.clean("train"), w.consolidated()),
}

TABLES = {
    "sales_by_family": a.sales_by_family,
    "sales_by_store": a.sales_by_store,
    "avg_sales_by_city": a.avg_sales_by_city,
    "avg_sales_by_state": a.avg_sales_by_state,
    "sales_monthly": a.sales_monthly,
    "sales_yearly": a.sales_yearly,
    "holiday_vs_normal": a.holiday_vs_normal,
    "sales_around_holidays": a.sales_around_holidays,
    "holiday_sensitivity": a.holiday_sensitivity,
    "sales_promo_split": a.sales_promo_split,
    "promo_effect": a.promo_effect,
    "sales_vs_oil_monthly": a.sales_vs_oil_monthly,
    "sales_city_period": lambda m: a.sales_city_period(m, FIXTURE_FALL),
    "city_period_sensitivity": lambda m: a.city_period_sensitivity(m, FIXTURE_FALL),
    "avg_ticket_by_store": a.avg_ticket_by_store,
}

# Finding -> the table it is read off and how.
FINDINGS = {
    "top_family": ("sales_by_family", f.top_family),
    "top_stores": ("sales_by_store", f.top_stores),
    "bottom_stores": ("sales_by_store", f.bottom_stores),
    "top_holiday_families": ("holiday_sensitivity", f.top_holiday_families),
    "top_promo_families": ("promo_effect", f.top_promo_families),
    "most_sensitive_cities": ("city_period_sensitivity", f.most_sensitive_cities),
    "high_ticket_stores": ("avg_ticket_by_store", f.high_ticket_stores),
    "low_ticket_stores": ("avg_ticket_by_store", f.low_ticket_stores),
    "corr_oil_sales": ("sales_vs_oil_monthly", lambda t: _rounded(f.corr_oil_sales(t))),
    "corr_oil_sales_lags": (
        "sales_vs_oil_monthly",
        lambda t: _rounded(f.corr_oil_sales_lags(t, FIXTURE_FALL)),
    ),
    "corr_transactions_sales": (
        "avg_ticket_by_store",
        lambda t: _rounded(f.corr_transactions_sales(t)),
    ),
}


def _on_warehouse(make: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(Warehouse(spark, sf_dir))


def _on_table(name: str, read: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_warehouse(lambda w: read(TABLES[name](w.measures())))


def queries() -> dict[str, Query]:
    """Query name -> function of session and data folder."""
    return {
        **{name: _on_warehouse(make) for name, make in OPERATORS.items()},
        **{name: _on_table(name, lambda t: t) for name in TABLES},
        **{name: _on_table(table, read) for name, (table, read) in FINDINGS.items()},
    }
