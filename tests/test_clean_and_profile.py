"""The five cleaners, their metrics and the profile on literal rows."""

import datetime

from storesales.operators.profile import profile_columns, profile_table
from storesales.plans.clean import CLEANERS, clean_table, metrics_report, metrics_table, table_metrics

D1, D2 = datetime.date(2015, 1, 1), datetime.date(2015, 1, 2)


def sales(spark):
    return spark.createDataFrame(
        [
            (5, "2015-01-01", "1.0", "A", "2.5", None),
            (2, "2015-01-01", "1.0", "A", "2.5", None),
            (3, "2015-01-01", "1", "A", "2.5", None),
            (4, "bad", "x", "B", "oops", "3"),
            (6, "2015-01-02", "2", "B", None, "0"),
        ],
        "id long, date string, store_nbr string, family string, sales string, onpromotion string",
    )


def raw_tables(spark):
    return {
        "train": sales(spark),
        "stores": spark.createDataFrame(
            [(1, "Q", None, "A", 1), (1, "Q", None, "A", 1), (2, "Q", "P", None, 2), (3, None, "P", "A", 3)],
            "store_nbr int, city string, state string, type string, cluster int",
        ),
        "transactions": spark.createDataFrame(
            [(D1, 1, 10), (D1, 2, None), (D2, 1, 21)], "date date, store_nbr int, transactions bigint"
        ),
        "oil": spark.createDataFrame([(D1, None), (D2, 50.0)], "date date, dcoilwtico double"),
        "holidays": spark.createDataFrame(
            [(D1, "Holiday", "National", "E", None, None), (D2, None, "National", "E", "x", True)],
            "date date, type string, locale string, locale_name string, description string, transferred boolean",
        ),
    }


def test_sales_are_deduplicated_before_the_casts(spark):
    found = {r["id"]: tuple(r)[1:] for r in clean_table("train", sales(spark)).collect()}
    assert found == {
        2: (D1, 1, "A", 2.5, 0),
        3: (D1, 1, "A", 2.5, 0),
        4: (None, None, "B", 0.0, 3),
        6: (D2, 2, "B", 0.0, 0),
    }


def test_failed_casts_count_as_imputed(spark):
    row = table_metrics("train", sales(spark)).first().asDict()
    assert row == {
        "archivo": "train",
        "duplicados_removidos": 1,
        "nulos_sales_imputados_con_0": 2,
        "nulos_onpromotion_imputados_con_0": 2,
        "filas_finales": 4,
    }


def test_cleaned_tables_have_no_nulls_where_imputed(spark):
    for name, raw in raw_tables(spark).items():
        cleaned = clean_table(name, raw)
        for columns in CLEANERS[name].imputed.values():
            for c in columns:
                assert cleaned.where(f"{c} IS NULL").count() == 0, (name, c)


def test_cleaner_types(spark):
    types = {name: dict(clean_table(name, raw).dtypes) for name, raw in raw_tables(spark).items()}
    assert types["train"] == {
        "id": "bigint", "date": "date", "store_nbr": "int", "family": "string", "sales": "double", "onpromotion": "int",
    }
    assert types["transactions"]["transactions"] == "double"
    assert types["holidays"]["transferred"] == "boolean"


def test_metrics_are_the_same_with_written_results(spark):
    raw = raw_tables(spark)
    cleaned = {name: clean_table(name, df) for name, df in raw.items()}
    without, given = metrics_table(raw), metrics_table(raw, cleaned)
    assert sorted(map(str, without.collect())) == sorted(map(str, given.collect()))
    report = metrics_report(given).first().asDict(recursive=True)
    assert report["stores"] == {
        "duplicados_removidos": 1, "nulos_categoricos_imputados_con_moda": 3, "filas_finales": 3,
    }
    assert report["oil"]["nulos_oil_imputados_con_interpolacion_lineal"] == 1
    assert report["holidays"] == {
        "duplicados_removidos": 0,
        "nulos_categoricos_imputados_con_moda": 2,
        "nulos_transferred_imputados_con_false": 1,
        "filas_finales": 2,
    }


def test_cleaning_twice_may_remove_more(spark):
    data = [(1, D1, 1, "A", None, 0), (2, D1, 1, "A", 0.0, 0)]
    df = spark.createDataFrame(data, "id long, date date, store_nbr int, family string, sales double, onpromotion int")
    once = clean_table("train", df)
    assert once.count() == 2
    assert clean_table("train", once).count() == 1


def test_profile_of_text_dates_and_duplicates(spark):
    row = profile_table(sales(spark), "train", ("id",)).first().asDict()
    assert row == {
        "archivo": "train",
        "filas": 5,
        "columnas": 6,
        "filas_duplicadas": 1,
        "porcentaje_duplicadas": 20.0,
        "fecha_minima": "2015-01-01",
        "fecha_maxima": "2015-01-02",
    }
    assert profile_table(sales(spark), "train").first()["filas_duplicadas"] == 0
    columns = {r["columna"]: (r["tipo"], r["nulos"], r["porcentaje_nulos"]) for r in profile_columns(sales(spark), "t").collect()}
    assert columns["onpromotion"] == ("string", 3, 60.0)
    assert columns["id"] == ("bigint", 0, 0.0)


def test_profile_of_an_empty_table_without_dates(spark):
    empty = raw_tables(spark)["stores"].limit(0)
    row = profile_table(empty, "stores").first()
    assert (row["filas"], row["filas_duplicadas"], row["porcentaje_duplicadas"]) == (0, 0, 0.0)
    assert row["fecha_minima"] is None and row["fecha_maxima"] is None
    assert {r["porcentaje_nulos"] for r in profile_columns(empty, "stores").collect()} == {0.0}


def test_profile_from_the_cleaned_table_is_the_same(spark):
    for name, raw in raw_tables(spark).items():
        ignore = ("id",) if name == "train" else ()
        cleaned = clean_table(name, raw)
        assert profile_table(raw, name, ignore, cleaned).collect() == profile_table(raw, name, ignore).collect()


def test_the_smallest_id_is_a_number(spark):
    rows = [("10", "a"), ("9", "a"), ("x", "a"), ("x", "b")]
    raw = spark.createDataFrame(rows, "id string, family string").selectExpr(
        "id", "'2015-01-01' AS date", "1 AS store_nbr", "family", "1.0D AS sales", "0 AS onpromotion"
    )
    staged = CLEANERS["train"].stage(raw)
    assert dict(staged.dtypes)["id"] == "bigint"
    assert sorted(((r["family"], r["id"]) for r in staged.collect()), key=str) == [("a", 9), ("b", None)]
