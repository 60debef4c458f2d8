"""Joins, analytic tables and findings on literal rows, and the shape of their plans."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from storesales.operators.join import check_cardinality, left_join, measured_bytes, small_sides
from storesales.plans import analytics as a
from storesales.plans import findings as f
from storesales.plans.consolidate import consolidate, summarise_holidays
from storesales.plans.measures import DAY_FAMILY, STORE_YEAR, Measures

DAY = datetime.date(2015, 6, 10)
SALES = "id long, date date, store_nbr int, family string, sales double, onpromotion int"
STORES = "store_nbr int, city string, state string, type string, cluster int"
TRAFFIC = "date date, store_nbr int, transactions double"
OIL = "date date, dcoilwtico double"
HOLIDAYS = "date date, type string, locale string, locale_name string, description string, transferred boolean"
WIDE = (
    "date date, store_nbr int, family string, sales double, onpromotion int, city string, state string, "
    "transactions double, dcoilwtico double, es_feriado boolean"
)


def day(n):
    return DAY + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def clean(spark):
    rng = random.Random(3)
    sales = []
    for i in range(600):
        hot = i % 3 == 0
        sales.append(
            (i, DAY if hot else day(rng.randrange(40)), 1 if hot else rng.randrange(5), rng.choice("ABC"), rng.randrange(999) / 4, rng.randrange(3))
        )
    sales.append((600, None, None, "A", 1.0, 0))
    return {
        "sales": spark.createDataFrame(sales, SALES),
        "stores": spark.createDataFrame([(s, f"c{s % 3}", "st", "A", s) for s in range(4)], STORES),
        "transactions": spark.createDataFrame(
            [(day(n), s, float(n + s)) for n in range(40) for s in range(5) if (n + s) % 7], TRAFFIC
        ),
        "oil": spark.createDataFrame([(day(n), 40.0 + n) for n in range(0, 40, 2)], OIL),
        "holidays": spark.createDataFrame(
            [
                (day(0), "Holiday", "National", "E", "b", None),
                (day(0), "Event", "Local", "Q", "a", None),
                (day(5), "Event", "National", "E", "e", True),
                (day(2), "Holiday", "Regional", "R", "r", False),
            ],
            HOLIDAYS,
        ),
    }


def test_holiday_summary(spark, clean):
    found = {r["date"]: tuple(r)[1:] for r in summarise_holidays(clean["holidays"]).collect()}
    assert found[day(0)] == (True, False, "Local", "Q", "a")
    assert found[day(5)] == (False, True, "National", "E", "e")


def test_consolidated_rows_and_columns(clean):
    out = consolidate(**clean)
    assert out.columns == [
        "id", "date", "store_nbr", "family", "sales", "onpromotion", "city", "state", "type", "cluster",
        "transactions", "dcoilwtico", "es_feriado", "feriado_transferido", "feriado_locale",
        "feriado_locale_name", "feriado_descripcion",
    ]
    assert check_cardinality(clean["sales"], out).first()["preserved"]
    assert out.where("es_feriado IS NULL OR feriado_transferido IS NULL").count() == 0
    lost = out.where("id = 600").first()
    assert (lost["city"], lost["transactions"], lost["es_feriado"]) == (None, None, False)
    assert out.where("store_nbr = 4 AND city IS NOT NULL").count() == 0


def test_joins_without_broadcast_give_the_same(clean, settings):
    expected = sorted(map(str, consolidate(**clean).collect()))
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    assert sorted(map(str, consolidate(**clean, broadcast_bytes=0).collect())) == expected


def test_a_hot_store_day_is_split(spark, clean, settings):
    settings(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500",
        }
    )
    hot = consolidate(**{**clean, "sales": clean["sales"].repartition(16)})
    assert hot.count() == 601
    hot.collect()
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_duplicate_dimension_keys_multiply_and_are_reported(clean):
    twice = {**clean, "oil": clean["oil"].union(clean["oil"].limit(1).withColumn("dcoilwtico", F.lit(1.0)))}
    guard = check_cardinality(clean["sales"], consolidate(**twice)).first()
    assert guard["output_rows"] > guard["base_rows"] and not guard["preserved"]


def test_taken_names_get_a_suffix(spark):
    left = spark.createDataFrame([(1, "l")], "k int, note string")
    right = spark.createDataFrame([(1, "r")], "k int, note string")
    assert left_join(left, right, ["k"]).first().asDict() == {"k": 1, "note": "l", "note_right": "r"}


def test_broadcast_only_up_to_the_measured_size(spark):
    df = spark.createDataFrame([("abcd",), (None,)], "s string")
    (size,) = measured_bytes(df)
    assert size == 2 * 16 + 4
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(*small_sides(df, limit=size)) and not hinted(*small_sides(df, limit=size - 1))
    assert measured_bytes(df.limit(0), df) == [0, size]


def wide(spark, data):
    return Measures.of(spark.createDataFrame(data, WIDE), scale=2, oil_scale=6)


def row(n=0, store=1, family="A", sales=1.0, promo=0, city="c", traffic=1.0, oil=50.0, holiday=False):
    return (day(n), store, family, sales, promo, city, "st", traffic, oil, holiday)


def test_overlapping_holiday_windows_count_twice(spark):
    m = wide(spark, [row(0, holiday=True, sales=4.0), row(2, holiday=True, sales=8.0), row(3, sales=16.0), row(9, sales=99.0)])
    found = {r["offset_dias"]: r["ventas_promedio"] for r in a.sales_around_holidays(m).collect()}
    assert found == {-2: 4.0, 0: 6.0, 1: 16.0, 2: 8.0, 3: 16.0}


def test_holiday_sensitivity_needs_both_kinds_of_day(spark):
    m = wide(spark, [row(holiday=True, sales=3.0), row(1, sales=2.0), row(family="B"), row(family="C", holiday=True)])
    assert [tuple(r) for r in a.holiday_sensitivity(m).collect()] == [("A", 2.0, 3.0, 50.0)]


def test_zero_bases_give_null(spark):
    m = wide(spark, [row(sales=0.0), row(promo=2, sales=5.0), row(family="B", sales=1.0), row(family="B", promo=1, sales=3.0)])
    table = a.promo_effect(m)
    assert [tuple(r) for r in table.collect()] == [("A", 5.0, 0.0, None), ("B", 3.0, 1.0, 200.0)]
    assert [r["family"] for r in f.top_promo_families(table).collect()] == ["B"]


def test_family_never_promoted_has_no_effect(spark):
    table = a.promo_effect(wide(spark, [row(sales=2.0)]))
    assert table.columns == ["family", "true", "false", "efecto_promocion_pct"]
    assert tuple(table.first()) == ("A", None, 2.0, None)


def test_unknown_city_is_a_group(spark):
    m = wide(spark, [row(city=None, sales=3.0), row(sales=1.0)])
    assert [tuple(r) for r in a.avg_sales_by_city(m).collect()] == [(None, 3.0), ("c", 1.0)]


def test_tables_are_sorted_with_ties_by_key(spark):
    m = wide(spark, [row(family="B", sales=2.0), row(family="A", sales=2.0), row(family="C", sales=9.0)])
    assert [r["family"] for r in a.sales_by_family(m).collect()] == ["C", "A", "B"]


def test_bottom_stores_stay_descending(spark):
    m = wide(spark, [row(store=s, sales=float(s % 7)) for s in range(1, 15)])
    table = a.sales_by_store(m).collect()
    assert f.top_stores(a.sales_by_store(m)).collect() == table[:10]
    assert f.bottom_stores(a.sales_by_store(m)).collect() == table[-10:]


def test_ticket_without_transactions_is_null_and_unranked(spark):
    m = wide(spark, [row(store=1, traffic=None), row(store=2, traffic=0.0), row(store=3, sales=6.0, traffic=2.0)])
    table = a.avg_ticket_by_store(m)
    assert {r["store_nbr"]: r["ticket_promedio"] for r in table.collect()} == {1: None, 2: None, 3: 3.0}
    assert [r["store_nbr"] for r in f.low_ticket_stores(table).collect()] == [3]


def test_months_without_oil_are_left_out(spark):
    m = wide(spark, [row(0, oil=None), row(40, oil=60.0), row(41, oil=None)])
    assert [tuple(r) for r in a.sales_vs_oil_monthly(m).collect()] == [(2015, 7, 2.0, 60.0)]


def monthly(spark, pairs):
    data = [(2015 + i // 12, i % 12 + 1, float(s), float(o)) for i, (s, o) in enumerate(pairs)]
    return spark.createDataFrame(data, "anio int, mes int, ventas_totales double, precio_petroleo_promedio double")


def test_lags_need_two_pairs(spark):
    lags = lambda n: [r["lag_meses"] for r in f.corr_oil_sales_lags(monthly(spark, [(i, i * i) for i in range(n)])).collect()]
    assert [lags(n) for n in (0, 2, 3, 4, 5)] == [[], [], [1], [1, 2], [1, 2, 3]]


def test_lag_pairs_sales_with_earlier_oil(spark):
    oil = [5, 1, 4, 2, 8, 3]
    table = monthly(spark, list(zip([0, *oil[:-1]], oil)))
    found = {r["lag_meses"]: r["correlacion"] for r in f.corr_oil_sales_lags(table, lags=(1,)).collect()}
    assert found[1] == pytest.approx(1.0)


def test_constant_oil_has_no_correlation(spark):
    assert f.corr_oil_sales(monthly(spark, [(1, 5), (2, 5)])).first()["correlacion"] is None


def test_findings_of_an_empty_table_are_empty(spark):
    empty = wide(spark, [])
    assert f.top_family(a.sales_by_family(empty)).collect() == []
    assert f.corr_transactions_sales(a.avg_ticket_by_store(empty)).first()["correlacion"] is None


def test_rollups_give_the_tables_of_the_rows(clean):
    rows = Measures.of(consolidate(**clean), scale=2, oil_scale=6)
    for keys, makers in ((DAY_FAMILY, a.DAY_FAMILY_TABLES), (STORE_YEAR, a.STORE_YEAR_TABLES)):
        sums = rows.rollup(*keys)
        for name, make in makers.items():
            assert make(sums).collect() == make(rows).collect(), name


def test_plain_double_sums_agree_with_scaled_ones(clean):
    wide_rows = consolidate(**clean)
    exact, plain = Measures.of(wide_rows, 2, 6), Measures.of(wide_rows)
    for make in [*a.DAY_FAMILY_TABLES.values(), *a.STORE_YEAR_TABLES.values()]:
        for left, right in zip(make(exact).collect(), make(plain).collect()):
            assert list(left) == pytest.approx(list(right)) if None not in left else True


def test_scaled_sums_do_not_depend_on_the_partitioning(spark):
    df = spark.range(10_000).select((F.rand(1) * 1e6).alias("x")).select(F.round("x", 2).alias("sales"))
    frame = df.withColumns(
        {
            "date": F.lit(DAY), "store_nbr": F.lit(1), "family": F.lit("A"), "onpromotion": F.lit(0), "city": F.lit("c"),
            "state": F.lit("s"), "transactions": F.lit(1.0), "dcoilwtico": F.lit(1.0), "es_feriado": F.lit(False),
        }
    ).persist()
    totals = {a.sales_yearly(Measures.of(frame.repartition(n), 2)).first()["ventas_totales"] for n in (1, 3, 16)}
    assert len(totals) == 1
