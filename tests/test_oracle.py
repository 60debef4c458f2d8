"""Every registered query against its SQL in DuckDB, value by value."""

import datetime
import math
import os

import duckdb
import pytest

from storesales.oracle import oracle_sql
from storesales.queries import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
STAR_TABLES = ["region", "nation", "supplier", "part", "orders", "lineitem"]

# Cross joins and Python workers have no place in any plan.
UNWANTED = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in STAR_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def _sortable(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float):
        assert not math.isnan(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    columns = sorted(result.columns)
    found = [tuple(_plain(v) for v in row) for row in result.select(*[f"`{c}`" for c in columns]).collect()]
    expected = duck.sql(oracle_sql()[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    wanted = [tuple(_plain(row[i]) for i in order) for row in expected.fetchall()]
    assert sorted(found, key=_sortable) == sorted(wanted, key=_sortable)


def test_only_used_columns_are_read(spark):
    plan = queries()["sales_by_family"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<family:string,sales:double>" in plan


def test_holiday_windows_scan_once(spark):
    plan = queries()["sales_around_holidays"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<date:date,family:string,sales:double,es_feriado:boolean>" in plan


def test_large_order_keys_lose_no_row(spark, tmp_path):
    for name in STAR_TABLES:
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        if name == "lineitem":
            table = table.withColumn("l_orderkey", table.l_orderkey + 10**12)
        if name == "orders":
            table = table.withColumn("o_orderkey", table.o_orderkey + 10**12)
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    connection = duckdb.connect()
    for name in STAR_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("lenient_casts", "dedup_keep_first"):
        wanted = connection.sql(f"SELECT count(*) FROM ({oracle_sql()[name]})").fetchall()[0][0]
        assert queries()[name](spark, str(tmp_path)).count() == wanted >= 6000


def test_null_counts_filter_before_the_shuffle(spark):
    plan = queries()["cleaning_metrics"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(sales),IsNull(onpromotion))]" in plan
