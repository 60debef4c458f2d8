"""The five source tables, derived from the star-schema test tables.

Planted on the way: NULLs, duplicate rows, gaps in the oil series, dates with
several holidays and store-days without a transaction count. Planted copies are
exploded from their row, so each source is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Years that stand in for the fall of the oil price, decimal places.
FIXTURE_FALL = (1997, 1998)
SALES_SCALE = 2
OIL_SCALE = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # Even for a line itself, odd for its planted copy.
    key = F.expr("(l_orderkey * 10 + l_linenumber) * 2")
    promoted = F.expr(
        "CASE WHEN l_orderkey % 89 = 0 THEN NULL "
        "WHEN p_brand = 'Brand#1' OR l_discount < 0.055 THEN 0 "
        "ELSE CAST(round(l_discount * 100) AS INT) END"
    )
    rows = lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        key.alias("id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("int").alias("store_nbr"),
        F.col("p_brand").alias("family"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_extendedprice")).alias("sales"),
        promoted.alias("onpromotion"),
    )
    ids = F.when(F.col("id") % 102 == 0, F.array(F.col("id"), F.col("id") + 1)).otherwise(F.array("id"))
    return rows.select(F.explode(ids).alias("id"), *rows.columns[1:])


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )

    def unless(remainder: str, value: Column | str) -> Column:
        return F.when(~F.expr(remainder), value)

    copies = F.when(F.col("s_suppkey") % 10 == 0, 2).otherwise(1)
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(
        F.col("s_suppkey").cast("int").alias("store_nbr"),
        unless("s_suppkey % 31 = 3", F.col("n_name")).alias("city"),
        unless("s_suppkey % 37 = 4", F.col("r_name")).alias("state"),
        unless("s_suppkey % 29 = 5", F.expr("substr('ABCDE', CAST(s_suppkey % 5 AS INT) + 1, 1)")).alias("type"),
        (F.col("s_suppkey") % 17 + 1).cast("int").alias("cluster"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    daily = lines.groupBy(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").cast("int").alias("store_nbr")
    ).agg(F.sum("l_quantity").cast("bigint").alias("transactions"))
    salt = F.col("store_nbr") + F.dayofmonth("date")
    return daily.where(salt % 11 != 0).withColumn(
        "transactions", F.when(salt % 13 != 0, F.col("transactions"))
    )


def raw_oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    daily = orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.max("o_totalprice").alias("price")
    )
    quoted = (F.col("price") / 5000).cast("decimal(12,2)").cast("double")
    return daily.select(
        "date", F.when(~(F.dayofmonth("date") % 7).isin(0, 1), quoted).alias("dcoilwtico")
    )


def raw_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    days = orders.select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    dated = days.withColumns({"m": F.month("date"), "dd": F.dayofmonth("date")}).where("dd IN (1, 25)")
    national = F.expr(
        "named_struct("
        "'type', CASE WHEN m = 11 THEN NULL WHEN m % 4 = 3 THEN 'Event' ELSE 'Holiday' END, "
        "'locale', 'National', 'locale_name', 'Ecuador', 'description', concat('N', m), "
        "'transferred', CASE WHEN m = 7 THEN NULL ELSE m = 5 END)"
    )
    local = F.expr(
        "named_struct('type', 'Holiday', 'locale', 'Local', 'locale_name', 'Quito', "
        "'description', concat('L', m), 'transferred', false)"
    )
    both = F.when(F.expr("dd = 25 AND m % 2 = 0"), F.array(national, local)).otherwise(F.array(national))
    return dated.select("date", F.explode(both).alias("row")).select("date", "row.*")


RAW = {
    "train": raw_sales,
    "stores": raw_stores,
    "transactions": raw_transactions,
    "oil": raw_oil,
    "holidays": raw_holidays,
}
