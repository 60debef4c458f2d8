"""Where results go: JSON reports, Parquet tables, database tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storesales.sources.shared import concurrently

logger = logging.getLogger(__name__)

Sink = Callable[[DataFrame, str], None]

# Fixed value: rows per database round trip.
BATCH_ROWS = 100_000


def write_report(report: DataFrame, path: str) -> None:
    """Write a one-row report as one JSON document, NULL fields included."""
    report.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)


def jdbc_column_types(schema: T.StructType) -> str:
    """Column types for a database table, in the words of ``createTableColumnTypes``.

    The dialect turns STRING into the database's text type.
    """
    kinds = [
        (T.IntegralType, "BIGINT"),
        (T.FractionalType, "DOUBLE"),
        (T.BooleanType, "BOOLEAN"),
        (T.DateType, "DATE"),
        ((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
    ]

    def kind(data_type: T.DataType) -> str:
        return next((sql for types, sql in kinds if isinstance(data_type, types)), "STRING")

    return ", ".join(f"`{f.name}` {kind(f.dataType)}" for f in schema.fields)


def jdbc_options(df: DataFrame, table: str, url: str, connections: int) -> dict[str, object]:
    """Writer options for loading ``table``."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": BATCH_ROWS,
        "numPartitions": connections,
        "createTableColumnTypes": jdbc_column_types(df.schema),
    }


# Column of the staging table that tells a row from its copies.
ROW = "__row"

Run = Callable[[list[str]], None]


def staged(df: DataFrame) -> DataFrame:
    """``df`` with a number for each row that is the same if a task is run again; meant for written tables."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def swap_statements(table: str, staging: str, columns: list[str]) -> list[str]:
    """What puts a loaded staging table in the place of ``table``, to be run in one transaction.

    A task that is run again after it committed has stored its rows twice, with
    the same numbers; the copies fall away here.
    """
    named = ", ".join(f'"{c}"' for c in columns)
    return [
        f"CREATE TABLE {staging}_whole AS SELECT {named} FROM (SELECT DISTINCT * FROM {staging}) AS loaded",
        f"DROP TABLE {staging}",
        f"DROP TABLE IF EXISTS {table}",
        f"ALTER TABLE {staging}_whole RENAME TO {table.rpartition('.')[2]}",
    ]


def jdbc_run(spark: SparkSession, url: str, properties: dict[str, str]) -> Run:
    """Runs statements through one connection of the driver, all or none."""

    def run(statements: list[str]) -> None:
        given = spark._jvm.java.util.Properties()
        for key, value in properties.items():
            given.setProperty(key, value)
        if "driver" in properties:
            spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
        connection = spark._jvm.java.sql.DriverManager.getConnection(url, given)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().execute(statement)
            connection.commit()
        finally:
            connection.close()  # what is not committed is rolled back

    return run


def jdbc_replace(
    df: DataFrame,
    table: str,
    url: str,
    properties: dict[str, str] | None = None,
    connections: int = 16,
    run: Run | None = None,
) -> None:
    """Replace ``table`` by the rows of ``df``, loaded from the executors, at once.

    They go into a staging table beside it, at most ``connections`` tasks at a
    time; an export of many tables runs several of them together. Its rows are
    counted, each once however often a task was run, and only if none is missing
    the staging table takes the place of ``table``, in one transaction. Readers
    see the old table or the new one, whole, and a failed load changes nothing.
    The database must run CREATE, DROP and RENAME in a transaction, as
    PostgreSQL does. ``df`` should read a written table, so that its rows have
    the same numbers when a task is run again.
    """
    properties = properties or {}
    run = run or jdbc_run(df.sparkSession, url, properties)
    staging = f"{table}_{uuid.uuid4().hex[:12]}"
    rows = staged(df)
    try:
        rows.write.format("jdbc").mode("overwrite").options(**jdbc_options(rows, staging, url, connections), **properties).save()
        reader = df.sparkSession.read.format("jdbc").options(url=url, **properties)
        stored = reader.option("query", f'SELECT count(DISTINCT "{ROW}") AS n FROM {staging}').load().first()[0]
        expected = df.count()
        if stored != expected:
            raise RuntimeError(f"{stored} rows of {expected} arrived for table {table}; it stays as it was")
        run(swap_statements(table, staging, df.columns))
    except Exception:
        run([f"DROP TABLE IF EXISTS {staging}"])
        raise


def jdbc_sink(url: str, properties: dict[str, str] | None = None, connections: int = 16) -> Sink:
    """A sink that replaces database tables."""
    return lambda df, name: jdbc_replace(df, name, url, properties, connections)


def parquet_sink(out_dir: str) -> Sink:
    """A sink that replaces Parquet tables under ``out_dir``."""
    return lambda df, name: df.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def export_all(
    sink: Sink,
    consolidated: DataFrame,
    tables: dict[str, DataFrame] | None = None,
    quality: DataFrame | None = None,
    metrics: DataFrame | None = None,
) -> list[str]:
    """Send every table to ``sink`` under its public name; what is absent is warned about and left out."""
    outgoing = {"ventas_consolidado": consolidated}
    if tables:
        outgoing.update({f"eda_{name}": tables[name] for name in sorted(tables)})
    else:
        logger.warning("no analytic tables to export")
    for name, df in (("calidad_datos_inicial", quality), ("metricas_limpieza", metrics)):
        if df is None:
            logger.warning("nothing to export as %s", name)
        else:
            outgoing[name] = df
    concurrently(consolidated.sparkSession, lambda name: sink(outgoing[name], name), outgoing)
    return list(outgoing)
