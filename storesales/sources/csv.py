"""Loading the five CSV files: validated, typed, all or nothing."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storesales.functions.casts import INTEGERS, WHOLE_NUMBER
from storesales.sources.schemas import EXPECTED_TYPES, RAW_FILES
from storesales.sources.shared import checkpoint, concurrently, current, exists, publish, remove

MALFORMED = "__malformed"

# What a column may turn out to be, most specific first; text is always possible.
LADDERS = {
    "int": ["int", "double"],
    "bigint": ["bigint", "double"],
    "double": ["double"],
    "date": ["date"],
    "boolean": ["boolean"],
    "string": [],
}
UNDECLARED = ["bigint", "double", "date", "boolean"]


class LoadError(RuntimeError):
    """One or more source tables could not be loaded; ``failures`` maps table to reason."""

    def __init__(self, failures: dict[str, str]):
        self.failures = failures
        reasons = "; ".join(f"{name}: {reason}" for name, reason in failures.items())
        super().__init__(f"could not load {sorted(failures)}: {reasons}")


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV file, from its first line only."""
    return [c.lstrip("﻿") for c in spark.read.csv(path, header=True, escape='"').columns]


def validate_columns(spark: SparkSession, name: str, path: str, expected: set[str]) -> list[str]:
    """The header of ``path``; raises if the file or an expected column is missing."""
    try:
        found = header(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table '{name}' not found at {path}") from exc
        raise
    missing = expected - set(found)
    if missing:
        raise ValueError(f"table '{name}' lacks columns {sorted(missing)}; found {sorted(found)}")
    return found


def read_csv(spark: SparkSession, name: str, path: str, multi_line: bool = False) -> DataFrame:
    """The file as text columns named by its own header, with malformed records set aside.

    A given schema binds by position, so the header decides the order. In a
    folder of part files one header stands for all, and a file whose own header
    differs fails when it is read. Text
    first: a value of the wrong type is then seen, not silently made NULL.
    Line breaks inside quotes need ``multi_line``, which reads each file in one
    task, so it is off by default.
    """
    columns = validate_columns(spark, name, path, set(EXPECTED_TYPES[name]))
    fields = [T.StructField(c, T.StringType()) for c in [*columns, MALFORMED]]
    # A pruned column would not be parsed, and a malformed record pass unnoticed.
    return spark.read.option("columnPruning", "false").csv(
        path,
        schema=T.StructType(fields),
        header=True,
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE",
        enforceSchema=False,
        columnNameOfCorruptRecord=MALFORMED,
    )


def _fits(column: str, target: str) -> Column:
    value = F.col(column)
    if target == "date":
        fits = value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()
    elif target == "boolean":
        fits = F.lower(value).isin("true", "false")
    elif target in INTEGERS:
        fits = value.rlike(WHOLE_NUMBER) & value.try_cast(target).isNotNull()
    else:
        fits = value.try_cast(target).isNotNull()
    return value.isNull() | fits


def _broken(width: int) -> Column:
    """Whether a malformed record cannot be read: an open quote, or more fields than the header.

    Fewer fields are no harm: the rest are NULL.
    """
    record = F.col(MALFORMED)
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    unquoted = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return (quotes % 2 == 1) | (F.size(F.split(unquoted, ",")) > width)


def _refuse_broken(name: str, records: int) -> None:
    if records:
        raise ValueError(f"table '{name}' has {records} records with too many fields or an open quote")


def settle_types(text: DataFrame, name: str) -> DataFrame:
    """Give each column its declared type if every value fits, else leave it wider or as text.

    One scan reads the whole file, so it also shows whether the file is readable.
    """
    columns = [c for c in text.columns if c != MALFORMED]
    declared = EXPECTED_TYPES[name]
    ladders = {c: LADDERS[declared[c]] if c in declared else UNDECLARED for c in columns}
    checks = [
        F.every(_fits(c, target)).alias(f"{i}_{target}") for i, c in enumerate(columns) for target in ladders[c]
    ]
    # One row of booleans.
    seen = text.agg(F.count_if(_broken(len(columns))).alias("broken"), *checks).first()
    _refuse_broken(name, seen["broken"])

    def typed(i: int, c: str) -> Column:
        # An empty table gives NULL: the declared type fits.
        fitting = [t for t in ladders[c] if seen[f"{i}_{t}"] is not False]
        return F.col(c).try_cast(fitting[0]).alias(c) if fitting else F.col(c)

    return text.select(*[typed(i, c) for i, c in enumerate(columns)])


def write_typed(text: DataFrame, name: str, path: str) -> DataFrame:
    """Write the table with its declared types, counting on the way what does not fit them.

    If all values fit, the file is parsed once. Only a table with values that do
    not fit is parsed again, to settle its types.
    """
    columns = [c for c in text.columns if c != MALFORMED]
    declared = EXPECTED_TYPES[name]
    ladders = {c: LADDERS[declared[c]] if c in declared else UNDECLARED for c in columns}
    first = {c: targets[0] for c, targets in ladders.items() if targets}
    seen = Observation()
    misfits = [F.count_if(~_fits(c, target)).alias(f"misfits_{i}") for i, (c, target) in enumerate(first.items())]
    observed = text.observe(seen, F.count_if(_broken(len(columns))).alias("broken"), *misfits)
    typed = observed.select(*[F.col(c).try_cast(first[c]).alias(c) if c in first else F.col(c) for c in columns])
    written = checkpoint(typed, path)
    found = seen.get
    _refuse_broken(name, found["broken"])
    if any(found[f"misfits_{i}"] for i in range(len(first))):
        return checkpoint(settle_types(text, name), path)
    return written


def load_all(
    spark: SparkSession, source_dir: str, out_dir: str, multi_line: bool = False
) -> dict[str, DataFrame]:
    """Load all tables into Parquet under ``out_dir``; on any failure write nothing and name them all.

    A load writes all tables into a folder of its own, which then becomes the
    current one at once: a load that dies leaves the tables of the one before,
    never some of each. ``read_loaded`` finds them.
    """
    loaded, failures = {}, {}
    root = out_dir.rstrip("/")
    around = root.rpartition("/")[0]
    new = next((path for path in (around, root) if path and not exists(spark, path)), None)
    name = f"load-{uuid.uuid4().hex}"
    place = f"{root}/{name}"

    def load(table: str) -> None:
        try:
            text = read_csv(spark, table, f"{source_dir}/{RAW_FILES[table]}", multi_line)
            loaded[table] = write_typed(text, table, f"{place}/{table}").schema
        except Exception as exc:  # every table gets its turn before the load gives up
            failures[table] = str(exc)

    published = False
    try:
        concurrently(spark, load, RAW_FILES)
        if failures:
            raise LoadError(failures)
        publish(spark, root, name)
        published = True
    finally:
        if not published and place not in current(spark, root):
            remove(spark, new or place)
    return {table: spark.read.schema(loaded[table]).parquet(f"{place}/{table}") for table in RAW_FILES}


def read_loaded(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the last load into ``out_dir`` that was finished."""
    found = current(spark, out_dir.rstrip("/"))
    if not found:
        raise FileNotFoundError(f"nothing was loaded into {out_dir}")
    return {table: spark.read.parquet(f"{found[0]}/{table}") for table in RAW_FILES}
