"""What the operators of this subpackage share: input columns, Arrow batches, scratch tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storesales.sources.shared import new_path

__all__ = ["carried", "cut", "id_crc32", "plan_bytes", "read", "slices", "small_enough", "texts_of", "type_of"]

# Text handled at a time inside a Python task; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` with a table of its own in the shared folder, packed tightly."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has no more rows than that, else as it is; meant for written tables of narrow rows."""
    return F.broadcast(df) if df.count() <= rows else df


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) only, so other columns cannot clash; with ``carry`` all columns in a struct ``row``."""
    columns = [F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    return docs.select(*columns, *([F.struct(*docs.columns).alias("row")] if carry else []))


def type_of(df: DataFrame, column: str) -> str:
    """A column's type as it is written in a schema."""
    return df.schema[column].dataType.simpleString()


def carried(batch: pa.RecordBatch) -> tuple[list[pa.Array], list[str]]:
    """The column ``row`` and its name, if the batch has it."""
    return ([batch.column("row")], ["row"]) if "row" in batch.schema.names else ([], [])


def id_crc32(column: Column) -> Column:
    """CRC-32 of the id written as text, which splits the documents into folds."""
    return F.crc32(column.cast("string").cast("binary"))


def plan_bytes(df: DataFrame) -> int:
    """Size the optimizer expects of ``df``: the file sizes for a plain read; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end
