"""The tables between the stages, each written once per session and data set.

Like the job, queries start from the written result of the stage before them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from storesales.fixtures import OIL_SCALE, RAW, SALES_SCALE
from storesales.plans.clean import CLEANERS, clean_table
from storesales.plans.consolidate import consolidate
from storesales.plans.measures import Measures
from storesales.sources.shared import checkpoint, concurrently, new_path, version
from storesales.sources.sizing import size_shuffles, size_tasks

# (application, data folder, table) -> (version of the input, path, schema) of what is written.
_written: dict[tuple[str, str, str], tuple] = {}

# The tables that all others come from.
SOURCES = ("lineitem", "orders", "part", "supplier", "nation", "region")


class Warehouse:
    """Raw, clean and consolidated tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.version = tuple(version(spark, f"{sf_dir}/{name}.parquet") for name in SOURCES)
        size_shuffles(spark, [spark.read.parquet(f"{sf_dir}/lineitem.parquet")])
        size_tasks(spark)

    def _once(self, label: str, make: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key in _written and _written[key][0] == self.version:
            _, path, schema = _written[key]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:  # someone emptied the shared folder
                del _written[key]
        path = new_path(self.spark, label)
        written = checkpoint(make(), path)
        _written[key] = (self.version, path, written.schema)
        return written

    def raw(self, name: str) -> DataFrame:
        return self._once(f"raw-{name}", lambda: RAW[name](self.spark, self.sf_dir))

    def all_raw(self) -> dict[str, DataFrame]:
        return concurrently(self.spark, self.raw, RAW)

    def clean(self, name: str) -> DataFrame:
        return self._once(f"clean-{name}", lambda: clean_table(name, self.raw(name)))

    def all_clean(self) -> dict[str, DataFrame]:
        return concurrently(self.spark, self.clean, CLEANERS)

    def joined(self) -> DataFrame:
        """The consolidated table as a plan over the clean tables, not yet written."""
        clean = self.all_clean()
        return consolidate(
            clean["train"], clean["stores"], clean["transactions"], clean["oil"], clean["holidays"]
        )

    def consolidated(self) -> DataFrame:
        return self._once("consolidated", self.joined)

    def measures(self) -> Measures:
        return Measures.of(self.consolidated(), SALES_SCALE, OIL_SCALE)
