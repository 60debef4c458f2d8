"""Time the stages and all analytic tables; prints one JSON line.

Each query runs once to warm up and three times for a median. All start from
the written result of the stage before, as in the job: cleaning from the raw
tables, consolidation from the clean ones, analytics from the consolidated one.
Writing those inputs is not part of a query's time and is reported on its own.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from storesales.plans.warehouse import Warehouse
from storesales.queries import FINDINGS, OPERATORS, TABLES, queries
from storesales.sources.shared import remove_session_tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = os.environ.get("BENCH_ONLY", "")


def run(df: DataFrame) -> float:
    """Seconds to compute every row and column of ``df``."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_seconds(spark: SparkSession, query) -> float:
    def once() -> float:
        start = time.perf_counter()
        df = query(spark, SF_DIR)
        return time.perf_counter() - start + run(df)

    once()
    return statistics.median(once() for _ in range(RUNS))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("storesales-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        # Small files, so that tables of this size are read by all cores.
        .config("spark.sql.files.maxRecordsPerFile", "75000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = Warehouse(spark, SF_DIR)
    stages = {}
    for stage in ("all_raw", "all_clean", "consolidated"):
        start = time.perf_counter()
        getattr(warehouse, stage)()
        stages[f"write_{stage}"] = round(time.perf_counter() - start, 3)
    names = [*OPERATORS, *TABLES, *FINDINGS]
    if ONLY:
        names = ONLY.split(",")
    known = queries()
    seconds = {name: round(median_seconds(spark, known[name]), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "sum of warm median seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold_stage_writes": stages,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )
    remove_session_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
