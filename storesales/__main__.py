"""``spark-submit`` entry: run the whole job on a folder of CSV files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from storesales.plans.analytics import OIL_FALL
from storesales.plans.retail_job import export_saved, run_job
from storesales.sources.sinks import jdbc_sink, parquet_sink


def main() -> None:
    parser = argparse.ArgumentParser(prog="storesales", description=__doc__)
    parser.add_argument("source", help="folder with the five CSV files")
    parser.add_argument("out", help="folder for tables and reports, reachable by all executors")
    target = parser.add_mutually_exclusive_group()
    target.add_argument("--jdbc-url", help="export to this database")
    target.add_argument("--parquet", help="export to this folder")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--scale", type=int, help="decimal places of sales, for exact sums")
    parser.add_argument("--oil-scale", type=int, help="decimal places of oil prices, for exact sums")
    parser.add_argument(
        "--years", type=int, nargs=2, default=OIL_FALL, metavar=("FIRST", "LAST"), help="the fall of the oil price"
    )
    parser.add_argument("--multi-line", action="store_true", help="CSV fields may contain line breaks")
    parser.add_argument("--export-only", action="store_true", help="export what an earlier run left in OUT")
    args = parser.parse_args()
    if args.export_only and not (args.jdbc_url or args.parquet):
        parser.error("--export-only needs --jdbc-url or --parquet")
    spark = SparkSession.builder.appName("storesales").getOrCreate()
    sink = None
    if args.jdbc_url:
        sink = jdbc_sink(args.jdbc_url, dict(p.split("=", 1) for p in args.jdbc_property))
    elif args.parquet:
        sink = parquet_sink(args.parquet)
    if args.export_only:
        export_saved(spark, args.out, sink)
    else:
        run_job(
            spark, args.source, args.out, sink, args.scale, args.oil_scale, tuple(args.years), args.multi_line
        )


if __name__ == "__main__":
    main()
