"""Command line of the batch: ``run_pipeline.py clean|star|all --raw … --clean … --star …``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from refinery.plans.pipeline import (
    clean_layer,
    clean_report,
    raw_report,
    report,
    star_layer,
    stored_records,
)
from refinery.schemas import CLEAN
from refinery.session import materialize, open_session, temporary
from refinery.sources.files import read_table


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=["clean", "star", "all"])
    parser.add_argument("--raw", help="folder or file of raw CSV")
    parser.add_argument("--clean", required=True, help="folder of the clean table")
    parser.add_argument("--star", help="folder of the star schema")
    parser.add_argument("--reports", help="folder for the reports, each a table; replaced")
    parser.add_argument("--rows", type=int, default=20, help="rows of a report that are printed")
    parser.add_argument("--incremental", action="store_true", help="merge into the clean table")
    parser.add_argument("--new-files", action="store_true", help="read only files not read before")
    parser.add_argument("--run-at", type=datetime.fromisoformat, help="time of the run; name it when a run is repeated")
    parser.add_argument("--key-registry", help="folder where ids keep their surrogate keys")
    parser.add_argument("--quarantine", action="store_true", help="set bad fact rows aside")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    parser.add_argument("--partitions", type=int, help="deal raw rows out to so many tasks")
    parser.add_argument("--day-first", action="store_true", help="05-01-2024 is 5 January")
    parser.add_argument("--all-versions", action="store_true", help="keep conflicting attributes")
    parser.add_argument(
        "--shuffle-partitions",
        type=int,
        help="pieces that shuffles start with: bytes of raw input over 200 MB, or more",
    )
    args = parser.parse_args()
    if args.step != "star" and not args.raw:
        parser.error("--raw is needed to build the clean table")
    if args.step != "clean" and not args.star:
        parser.error("--star is needed to build the star schema")
    if args.new_files:
        args.incremental = True
    return args


def main() -> None:
    args = arguments()
    spark = open_session(shuffle_partitions=args.shuffle_partitions)
    with temporary(spark):
        run(spark, args)
    spark.stop()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """The steps asked for, and their reports. The raw CSV is parsed once, or with
    ``--new-files`` once for the clean table and not for reports; a report is computed once."""
    reports = {}
    if args.step != "star":
        records = None
        if not args.new_files:
            records = stored_records(spark, args.raw, args.multi_line, args.partitions)
            reports |= raw_report(spark, args.raw, records=records)
        clean = clean_layer(
            spark,
            args.raw,
            args.clean,
            args.run_at,
            multi_line=args.multi_line,
            day_first=args.day_first,
            incremental=args.incremental,
            partitions=args.partitions,
            records=records,
            new_files_only=args.new_files,
        )
        clean.printSchema()
    if args.step != "clean":
        star = star_layer(
            spark,
            args.clean,
            args.star,
            args.run_at,
            all_versions=args.all_versions,
            registry=args.key_registry,
            quarantine=args.quarantine,
        )
        star["fact_sales"].printSchema()
        reports |= report(star, args.star)
    reports |= clean_report(read_table(spark, args.clean, CLEAN))
    for name, rows in reports.items():
        if args.reports:
            rows.write.mode("overwrite").parquet(f"{args.reports}/{name}")
            rows = spark.read.schema(rows.schema).parquet(f"{args.reports}/{name}")
        else:
            rows = materialize(rows, f"report-{name}")
        print(f"{name}: {rows.count()} rows, of which {args.rows} at most follow")
        rows.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
