"""Command line: ``python -m oreline {bronze,silver,gold} ...`` under spark-submit."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from oreline.plans.jobs import build_gold_changes, build_gold_report, build_silver, ingest_bronze, run_window
from oreline.functions.dates import EPOCH_DAYS, YYYYMMDD
from oreline.session import build_session
from oreline.sinks.catalog import ensure_table
from oreline.sinks.maintenance import compact_log
from oreline.spec import ENTITIES, EntitySpec, Layout
from oreline.streaming.bronze import run_until_stopped


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="oreline")
    parser.add_argument("--root", required=True, help="root folder of the lakehouse")
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--hive", action="store_true", help="register tables in the metastore")
    jobs = parser.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze", help="stream change events into the log")
    bronze.add_argument("entity", choices=sorted(ENTITIES))
    bronze.add_argument("--source", default="kafka", help="kafka, or a file format")
    bronze.add_argument("--source-path", help="folder of the file source")
    bronze.add_argument("--bootstrap-servers")
    bronze.add_argument("--trigger", help="interval such as '60 seconds', or available_now")

    silver = jobs.add_parser("silver", help="merge changes into current state")
    silver.add_argument("entity", choices=sorted(ENTITIES))
    silver.add_argument("--deletes", choices=("drop", "apply"), default="drop", help="what a delete event does")
    silver.add_argument("--guard", action="store_true", help="never replace a row by an older one")
    silver.add_argument("--unseen", action="store_true", help="take the batches no such run has merged, instead of a window")
    silver.add_argument("--compact", action="store_true", help="then fold the window's closed batches")

    gold = jobs.add_parser("gold", help="merge the student-session report")
    gold.add_argument("--date-filter", choices=("pre_join", "where"), default="pre_join")
    gold.add_argument(
        "--changes", action="store_true", help="recompute the dates that silver's changes reach, instead of a window"
    )
    gold.add_argument("--adopt", action="store_true", help="take the table for up to date: --changes goes on from there")
    gold.add_argument("--null-dates", choices=("keep", "drop"), default="keep", help="bookings without a session")
    gold.add_argument("--null-safe", action="store_true", help="match rows without a date with each other")
    gold.add_argument("--date-encoding", choices=(YYYYMMDD, EPOCH_DAYS), default=YYYYMMDD, help="of the integer learn dates")
    gold.add_argument("--on-duplicate", choices=("error", "keep_any"), default="error")

    fold = jobs.add_parser("compact", help="fold the closed batches of an entity's log")
    fold.add_argument("entity", choices=sorted(ENTITIES))
    for job in (silver, gold, fold):
        job.add_argument("--start-date", help="first date, YYYY-MM-DD (default: yesterday)")
        job.add_argument("--end-date", help="last date, included (default: today)")
    return parser.parse_args(argv)


def run_job(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = Layout(args.root, fmt=args.format)
    if args.job == "bronze":
        entity = ENTITIES[args.entity]
        if args.hive:
            ensure_table(spark, layout.bronze_table(entity))
        query = ingest_bronze(
            spark, entity, layout, args.trigger, args.source, args.source_path, args.bootstrap_servers
        )
        run_until_stopped(query)
        if args.hive:
            ensure_table(spark, layout.bronze_table(entity))
    elif args.job == "silver":
        entity = ENTITIES[args.entity]
        build_silver(
            spark, entity, layout, args.start_date, args.end_date, args.deletes, args.guard, args.hive, args.unseen
        )
        if args.compact:
            _fold(spark, entity, layout, args)
    elif args.job == "compact":
        _fold(spark, ENTITIES[args.entity], layout, args)
    elif args.changes or args.adopt:
        build_gold_changes(spark, layout, args.date_encoding, register=args.hive, adopt=args.adopt)
    else:
        build_gold_report(
            spark,
            layout,
            args.start_date,
            args.end_date,
            args.date_filter,
            args.null_dates,
            args.on_duplicate,
            args.null_safe,
            args.date_encoding,
            register=args.hive,
        )


def _fold(spark: SparkSession, entity: EntitySpec, layout: Layout, args: argparse.Namespace) -> None:
    if layout.fmt != "parquet":
        raise ValueError(f"format {layout.fmt} compacts its own tables")
    window = run_window(args.start_date, args.end_date)
    compact_log(spark, layout.bronze_path(entity), entity, *window, layout.cursor_path(entity.name))


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s - %(message)s")
    spark = build_session(f"oreline-{args.job}", hive=args.hive)
    try:
        run_job(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
