"""Run one stage, all stages, or the stream: ``python -m orderloom <what> ...``."""

from __future__ import annotations

import argparse
import json
from datetime import date
from pathlib import Path

from orderloom import config
from orderloom.plans import staged_run
from orderloom.session import build_session
from orderloom.sinks import cluster_table, compact_table
from orderloom.sources import Topic, stream_topic
from orderloom.streaming import (
    StreamCounts,
    compact_printed_landing,
    drain,
    land_and_print,
    land_orders,
    landed_totals,
)

STAGES = ("bronze", "silver", "quality", "gold", "quarantine", "all")


def pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderloom")
    parser.add_argument("--master")
    what = parser.add_subparsers(dest="what", required=True)
    for name in STAGES:
        stage = what.add_parser(name)
        stage.add_argument("--raw-root", default="")
        stage.add_argument("--file-pattern", default="{table}.csv")
        stage.add_argument("--translation-file", help="file name of the category translation")
        stage.add_argument("--multi-line", nargs="*", default=[], metavar="TABLE")
        stage.add_argument("--schemas", help="JSON file with a schema text per table; without one Spark reads twice")
        stage.add_argument("--min-amount", type=float, default=0)
        stage.add_argument("--top", type=int, default=config.TOP_CUSTOMERS, help="customers in the ranking")
        stage.add_argument("--run-name", default="order_run")
        stage.add_argument("--database", nargs="*", default=[], metavar="LAYER=NAME", type=pair)
        stage.add_argument("--table-format", default="parquet")
        stage.add_argument("--location", help="shared folder for the tables")
        stage.add_argument("--first-date", type=date.fromisoformat, default=config.FIRST_ORDER_DATE)
        stage.add_argument("--last-date", type=date.fromisoformat, default=config.LAST_ORDER_DATE)
        stage.add_argument("--rejects", action="store_true", help="keep malformed lines in tables of their own")
        stage.add_argument(
            "--unique-references", action="store_true", help="stop at repeated customers, products or categories"
        )
    compaction = what.add_parser("compact", help="put small files of appended tables, or of a landing, together")
    compaction.add_argument("--table", nargs="*", default=[], metavar="DATABASE.TABLE")
    compaction.add_argument("--landing", help="folder of a stream that prints its matches")
    clustering = what.add_parser("cluster", help="order a table by columns, rewriting only what overlaps")
    clustering.add_argument("table", metavar="DATABASE.TABLE")
    clustering.add_argument("columns", nargs="+")
    stream = what.add_parser("stream")
    stream.add_argument("--topic", required=True, help="topic name, or folder of JSON lines")
    stream.add_argument("--brokers", help="Kafka bootstrap servers; without them the topic is a folder")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--threshold", type=float, default=config.HIGH_VALUE_THRESHOLD)
    stream.add_argument("--idle-seconds", type=float, help="keep listening until idle this long")
    stream.add_argument("--batch-limit", type=int)
    stream.add_argument("--min-partitions", type=int)
    stream.add_argument("--option", nargs="*", default=[], metavar="KEY=VALUE", type=pair, help="for the connector")
    stream.add_argument("--every", default="1 second", help="time between batches while listening")
    stream.add_argument("--print-matches", action="store_true", help="also print every match, and show the first")
    return parser.parse_args(argv)


def run_config(args: argparse.Namespace) -> config.RunConfig:
    schemas = json.loads(Path(args.schemas).read_text()) if args.schemas else None
    files = {"product_category_translation": args.translation_file} if args.translation_file else None
    return config.RunConfig(
        raw_root=args.raw_root,
        datasets=config.raw_datasets(
            args.file_pattern, files=files, schemas=schemas, multi_line=tuple(args.multi_line)
        ),
        layers=config.Layers(**dict(args.database), location=args.location),
        min_order_amount=args.min_amount,
        top_customers=args.top,
        run_name=args.run_name,
        table_format=args.table_format,
        first_order_date=args.first_date,
        last_order_date=args.last_date,
        rejects=args.rejects,
        unique_references=args.unique_references,
    )


def run_stage(spark, args: argparse.Namespace) -> None:
    cfg = run_config(args)
    if args.what == "all":
        staged_run.run_stages(spark, cfg).summary(spark).show(truncate=False)
    elif args.what == "quality":
        verdict = staged_run.check_quality(spark, cfg)
        verdict.results_frame(spark).show(truncate=False)
        print(verdict.to_json())
    else:
        stage = {
            "bronze": staged_run.ingest_bronze,
            "silver": staged_run.transform_silver,
            "gold": staged_run.build_gold,
            "quarantine": staged_run.quarantine,
        }[args.what]
        for table, rows in stage(spark, cfg).items():
            print(f"{table}: {rows} rows")


def run_stream(spark, args: argparse.Namespace) -> StreamCounts:
    topic = Topic(
        args.topic,
        "kafka" if args.brokers else "folder",
        args.brokers,
        batch_limit=args.batch_limit,
        min_partitions=args.min_partitions,
        options=dict(args.option),
    )
    counts = StreamCounts()
    shared = dict(threshold=args.threshold, continuous=args.idle_seconds is not None, every=args.every)
    target = (stream_topic(spark, topic), args.landing, args.checkpoint)
    if args.print_matches:
        drain(land_and_print(*target, counts=counts, preview=print, **shared), args.idle_seconds)
    else:
        counts = drain(land_orders(*target, **shared), args.idle_seconds)
    print(f"landed {counts.matched}, rejected {counts.rejected}: {args.landing}")
    if args.print_matches:
        total = landed_totals(spark, args.landing)
        print(f"in all runs: landed {total.matched}, rejected {total.rejected}, batches {total.batches}")
    return counts


def run_upkeep(spark, args: argparse.Namespace) -> None:
    if args.what == "cluster":
        database, _, table = args.table.partition(".")
        print(f"{args.table}: {cluster_table(spark, database, table, *args.columns)} parts rewritten")
        return
    for name in args.table:
        database, _, table = name.partition(".")
        print(f"{name}: {compact_table(spark, database, table)} parts put together")
    if args.landing:
        print(f"{args.landing}: {compact_printed_landing(spark, args.landing)} batches put together")


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("orderloom", args.master)
    if args.what == "stream":
        run_stream(spark, args)
    elif args.what in ("compact", "cluster"):
        run_upkeep(spark, args)
    else:
        run_stage(spark, args)


if __name__ == "__main__":
    main()
