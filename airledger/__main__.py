"""Run the pipeline from a topic or from files.

Example: python -m airledger --root hdfs:///air --servers broker:9092 --topic db.public.co2_measurements
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .config import DRAIN, Rules, StreamSettings
from .session import build_session
from .sources import changes
from .streaming import days, pipeline, queries as Q, sinks


def database_writers(
    root: str, url: str, dsn: str | None, properties: dict[str, str]
) -> dict[str, sinks.BatchWriter]:
    """Writers that put the results into database tables instead of Parquet."""
    writers = {
        table.name: sinks.jdbc_append(table, url, f"{root}/rejected/{table.name}", **properties)
        for table in (schemas.MINUTE_AVERAGES, schemas.HOURLY_AGGREGATES, schemas.ALERTS)
    }
    if dsn:
        status = schemas.CURRENT_STATUS
        connect = partial(sinks.postgres_connection, dsn)
        writers[status.name] = sinks.database_upsert(
            connect, status, "last_updated", f"{root}/rejected/{status.name}"
        )
    return writers


def pairs(options: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="airledger", description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="shared folder for outputs and checkpoints")
    parser.add_argument("--servers", help="topic brokers; leave out to read files")
    parser.add_argument("--topic")
    parser.add_argument("--files", help="directory with change files")
    parser.add_argument(
        "--feed",
        action="append",
        default=[],
        metavar="NAME=PLACE",
        help="one of several feeds, a topic with --servers and a directory without; each has its own watermark",
    )
    parser.add_argument("--idle-after", type=float, help="seconds after which a silent feed is not waited for")
    parser.add_argument("--format", choices=("parquet", "text", "ordered-text"), default="parquet")
    parser.add_argument("--option", action="append", default=[], help="source option key=value")
    parser.add_argument("--partitions", type=int, help="shuffle partitions, fixed at first start")
    parser.add_argument("--files-per-batch", type=int, help="output files per batch and table")
    parser.add_argument(
        "--windows-from",
        type=datetime.fromisoformat,
        help="windows before this hour come from a batch (first start on a long history)",
    )
    parser.add_argument("--every", default="10 seconds", help="trigger interval")
    parser.add_argument("--drain", action="store_true", help="process what is there, then stop")
    parser.add_argument("--jdbc-url", help="append aggregates and alerts to this database")
    parser.add_argument("--jdbc-option", action="append", default=[], help="key=value")
    parser.add_argument("--dsn", help="upsert the status into this PostgreSQL (with --jdbc-url)")
    parser.add_argument(
        "--refresh-alert-summary",
        action="store_true",
        help="bring alert_summary_hourly up to the stored alerts, then stop",
    )
    parser.add_argument(
        "--refresh-trends", action="store_true", help="bring the daily views up to the stored changes, then stop"
    )
    parser.add_argument("--bronze-every", help="trigger interval of the bronze table")
    parser.add_argument("--warning", type=float, default=Rules.warning)
    parser.add_argument("--critical", type=float, default=Rules.critical)
    args = parser.parse_args(argv)
    if bool(args.jdbc_url) != bool(args.dsn):
        parser.error("--jdbc-url and --dsn go together: all four tables belong in one database")
    rules = Rules(args.warning, args.critical)
    if args.refresh_alert_summary or args.refresh_trends:
        spark = build_session()
        if args.refresh_alert_summary:
            days.refresh_alert_summary(spark, args.root)
        if args.refresh_trends:
            days.refresh_trends(spark, args.root, rules, Q.stored_seq_type(spark, args.root))
        return
    if args.feed and (args.topic or args.files):
        parser.error("--feed takes the place of --topic and --files")
    if not args.feed and bool(args.topic and args.servers) == bool(args.files):
        parser.error("give either --servers with --topic, or --files")

    spark = build_session()
    options = pairs(args.option)

    def feed_of(place: str) -> DataFrame:
        if args.servers:
            return changes.stream_topic(spark, args.servers, place, drain=args.drain, **options)
        return changes.stream_files(spark, place, args.format, drain=args.drain, **options)

    if args.feed:
        feed = {name: feed_of(place) for name, place in pairs(args.feed).items()}
    else:
        feed = feed_of(args.files or args.topic)
    trigger = DRAIN if args.drain else {"processingTime": args.every}
    settings = StreamSettings(
        trigger=trigger,
        shuffle_partitions=args.partitions,
        files_per_batch=args.files_per_batch,
        windows_from=args.windows_from,
        bronze_trigger={"processingTime": args.bronze_every} if args.bronze_every else None,
    )
    if args.idle_after is not None:
        settings = replace(settings, idle_after_seconds=args.idle_after)
    run = pipeline.drain if args.drain else pipeline.run_live
    writers = {}
    if args.jdbc_url:
        writers = database_writers(args.root, args.jdbc_url, args.dsn, pairs(args.jdbc_option))
    run(feed, args.root, settings, rules, writers)


if __name__ == "__main__":
    main()
