"""Command line for the jobs: ``python -m quire <job> ...`` (or via spark-submit).

Jobs: document-store, keyed-tables (batch); normalise, publish, filter, load,
archive (streams). Topics are ``--*-topic`` with ``--broker`` (Kafka) or
``--*-path`` (file twin). The session comes from the environment
(``spark-submit`` configuration); ``spark.checkpoint.dir`` must name a shared
folder on a cluster.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from quire.plans.jobs import document_store_job, keyed_tables_job
from quire.schemas import PAGE_CREATIONS
from quire.sinks import ConnectorTable, KeyedTable
from quire.streaming.jobs import (
    Endpoint, start_archive_job, start_filter_job, start_load_job, start_normalise_job,
    start_publish_job,
)


def _options(pairs: list[str] | None) -> dict:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _endpoint(args, role: str) -> Endpoint:
    topic, path = getattr(args, f"{role}_topic"), getattr(args, f"{role}_path")
    if topic:
        end = Endpoint("kafka", topic=topic,
                       options={"kafka.bootstrap.servers": args.broker, **_options(args.option)})
    elif path:
        end = Endpoint(path=path)
    else:
        raise SystemExit(f"give --{role}-topic or --{role}-path")
    if role == "source":
        end.starting_offsets, end.max_per_trigger = args.starting_offsets, args.max_per_trigger
    return end


class _Printed(list):
    """Batch counts, printed as they come and not kept."""

    def append(self, counts):
        print(json.dumps(counts), flush=True)


def _stream_args(p: argparse.ArgumentParser, source: bool = True, sink: bool = True) -> None:
    if source:
        p.add_argument("--source-topic")
        p.add_argument("--source-path")
        p.add_argument("--starting-offsets", help="earliest, latest or a JSON of offsets")
        p.add_argument("--max-per-trigger", type=int, help="offsets or files a micro-batch takes at most")
    if sink:
        p.add_argument("--sink-topic")
        p.add_argument("--sink-path")
    p.add_argument("--broker", default="localhost:9092")
    p.add_argument("--option", action="append", help="extra connector option k=v")
    p.add_argument("--checkpoint")
    p.add_argument("--available-now", action="store_true",
                   help="process what is there, then stop (default: run until stopped)")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m quire")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("document-store", help="reviews CSV -> 3 marts, replaced whole")
    p.add_argument("csv", nargs="+", help="files or patterns with the same header")
    p.add_argument("out")
    p.add_argument("--format", default="parquet")
    p.add_argument("--option", action="append")

    p = sub.add_parser("keyed-tables", help="reviews CSV -> keyed review tables + leaderboards")
    p.add_argument("csv", nargs="+", help="files or patterns with the same header")
    p.add_argument("root")
    p.add_argument("--batch-id", type=int, help="replay this batch (default: add a new one)")
    p.add_argument("--store-format")
    p.add_argument("--store-option", action="append")

    _stream_args(sub.add_parser("normalise", help="event lines -> page messages"))
    p = sub.add_parser("publish", help="CSV rows -> stamped JSON messages")
    p.add_argument("csv_dir")
    p.add_argument("--columns", required=True, help="comma-separated CSV header")
    _stream_args(p, source=False)
    _stream_args(sub.add_parser("filter", help="page messages -> allowed, human -> processed"))
    p = sub.add_parser("load", help="processed messages -> page_creations keyed table")
    _stream_args(p, sink=False)
    p.add_argument("--table-path")
    p.add_argument("--store-format")
    p.add_argument("--store-option", action="append")
    p.add_argument("--compact-every", type=int)
    p.add_argument("--rejects-path", help="where rows with a null key column are kept")
    p = sub.add_parser("archive", help="tweet messages -> per-minute CSV files")
    _stream_args(p, sink=False)
    p.add_argument("out")
    p.add_argument("--writers-per-minute", type=int, default=1)

    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"quire-{args.job}").getOrCreate()

    if args.job == "document-store":
        print(json.dumps(document_store_job(spark, args.csv, args.out, args.format,
                                            _options(args.option))))
        return 0
    if args.job == "keyed-tables":
        print(json.dumps(keyed_tables_job(spark, args.csv, args.root, args.batch_id,
                                          store_format=args.store_format,
                                          store_options=_options(args.store_option))))
        return 0

    trigger = {"availableNow": True} if args.available_now else None
    if args.job == "normalise":
        q = start_normalise_job(spark, _endpoint(args, "source"), _endpoint(args, "sink"),
                                args.checkpoint, trigger)
    elif args.job == "publish":
        q = start_publish_job(spark, args.csv_dir, args.columns.split(","),
                              _endpoint(args, "sink"), args.checkpoint, trigger)
    elif args.job == "filter":
        q = start_filter_job(spark, _endpoint(args, "source"), _endpoint(args, "sink"),
                             args.checkpoint, trigger)
    elif args.job == "load":
        if args.store_format:
            table = ConnectorTable(spark, PAGE_CREATIONS, args.store_format,
                                   {"table": PAGE_CREATIONS.name, **_options(args.store_option)})
        elif args.table_path:
            table = KeyedTable(spark, args.table_path, PAGE_CREATIONS, args.rejects_path)
        else:
            raise SystemExit("give --table-path or --store-format")
        q = start_load_job(spark, _endpoint(args, "source"), table, args.checkpoint, trigger,
                           metrics=_Printed(), compact_every=args.compact_every)
    else:
        q = start_archive_job(spark, _endpoint(args, "source"), args.out, args.checkpoint,
                              trigger, writers_per_minute=args.writers_per_minute)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
