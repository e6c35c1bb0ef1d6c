"""Command line of the jobs.

    python -m clickloom.job land     --messages DIR [--archive DIR] --lake DIR --checkpoint DIR [--once]
    python -m clickloom.job land     --kafka-servers HOSTS --topic NAME --lake DIR --checkpoint DIR [--once]
    python -m clickloom.job autoload --lake DIR --raw DIR --checkpoint DIR [--once]
    python -m clickloom.job compact  --lake DIR --raw DIR --before 2025-11-01
    python -m clickloom.job refresh  --raw DIR --products CSV --users CSV --warehouse DIR
                                     --run-id ID --loaded-at "2025-11-24 00:00:00"
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from clickloom.operators.lookup import MAX_BROADCAST_BYTES
from clickloom.plans.refresh import RefreshConfig, refresh
from clickloom.schemas import DEFAULT_MIN_EVENT_TS, SESSION_GAP_MINUTES
from clickloom.session import build_session
from clickloom.sources.dimensions import read_products, read_users
from clickloom.sources.messages import MAX_FILES, MAX_OFFSETS, stream_kafka, stream_text
from clickloom.sources.raw import MAX_BATCHES, read_raw
from clickloom.streaming.landing import compact, keep_landing, keep_loading, land_files, land_messages, load_batches


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clickloom")
    commands = parser.add_subparsers(dest="command", required=True)

    def stream(name: str, *places: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        for place in (*places, "checkpoint"):
            command.add_argument(f"--{place}", required=True)
        command.add_argument("--max-files", type=int, default=MAX_FILES, help="files per micro-batch")
        command.add_argument("--once", action="store_true", help="take what is there and stop")
        return command

    command = stream("land", "lake")
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of text files")
    source.add_argument("--kafka-servers", help="brokers of a queue")
    command.add_argument("--topic", help="topic of the queue")
    command.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="messages per micro-batch")
    command.add_argument("--max-bytes", help="bytes of text files per micro-batch, e.g. 1g")
    command.add_argument("--archive", help="where landed text files are moved")
    command = stream("autoload", "lake", "raw")
    command.add_argument("--max-batches", type=int, default=MAX_BATCHES, help="batches of the lake loaded in one step")

    command = commands.add_parser("compact")
    command.add_argument("--lake")
    command.add_argument("--raw")
    command.add_argument("--before", required=True, help="first date that stays open")

    command = commands.add_parser("refresh")
    for name in ("raw", "products", "users", "warehouse", "run-id", "loaded-at"):
        command.add_argument(f"--{name}", required=True)
    command.add_argument("--min-event-ts", default=DEFAULT_MIN_EVENT_TS)
    command.add_argument("--gap-minutes", type=int, default=SESSION_GAP_MINUTES)
    command.add_argument("--closed-validity", action="store_true")
    command.add_argument("--split-guests", action="store_true", help="sessions of guests by visitor")
    command.add_argument("--approx-products", type=int, help="estimate distinct products with 2^N buckets")
    command.add_argument("--raw-bytes", type=int)
    command.add_argument("--max-broadcast-bytes", type=int, default=MAX_BROADCAST_BYTES)
    args = parser.parse_args(argv)
    if args.command == "land" and bool(args.kafka_servers) != bool(args.topic):
        parser.error("--kafka-servers and --topic go together")
    if args.command == "land" and args.archive and not args.messages:
        parser.error("--archive goes with --messages")
    if args.command == "compact" and args.lake and not args.raw:
        parser.error("--lake needs --raw, which shows what was loaded")
    return args


def message_stream(spark, args: argparse.Namespace):
    if args.kafka_servers:
        return stream_kafka(spark, args.kafka_servers, args.topic, args.max_offsets)
    return stream_text(spark, args.messages, args.max_files, args.max_bytes, args.archive)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"clickloom-{args.command}")
    if args.command == "land":
        if args.archive and args.once:
            land_files(spark, args.messages, args.lake, args.archive, args.max_files)
        elif args.archive:
            keep_landing(spark, args.messages, args.lake, args.archive, args.checkpoint, args.max_files).awaitTermination()
        else:
            source = message_stream(spark, args)
            land_messages(source, args.lake, args.checkpoint, continuous=not args.once).awaitTermination()
    elif args.command == "autoload":
        if args.once:
            load_batches(spark, args.lake, args.raw, args.max_batches)
        else:
            keep_loading(spark, args.lake, args.raw, args.checkpoint, args.max_batches).awaitTermination()
    elif args.command == "compact":
        compact(spark, args.lake, args.raw, args.before)
    else:
        config = RefreshConfig(
            args.warehouse,
            args.run_id,
            args.loaded_at,
            args.min_event_ts,
            args.gap_minutes,
            args.closed_validity,
            args.split_guests,
            args.approx_products,
            args.raw_bytes,
            args.max_broadcast_bytes,
        )
        raw = read_raw(spark, args.raw)
        refresh(spark, config, raw, read_products(spark, args.products), read_users(spark, args.users))


if __name__ == "__main__":
    main()
