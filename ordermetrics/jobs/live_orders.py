"""spark-submit entry: keep live metrics and dead letters of an order stream.

    spark-submit --packages <kafka connector> --py-files ordermetrics.zip \\
        ordermetrics/jobs/live_orders.py \\
        --format kafka --option kafka.bootstrap.servers=host:port \\
        --target <table folder> --checkpoint <checkpoint folder>

With ``--jdbc url=... --jdbc user=...`` window rows go to the database table
``live_metrics`` instead of files; the stored changes stay below the target. With ``--log``
the source is read and parsed once, into an event log that metrics follow and dead letters
stay in (``ordermetrics.streaming.event_log``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ordermetrics.schemas import TRIGGER, WATERMARK, WINDOW_KEYS, WINDOW_WIDTH
from ordermetrics.session import pin_utc
from ordermetrics.sinks.jdbc import merge_into_jdbc
from ordermetrics.sources.orders import read_orders
from ordermetrics.streaming.dead_letters import start_dead_letters
from ordermetrics.streaming.event_log import read_order_log, start_order_log
from ordermetrics.streaming.live import start_live_metrics, start_metrics_of_orders
from ordermetrics.streaming.monitor import ProgressLog


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--format", default="kafka", help="kafka, text for files, or table")
    parser.add_argument("--path", help="folder of a file source, or name of a table")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--target", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--window", default=WINDOW_WIDTH)
    parser.add_argument("--watermark", default=WATERMARK)
    parser.add_argument("--trigger", default=TRIGGER)
    parser.add_argument("--slot", choices=["hour", "day"], default="hour")
    parser.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--dedup", action="store_true", help="count repeated order ids once")
    parser.add_argument("--log", help="folder of an event log: read and parse the source once for "
                        "metrics and dead letters")
    parser.add_argument("--available-now", action="store_true", help="take what is there and stop")
    return parser.parse_args(argv)


def key_values(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    pin_utc(spark)
    options = key_values(args.option)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    spark.streams.addListener(ProgressLog())

    sink = None
    if args.jdbc:
        def sink(rows, batch_id):
            merge_into_jdbc(
                spark, rows, key_values(args.jdbc), "live_metrics", WINDOW_KEYS, batch_id)

    def messages():
        return read_orders(spark, args.format, args.path, **options)

    if args.log:
        run_from_log(spark, args, messages(), trigger, sink)
        return
    queries = [
        start_live_metrics(
            messages(), args.target, f"{args.checkpoint}/live_metrics", args.window,
            args.watermark, trigger, args.strict, args.slot, sink, dedup=args.dedup,
        ),
        start_dead_letters(
            messages(), f"{args.target}/dead_letters", f"{args.checkpoint}/dead_letters",
            trigger, args.strict,
        ),
    ]
    wait_for(spark, args, queries)


def run_from_log(spark, args, messages, trigger, sink) -> None:
    """The log takes the messages; metrics follow it, dead letters stay in it."""
    ingest = start_order_log(
        messages, args.log, f"{args.checkpoint}/order_log", trigger, args.strict)
    if args.available_now:
        ingest.awaitTermination()
    wait_for(spark, args, [ingest, start_metrics_of_orders(
        read_order_log(spark, args.log), args.target, f"{args.checkpoint}/live_metrics",
        args.window, args.watermark, trigger, args.slot, sink, args.dedup)])


def wait_for(spark: SparkSession, args: argparse.Namespace, queries: list) -> None:
    if args.available_now:
        for query in queries:
            query.awaitTermination()
    else:
        # Returns or raises as soon as either stream ends.
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    args = arguments()
    session = SparkSession.builder.appName("live_orders").getOrCreate()
    try:
        run(session, args)
    finally:
        session.stop()
