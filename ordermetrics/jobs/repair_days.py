"""spark-submit entry: make closed days of the stored live metrics equal to archived orders.

    spark-submit --py-files ordermetrics.zip ordermetrics/jobs/repair_days.py \\
        --root <table folder> --path <archive folder> --first 2024-01-01 --last 2024-01-14

The archive holds order messages, one a line, or is a topic (``--format kafka``). Reconcile the
repaired days afterwards: their totals and flags follow from the windows.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from ordermetrics.jobs.live_orders import key_values
from ordermetrics.operators.parse import parse_orders, valid_orders
from ordermetrics.plans.repair import repair_live_metrics
from ordermetrics.schemas import WINDOW_WIDTH
from ordermetrics.session import pin_utc
from ordermetrics.sources.orders import read_orders


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True)
    parser.add_argument("--format", default="text", help="text for files, or kafka")
    parser.add_argument("--path", help="folder of a file source")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--first", type=date.fromisoformat, help="default: the archive's first day")
    parser.add_argument("--last", type=date.fromisoformat, help="default: the archive's last day")
    parser.add_argument("--window", default=WINDOW_WIDTH)
    parser.add_argument("--strict", action="store_true")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[date]:
    messages = read_orders(
        pin_utc(spark), args.format, args.path, streaming=False, **key_values(args.option))
    orders = valid_orders(parse_orders(messages), args.strict)
    days = repair_live_metrics(spark, args.root, orders, args.first, args.last, args.window)
    print(f"{len(days)} days repaired" + "".join(f"\n{day}" for day in days))
    return days


if __name__ == "__main__":
    args = arguments()
    session = SparkSession.builder.appName("repair_days").getOrCreate()
    try:
        run(session, args)
    finally:
        session.stop()
