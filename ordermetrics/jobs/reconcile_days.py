"""spark-submit entry: reconcile one day, or every day, of the stored live metrics.

    spark-submit --py-files ordermetrics.zip ordermetrics/jobs/reconcile_days.py \\
        --root <table folder> --date 2024-01-15

With ``--jdbc url=... --jdbc user=...`` the tables are those of a database; a date is
then required, and the scan is split by hour.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from ordermetrics.jobs.live_orders import key_values
from ordermetrics.plans.reconciliation import reconcile_tables, write_reconciliation
from ordermetrics.schemas import Z
from ordermetrics.session import pin_utc
from ordermetrics.sinks.files import TABLES
from ordermetrics.sinks.jdbc import merge_into_jdbc
from ordermetrics.sources.metrics_table import read_live_metrics_jdbc


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root")
    parser.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--date", type=date.fromisoformat, help="default: every stored day")
    parser.add_argument("--z", type=float, default=Z)
    args = parser.parse_args(argv)
    if bool(args.root) == bool(args.jdbc):
        parser.error("give either --root or --jdbc")
    if args.jdbc and not args.date:
        parser.error("--jdbc needs --date")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    pin_utc(spark)
    if args.jdbc:
        options = key_values(args.jdbc)
        lines = write_reconciliation(
            read_live_metrics_jdbc(spark, options, args.date, args.date),
            lambda name, rows, scope: merge_into_jdbc(
                spark, rows, options, name, TABLES[name].keys, scope=scope),
            args.date, args.z,
        )
    else:
        lines = reconcile_tables(spark, args.root, args.date, args.z)
    for line in lines or [f"no windows stored for {args.date or 'any day'}"]:
        print(line)
    return lines


if __name__ == "__main__":
    args = arguments()
    session = SparkSession.builder.appName("reconcile_days").getOrCreate()
    try:
        run(session, args)
    finally:
        session.stop()
