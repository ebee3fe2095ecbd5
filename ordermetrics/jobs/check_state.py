"""spark-submit entry: compare the state of a live stream's checkpoint with what it has stored.

    spark-submit --py-files ordermetrics.zip ordermetrics/jobs/check_state.py \\
        --target <table folder> --checkpoint <checkpoint folder> [--out <folder>]

The checkpoint is the streaming job's. Stop the stream first. The exit code is 1 if any key
differs; ``--out`` keeps all of them as parquet.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ordermetrics.session import pin_utc
from ordermetrics.streaming.state import state_drift


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--target", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--out", help="folder for the differing keys")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    drift = state_drift(pin_utc(spark), args.target, f"{args.checkpoint}/live_metrics").persist()
    try:
        counts = {row.status: row.n for row in drift.groupBy("status").agg(F.count("*").alias("n")).collect()}
        if args.out:
            drift.write.mode("overwrite").parquet(args.out)
    finally:
        drift.unpersist()
    for status in sorted(counts):
        print(f"{status}: {counts[status]} keys")
    if not counts:
        print("state and stored totals agree")
    return sum(counts.values())


if __name__ == "__main__":
    args = arguments()
    session = SparkSession.builder.appName("check_state").getOrCreate()
    try:
        differing = run(session, args)
    finally:
        session.stop()
    sys.exit(1 if differing else 0)
