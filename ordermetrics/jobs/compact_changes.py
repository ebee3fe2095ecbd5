"""spark-submit entry: reduce the stored changes of closed hours to one folder each.

What the previous run, or a fold while the hour was open, has replaced is removed first.

    spark-submit --py-files ordermetrics.zip ordermetrics/jobs/compact_changes.py \\
        --target <table folder> --checkpoint <checkpoint folder> --before 2024-01-15-00

``--before`` has to lie earlier than the stream's watermark; a day back is ample. The
checkpoint, the same as the streaming job's, tells which batches will not run again.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ordermetrics.streaming.changes import (
    compact_slots, last_committed, remove_replaced, slots_before,
)
from ordermetrics.streaming.live import CHANGES

AT_ONCE = 100


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--target", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--before", required=True, metavar="YYYY-MM-DD-HH")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    path = f"{args.target}/{CHANGES}"
    committed = last_committed(spark, f"{args.checkpoint}/live_metrics")
    remove_replaced(spark, path, args.before)
    slots = slots_before(spark, path, args.before, committed)
    for first in range(0, len(slots), AT_ONCE):
        compact_slots(spark, path, slots[first:first + AT_ONCE], committed)
    print(f"{len(slots)} slots reduced")
    return len(slots)


if __name__ == "__main__":
    args = arguments()
    session = SparkSession.builder.appName("compact_changes").getOrCreate()
    try:
        run(session, args)
    finally:
        session.stop()
