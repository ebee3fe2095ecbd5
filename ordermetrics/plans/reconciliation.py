"""The nightly pass over stored window metrics."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermetrics.operators.daily import (
    daily_report_of_hours, daily_summary_of_hours, day_filter, hourly_anomalies, hourly_totals,
)
from ordermetrics.schemas import HOURLY_ORDER_COUNT, Z
from ordermetrics.session import pin_utc
from ordermetrics.sinks.files import merge_table, read_table


# Merges rows into the table of that name. With a scope, stored rows in it that the merge
# does not name are removed.
Merge = Callable[[str, DataFrame, DataFrame | None], None]


class Reconciliation(NamedTuple):
    summary: DataFrame
    anomalies: DataFrame
    report: DataFrame


def reconcile(metrics: DataFrame, day: date | str | None = None, z: float = Z) -> Reconciliation:
    """Daily totals, odd hours and report lines of one day, or of every day at once."""
    return reconcile_hours(day_hours(metrics, day), z)


def day_hours(metrics: DataFrame, day: date | str | None = None) -> DataFrame:
    """The hours of one day, or of every day: at most 24 rows each."""
    return hourly_totals(metrics if day is None else day_filter(metrics, day))


def reconcile_hours(hourly: DataFrame, z: float = Z) -> Reconciliation:
    """:func:`reconcile` from hours that are already summed."""
    return Reconciliation(
        daily_summary_of_hours(hourly),
        hourly_anomalies(hourly, z=z),
        daily_report_of_hours(hourly, z),
    )


def anomaly_scope(hourly: DataFrame, metric: str = HOURLY_ORDER_COUNT) -> DataFrame:
    """The days whose flags a reconciliation of these hours settles, one row each."""
    return hourly.select(F.col("d").alias("detected_date"), F.lit(metric).alias("metric")).distinct()


def write_reconciliation(
    metrics: DataFrame, merge: Merge, day: date | str | None = None, z: float = Z
) -> list[str]:
    """Reconcile ``metrics``, merge the results, and return the report lines.

    The result is empty, and nothing is written, when the day has no windows. Repeating
    a day replaces its rows, and hours that are no longer odd lose their flag; days without
    windows, and what other metrics flagged, stay as they are. Lines are one per day, so they
    are small enough to return.
    ``metrics`` is read once: all three results come from its hours, which are kept, so
    that they agree beside a running stream too.
    """
    hours = day_hours(metrics, day).persist()
    try:
        result = reconcile_hours(hours, z)
        lines = [row.line for row in result.report.orderBy("d").collect()]
        if lines:
            merge("daily_summary", result.summary, None)
            merge("anomalies", result.anomalies.withColumn("flagged_at", F.current_timestamp()),
                  anomaly_scope(hours))
        return lines
    finally:
        hours.unpersist()


def reconcile_tables(
    spark: SparkSession, root: str, day: date | str | None = None, z: float = Z
) -> list[str]:
    """:func:`write_reconciliation` for the tables below ``root``."""
    return write_reconciliation(
        read_table(pin_utc(spark), root, "live_metrics"),
        lambda name, rows, scope: merge_table(spark, root, name, rows, scope), day, z,
    )
