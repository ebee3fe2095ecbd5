"""Daily totals and odd hours, from window metrics (never from raw orders)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermetrics.functions.text import day_line
from ordermetrics.functions.times import day_bounds
from ordermetrics.operators.outliers import flag_outliers
from ordermetrics.schemas import HOURLY_ORDER_COUNT, Z


def day_filter(metrics: DataFrame, day: date | str) -> DataFrame:
    """Windows that start on ``day``: a plain range, which every source can push down.

    A table partitioned by ``window_date`` is also pruned to that one partition.
    """
    start, end = day_bounds(day)
    rows = metrics.filter((F.col("window_start") >= start) & (F.col("window_start") < end))
    if "window_date" in metrics.columns:
        rows = rows.filter(F.col("window_date") == start.cast("date"))
    return rows


def daily_summary(metrics: DataFrame) -> DataFrame:
    """Orders, revenue and average order value per day."""
    orders, revenue = F.col("total_orders"), F.col("total_revenue")
    return (
        metrics.groupBy(F.to_date("window_start").alias("summary_date"))
        .agg(
            F.sum("order_count").alias("total_orders"),
            F.sum("total_revenue").cast("double").alias("total_revenue"),
        )
        .withColumn("avg_order_value", F.when(orders > 0, revenue / orders).otherwise(0.0))
    )


def hourly_totals(metrics: DataFrame) -> DataFrame:
    """Orders and revenue per day and hour; hours without windows have no row."""
    return metrics.groupBy(
        F.to_date("window_start").alias("d"), F.hour("window_start").alias("hour")
    ).agg(
        F.sum("order_count").alias("hourly_orders"),
        F.sum("total_revenue").cast("double").alias("hourly_revenue"),
    )


def daily_summary_of_hours(hourly: DataFrame) -> DataFrame:
    """:func:`daily_summary` from the rows of :func:`hourly_totals`."""
    orders, revenue = F.col("total_orders"), F.col("total_revenue")
    return (
        hourly.groupBy(F.col("d").alias("summary_date"))
        .agg(
            F.sum("hourly_orders").alias("total_orders"),
            F.sum("hourly_revenue").alias("total_revenue"),
        )
        .withColumn("avg_order_value", F.when(orders > 0, revenue / orders).otherwise(0.0))
    )


# Metric label of an anomaly row -> column of hourly_totals it looks at.
HOURLY_METRICS = {HOURLY_ORDER_COUNT: "hourly_orders", "hourly_revenue": "hourly_revenue"}


def hourly_anomalies(
    hourly: DataFrame, metric: str = HOURLY_ORDER_COUNT, z: float = Z
) -> DataFrame:
    """Hours whose value lies more than ``z`` deviations from the day's mean hour."""
    value = HOURLY_METRICS[metric]
    return flag_outliers(hourly, "d", value, z).select(
        F.col("d").alias("detected_date"),
        "hour",
        F.lit(metric).alias("metric"),
        F.col(value).cast("double").alias("value"),
        "expected_low",
        "expected_high",
    )


def anomaly_counts(
    hourly: DataFrame, metric: str = HOURLY_ORDER_COUNT, z: float = Z
) -> DataFrame:
    """Totals, expected range and number of odd hours per day; days without any count 0.

    The statistics sit on the hours themselves, so the source is read once. A day has at
    most 24 rows here, which bounds the window.
    """
    value, day = F.col(HOURLY_METRICS[metric]), Window.partitionBy("d")
    mean, spread = F.col("mean"), F.lit(float(z)) * F.col("stddev")
    return (
        hourly.withColumns({
            "mean": F.avg(value).over(day),
            "stddev": F.coalesce(F.stddev_pop(value).over(day), F.lit(0.0)),
        })
        .groupBy("d")
        .agg(
            F.sum("hourly_orders").alias("total_orders"),
            F.sum("hourly_revenue").alias("total_revenue"),
            F.count_if((spread > 0) & (F.abs(value - mean) > spread)).alias("flagged"),
            F.min(mean - spread).alias("expected_low"),
            F.max(mean + spread).alias("expected_high"),
        )
    )


def daily_report(metrics: DataFrame, z: float = Z) -> DataFrame:
    """One line of text per day."""
    return daily_report_of_hours(hourly_totals(metrics), z)


def daily_report_of_hours(hourly: DataFrame, z: float = Z) -> DataFrame:
    """:func:`daily_report` from the rows of :func:`hourly_totals`."""
    orders, revenue = F.col("total_orders"), F.col("total_revenue")
    average = F.when(orders > 0, revenue / orders).otherwise(0.0)
    line = day_line(
        F.col("d"), orders, revenue, average,
        F.col("flagged"), F.col("expected_low"), F.col("expected_high"),
    )
    return anomaly_counts(hourly, z=z).select("d", line.alias("line"))
