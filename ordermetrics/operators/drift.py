"""Compare stored window metrics with a recomputation from the orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermetrics.schemas import WINDOW_KEYS


def drift_report(stored: DataFrame, recomputed: DataFrame, cents: float = 0.005) -> DataFrame:
    """Windows that are missing from, extra in, or different in the stored table.

    Revenues closer than ``cents`` are equal: sums of doubles depend on their order.
    """
    values = ["total_revenue", "order_count", "top_sku"]
    left = stored.select(*WINDOW_KEYS, F.struct(*values).alias("stored"))
    right = recomputed.select(*WINDOW_KEYS, F.struct(*values).alias("actual"))
    was, now = F.col("stored.total_revenue"), F.col("actual.total_revenue")
    same = (
        (was.eqNullSafe(now) | (F.abs(was - now) < cents))
        & F.col("stored.order_count").eqNullSafe(F.col("actual.order_count"))
        & F.col("stored.top_sku").eqNullSafe(F.col("actual.top_sku"))
    )
    status = (
        F.when(F.col("stored").isNull(), "missing")
        .when(F.col("actual").isNull(), "extra")
        .when(~F.coalesce(same, F.lit(False)), "different")
    )
    return (
        left.join(right, WINDOW_KEYS, "full")
        .withColumn("status", status)
        .filter("status IS NOT NULL")
        .select(
            *WINDOW_KEYS, "status",
            F.col("stored.total_revenue").alias("stored_revenue"),
            F.col("actual.total_revenue").alias("actual_revenue"),
            F.col("stored.order_count").alias("stored_count"),
            F.col("actual.order_count").alias("actual_count"),
            F.col("stored.top_sku").alias("stored_top_sku"),
            F.col("actual.top_sku").alias("actual_top_sku"),
        )
    )


def window_digest() -> Column:
    """One number for the content of a window row, the same whatever the order of summation."""
    values = [
        F.unix_micros("window_start"), F.unix_micros("window_end"),
        F.round(F.col("total_revenue") * 100).cast("bigint"), F.col("order_count"), F.col("top_sku"),
    ]
    # Hashing skips nulls, so they are told apart from the values beside them.
    return F.xxhash64(*values, *(value.isNull() for value in values))


def day_digests(metrics: DataFrame, day: str = "window_date") -> DataFrame:
    """(day, windows, digest): a sum over the day's windows, so their order does not matter."""
    return metrics.groupBy(day).agg(
        F.count("*").alias("windows"),
        F.sum(window_digest().cast("decimal(38,0)")).alias("digest"))


def differing_days(stored: DataFrame, actual: DataFrame, day: str = "window_date") -> DataFrame:
    """Days whose digests differ, or that only one side has."""
    left = stored.select(day, F.struct("windows", "digest").alias("stored"))
    right = actual.select(day, F.struct("windows", "digest").alias("actual"))
    return left.join(right, day, "full").filter(
        ~F.col("stored").eqNullSafe(F.col("actual"))).select(day)
