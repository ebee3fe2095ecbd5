"""Repair of stored window metrics from an archive of the orders.

The archive is the truth: it also holds orders the stream dropped as late. It is read and
rolled up once; the window rows, a thousandth of it or less, are kept in the shared folder.
Digests of both sides, one row a day, tell which days differ, and only those are read again
and swapped, all in one step. Other days keep their files.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermetrics.functions.times import day_bounds
from ordermetrics.operators.drift import day_digests, differing_days
from ordermetrics.operators.windows import live_metrics
from ordermetrics.schemas import WINDOW_WIDTH
from ordermetrics.session import fresh_dir, pin_utc
from ordermetrics.sinks.files import TABLES, delete, merge_table, read_table


def _between(orders: DataFrame, first: date | str | None, last: date | str | None) -> DataFrame:
    if first is not None:
        orders = orders.filter(F.col("event_time") >= day_bounds(first)[0])
    if last is not None:
        orders = orders.filter(F.col("event_time") < day_bounds(last)[1])
    return orders


def repair_live_metrics(
    spark: SparkSession, root: str, orders: DataFrame, first: date | str | None = None,
    last: date | str | None = None, width: str = WINDOW_WIDTH,
) -> list[date]:
    """Make the days ``first`` to ``last`` of the stored table equal to their orders.

    Returns the days that were replaced. Without bounds the days are those between the first
    and the last of the archive, so what is stored of other times stays. Within the bounds
    windows without orders go. The days have to be closed: what a stream merges into them
    meanwhile is not in the archive yet and would be withdrawn.
    """
    table, kept = TABLES["live_metrics"], fresh_dir(pin_utc(spark), "repair")
    try:
        live_metrics(_between(orders, first, last), width).select(
            *table.schema.fieldNames()).withColumn(table.partition, table.partition_value).write.parquet(kept)
        actual = spark.read.schema(table.full_schema).parquet(kept)
        stored = read_table(spark, root, "live_metrics")
        day = F.col(table.partition)
        low, high = actual.agg(F.min(day), F.max(day)).first()
        low = date.fromisoformat(str(first)) if first is not None else low
        high = date.fromisoformat(str(last)) if last is not None else high
        if low is None or high is None:
            return []
        stored = stored.filter(day.between(F.lit(low), F.lit(high)))
        days = [row[0] for row in differing_days(
            day_digests(stored, table.partition), day_digests(actual, table.partition),
            table.partition).orderBy(table.partition).collect()]  # one value a damaged day
        if days:
            scope = spark.createDataFrame([(d,) for d in days], f"{table.partition} date")
            updates = actual.filter(day.isin(days)).drop(table.partition)
            merge_table(spark, root, "live_metrics", updates, scope)
        return days
    finally:
        delete(spark, kept)
