"""Event-time window metrics.

Input: orders with ``sku``, ``revenue`` (a double, or a decimal for exact sums) and
``event_time``. Every aggregate combines
on the map side, so a window or SKU that holds a large share of all orders costs its
reducer one row per map task and nothing more. Frames keyed by (window, sku) already
hold one row per SKU and are what the second level works on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermetrics.schemas import WINDOW_KEYS, WINDOW_WIDTH
from ordermetrics.session import shared_dir


def _window_bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def _ranked_total() -> Column:
    """Total used for ranking, without the last bits that a sum of doubles owes to its order.

    A decimal of up to six places is itself.
    """
    return F.round("sku_total_revenue", 6)


def window_totals(orders: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Revenue and order count per tumbling window; a window of null revenues totals 0."""
    return (
        orders.groupBy(F.window("event_time", width))
        .agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
            F.count("*").alias("order_count"),
        )
        .select(*_window_bounds(), "total_revenue", "order_count")
    )


def window_sku_totals(orders: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Revenue and order count per (window, sku). As a stream, this is the only state kept."""
    return (
        orders.groupBy(F.window("event_time", width), "sku")
        .agg(
            F.sum("revenue").alias("sku_total_revenue"),
            F.count("*").alias("sku_order_count"),
        )
        .select(*_window_bounds(), "sku", "sku_total_revenue", "sku_order_count")
    )


def _best_sku() -> Column:
    """SKU with the highest total, null totals last, then the lowest SKU, null SKU last.

    A minimum over an ordered struct instead of a ranked window: each task sends one
    candidate per window to the shuffle and no task has to sort all SKUs of a window.
    """
    total = _ranked_total()
    first = F.min(F.struct(
        total.isNull().alias("no_total"),
        (~F.isnan(total)).alias("is_number"),
        (-total).alias("descending"),
        F.col("sku").isNull().alias("no_sku"),
        F.col("sku").alias("sku"),
    ))
    return first["sku"]


def top_sku(sku_totals: DataFrame) -> DataFrame:
    """The best SKU of every window."""
    return sku_totals.groupBy(*WINDOW_KEYS).agg(_best_sku().alias("top_sku"))


def roll_up(sku_totals: DataFrame, *more: Column) -> DataFrame:
    """(window, sku) totals to window rows with total, count and best SKU, without a join.

    ``more`` are aggregates over a window's SKUs that come along.
    """
    return sku_totals.groupBy(*WINDOW_KEYS).agg(
        F.coalesce(F.sum("sku_total_revenue"), F.lit(0)).alias("total_revenue"),
        F.sum("sku_order_count").alias("order_count"),
        _best_sku().alias("top_sku"),
        *more,
    )


def live_metrics(orders: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Window rows straight from orders, as a batch."""
    return roll_up(window_sku_totals(orders, width))


def attach_top_sku(totals: DataFrame, top: DataFrame) -> DataFrame:
    """Left join form of the roll-up, for totals that come without their SKU rows."""
    return totals.drop("top_sku").join(top, WINDOW_KEYS, "left")


def _best_first() -> list[Column]:
    return [_ranked_total().desc_nulls_last(), F.col("sku").asc_nulls_last()]


def rank_slices(sku_totals: DataFrame) -> DataFrame:
    """Range-partition the rows by window and rank order; ``slice`` numbers the ranges."""
    shared_dir(sku_totals.sparkSession)
    return (
        sku_totals.repartitionByRange(*[F.col(k).asc() for k in WINDOW_KEYS], *_best_first())
        .withColumn("slice", F.spark_partition_id())
        .checkpoint()
    )


def rank_skus(sku_totals: DataFrame) -> DataFrame:
    """Number the SKUs of each window from 1, best first, in the order of :func:`top_sku`.

    A plain ``row_number`` would sort a whole window in one task. Here a large window
    spans many slices, and a row's rank is its position in its slice plus the rows its
    window has in earlier slices. The slices are checkpointed because both uses have to
    see the same bounds.
    """
    placed = rank_slices(sku_totals)
    sizes = placed.groupBy(*WINDOW_KEYS, "slice").agg(F.count("*").alias("rows"))
    earlier = (
        Window.partitionBy(*WINDOW_KEYS).orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *WINDOW_KEYS, "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    in_slice = Window.partitionBy(*WINDOW_KEYS, "slice").orderBy(*_best_first())
    return (
        placed.withColumn("position", F.row_number().over(in_slice))
        .join(offsets, [*WINDOW_KEYS, "slice"])
        .withColumn("rank", F.col("before") + F.col("position"))
        .drop("slice", "position", "before")
    )


def sku_revenue_lists(
    orders: DataFrame, width: str = WINDOW_WIDTH, block_bits: int = 16
) -> DataFrame:
    """(sku, revenue) pairs of each window as lists of at most ``2 ** block_bits`` pairs.

    The pairs of a window are spread over as many rows as needed, numbered by ``block``.
    A block is a run of rows of one input partition, so lists are complete before the
    shuffle and no list grows with the window.
    """
    block = F.shiftright(F.monotonically_increasing_id(), block_bits)
    return (
        orders.withColumn("block", block)
        .groupBy(F.window("event_time", width), "block")
        .agg(F.collect_list(F.struct("sku", "revenue")).alias("sku_revenues"))
        .select(*_window_bounds(), "block", "sku_revenues")
    )


def explode_sku_lists(lists: DataFrame) -> DataFrame:
    """One row per (sku, revenue) pair."""
    return lists.select(*WINDOW_KEYS, F.explode("sku_revenues").alias("pair")).select(
        *WINDOW_KEYS, F.col("pair.sku").alias("sku"), F.col("pair.revenue").alias("revenue")
    )


def latest_windows(metrics: DataFrame, n: int = 5) -> DataFrame:
    """The newest windows, newest first."""
    return metrics.orderBy(F.col("window_start").desc_nulls_last()).limit(n)
