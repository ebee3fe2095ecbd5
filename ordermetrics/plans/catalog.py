"""Every registered query: (spark, sf_dir) -> DataFrame.

Doubles are rounded in the output only, so that results compare with SQL whatever the
order of summation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermetrics import operators as op
from ordermetrics.functions.order_json import order_json
from ordermetrics.plans import repair
from ordermetrics.plans.reconciliation import anomaly_scope
from ordermetrics.schemas import ORDER_SCHEMA
from ordermetrics.session import fresh_dir
from ordermetrics.sinks.files import delete, merge_table, read_table
from ordermetrics.sources.feed import (
    damaged_feed, event_order, events, events_stream, lineitem_orders, order_feed,
)
from ordermetrics.sources.orders import decode_payload, read_orders
from ordermetrics.streaming import (
    read_dead_letters, read_order_log, run_live_metrics, start_daily_summary, start_dead_letters,
    start_metrics_of_orders, start_order_log,
)

Query = Callable[[SparkSession, str], DataFrame]

REPORT_DAY = "2024-01-15"
METRICS = ["window_start", "window_end", "total_revenue", "order_count", "top_sku"]


def _money(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_orders(order_feed(events(spark, sf_dir)))


def _orders(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    return op.valid_orders(op.parse_orders(order_feed(events(spark, sf_dir, day))))


# --- parse -------------------------------------------------------------------------

def payload_decode(spark, sf_dir):
    messages = events(spark, sf_dir).select("event_id", F.encode("props", "UTF-8").alias("value"))
    return decode_payload(messages).withColumn("n_chars", F.length("json_str"))


def json_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "event_id", "order_id", "sku", "quantity", "price", "timestamp")


def valid_orders(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", "sku", "quantity", "price")


def dead_letters(spark, sf_dir):
    return op.dead_letters(_parsed(spark, sf_dir)).select("event_id")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_orders(damaged_feed(events(spark, sf_dir)))


def dead_letter_reasons(spark, sf_dir):
    return op.dead_letter_reasons(_damaged(spark, sf_dir)).select("event_id", "reason")


def dead_letter_reasons_strict(spark, sf_dir):
    letters = op.dead_letter_reasons(_damaged(spark, sf_dir), strict=True)
    return letters.select("event_id", "reason")


def message_counts(spark, sf_dir):
    """What one pass over the damaged feed has seen, counted while it ran."""
    seen = Observation("messages")
    days = op.daily_summary(op.window_totals(op.valid_orders(
        op.counted(_damaged(spark, sf_dir), seen))))
    summed = days.agg(F.sum("total_orders")).first()[0]
    return spark.createDataFrame(
        [(seen.get["read"], seen.get["valid"], seen.get["dead"], seen.get["timeless"], summed)],
        "n_read bigint, n_valid bigint, n_dead bigint, n_timeless bigint, n_in_windows bigint")


def order_json_encode(spark, sf_dir):
    text = events(spark, sf_dir).select("event_id", order_json(event_order()).alias("value"))
    order = F.from_json("value", ORDER_SCHEMA)
    return text.select("event_id", F.inline(F.array(order))).select(
        "event_id", "customer_id", "price")


def event_time(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", "event_time")


def revenue_projection(spark, sf_dir):
    return _money(_orders(spark, sf_dir).select("order_id", "revenue"), "revenue")


# --- windows -----------------------------------------------------------------------

def tumbling_window(spark, sf_dir):
    return _money(op.window_totals(_orders(spark, sf_dir)), "total_revenue")


def window_sku_list(spark, sf_dir):
    pairs = F.aggregate(
        "sku_revenues", F.lit(0.0), lambda total, pair: total + F.coalesce(pair["revenue"], F.lit(0.0)))
    lists = op.sku_revenue_lists(_orders(spark, sf_dir))
    return _money(
        lists.groupBy("window_start").agg(
            F.sum(F.size("sku_revenues")).alias("n_pairs"), F.sum(pairs).alias("pair_revenue")),
        "pair_revenue")


def sku_explode(spark, sf_dir):
    pairs = op.explode_sku_lists(op.sku_revenue_lists(_orders(spark, sf_dir)))
    return _money(pairs.select("window_start", "sku", "revenue"), "revenue")


def window_sku_revenue(spark, sf_dir):
    totals = op.window_sku_totals(_orders(spark, sf_dir))
    return _money(totals.select("window_start", "sku", "sku_total_revenue"), "sku_total_revenue")


def sku_rank(spark, sf_dir):
    ranked = op.rank_skus(op.window_sku_totals(_orders(spark, sf_dir)))
    return ranked.select("window_start", "sku", F.col("rank").cast("int").alias("rank"))


def top_sku(spark, sf_dir):
    return op.top_sku(op.window_sku_totals(_orders(spark, sf_dir)))


def live_metrics(spark, sf_dir):
    return _money(op.live_metrics(_orders(spark, sf_dir)), "total_revenue")


def live_metrics_exact(spark, sf_dir):
    """Window rows from decimal sums: nothing is rounded, and no order of summation shows."""
    return op.live_metrics(op.exact_revenue(_orders(spark, sf_dir)))


def sku_rank_exact(spark, sf_dir):
    totals = op.window_sku_totals(op.exact_revenue(_orders(spark, sf_dir)))
    return op.rank_skus(totals).select(
        "window_start", "sku", "sku_total_revenue", F.col("rank").cast("int").alias("rank"))


def live_metrics_joined(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    joined = op.attach_top_sku(op.window_totals(orders), op.top_sku(op.window_sku_totals(orders)))
    return _money(joined, "total_revenue")


def latest_windows(spark, sf_dir):
    return op.latest_windows(live_metrics(spark, sf_dir), 5)


def part_daily_top(spark, sf_dir):
    days = op.live_metrics(lineitem_orders(spark, sf_dir), "1 day")
    return _money(days, "total_revenue").select(
        F.to_date("window_start").alias("ship_day"),
        F.col("total_revenue").alias("revenue"),
        F.col("order_count").alias("n_lines"),
        F.col("top_sku").alias("top_part"),
    )


# --- days and hours ----------------------------------------------------------------
# Daily operators read window totals only, so the SKU level is left out of these plans.

def _totals(spark, sf_dir, day=None):
    return op.window_totals(_orders(spark, sf_dir, day))


def _hourly(spark, sf_dir):
    return op.hourly_totals(_totals(spark, sf_dir))


def day_filter(spark, sf_dir):
    windows = op.live_metrics(_orders(spark, sf_dir, REPORT_DAY))
    return _money(op.day_filter(windows, REPORT_DAY), "total_revenue")


def daily_summary(spark, sf_dir):
    rows = op.day_filter(_totals(spark, sf_dir, REPORT_DAY), REPORT_DAY)
    return _money(op.daily_summary(rows), "total_revenue", "avg_order_value")


def daily_summary_all(spark, sf_dir):
    return _money(op.daily_summary(_totals(spark, sf_dir)), "total_revenue", "avg_order_value")


def hourly_orders(spark, sf_dir):
    return _hourly(spark, sf_dir).select("d", "hour", "hourly_orders")


def hourly_stats(spark, sf_dir):
    stats = op.value_stats(_hourly(spark, sf_dir), "d", "hourly_orders")
    return _money(stats, "mean", "stddev", digits=6)


def anomaly_bounds(spark, sf_dir):
    stats = op.value_stats(_hourly(spark, sf_dir), "d", "hourly_orders")
    bounds = op.expected_range(stats).select("d", "expected_low", "expected_high")
    return _money(bounds, "expected_low", "expected_high", digits=6)


def hourly_anomalies(spark, sf_dir):
    return _money(
        op.hourly_anomalies(_hourly(spark, sf_dir)), "expected_low", "expected_high", digits=6)


def hourly_revenue_anomalies(spark, sf_dir):
    flagged = op.hourly_anomalies(_hourly(spark, sf_dir), "hourly_revenue")
    return _money(flagged, "value", "expected_low", "expected_high")


def anomaly_count(spark, sf_dir):
    return op.anomaly_counts(_hourly(spark, sf_dir)).select("d", "flagged")


def daily_report(spark, sf_dir):
    return op.daily_report(_totals(spark, sf_dir))


# --- keyed tables ------------------------------------------------------------------

def _early_and_late(spark, sf_dir):
    """All orders, and those known at first: purchases come later."""
    orders = _orders(spark, sf_dir)
    return orders, orders.filter(F.col("sku") != "purchase")


def merge_live_metrics(spark, sf_dir):
    """Windows of the orders known at first; those that later purchases change are merged."""
    orders, early = _early_and_late(spark, sf_dir)
    root = fresh_dir(spark, "merge_live_metrics")
    merge_table(spark, root, "live_metrics", op.live_metrics(early))
    changed = F.bool_or(F.col("sku").eqNullSafe("purchase")).alias("changed")
    updates = op.roll_up(op.window_sku_totals(orders), changed).filter("changed").drop("changed")
    merge_table(spark, root, "live_metrics", updates)
    return _money(read_table(spark, root, "live_metrics").select(*METRICS), "total_revenue")


def merge_daily_summary(spark, sf_dir):
    orders, early = _early_and_late(spark, sf_dir)
    root = fresh_dir(spark, "merge_daily_summary")
    merge_table(spark, root, "daily_summary", op.daily_summary(op.window_totals(early)))
    updates = op.daily_summary(op.window_totals(orders)).filter(
        F.col("summary_date") >= F.lit(REPORT_DAY).cast("date"))
    merge_table(spark, root, "daily_summary", updates)
    stored = read_table(spark, root, "daily_summary").drop("summary_year")
    return _money(stored, "total_revenue", "avg_order_value")


def merge_anomalies(spark, sf_dir):
    """Odd hours of the orders known at first, then of all; flags that no longer hold go."""
    orders, early = _early_and_late(spark, sf_dir)
    root = fresh_dir(spark, "merge_anomalies")
    for known in (early, orders):
        hours = op.hourly_totals(op.window_totals(known)).persist()
        try:
            flagged = op.hourly_anomalies(hours).withColumn("flagged_at", F.current_timestamp())
            merge_table(spark, root, "anomalies", flagged, anomaly_scope(hours))
        finally:
            hours.unpersist()
    stored = read_table(spark, root, "anomalies").drop("detected_year", "flagged_at")
    return _money(stored, "expected_low", "expected_high", digits=6)


def reconcile_drift(spark, sf_dir):
    """A stored table that lost one SKU's orders and has another's a minute late."""
    orders = _orders(spark, sf_dir)
    late = F.when(F.col("sku") == "signup", F.expr("INTERVAL 1 MINUTE")).otherwise(
        F.expr("INTERVAL 0 MINUTE"))
    seen = orders.filter(F.col("sku") != "purchase").withColumn(
        "event_time", F.col("event_time") + late)
    return _money(
        op.drift_report(op.live_metrics(seen), op.live_metrics(orders)),
        "stored_revenue", "actual_revenue")


def repair_live_metrics(spark, sf_dir):
    """A table that lost one SKU's orders on odd days and has another's a minute late, repaired."""
    orders = _orders(spark, sf_dir)
    odd = F.dayofmonth("event_time") % 2 == 1
    late = F.when(odd & (F.col("sku") == "signup"), F.expr("INTERVAL 1 MINUTE")).otherwise(
        F.expr("INTERVAL 0 MINUTE"))
    seen = orders.filter(~(odd & (F.col("sku") == "purchase"))).withColumn(
        "event_time", F.col("event_time") + late)
    root = fresh_dir(spark, "repair_live_metrics")
    merge_table(spark, root, "live_metrics", op.live_metrics(seen))
    repair.repair_live_metrics(spark, root, orders)
    return _money(read_table(spark, root, "live_metrics").select(*METRICS), "total_revenue")


# --- streams -----------------------------------------------------------------------

def _stream_metrics(spark, sf_dir, base=None):
    # Run as the job runs it, with the closing batch; only the checkpoint is not kept.
    base = base or fresh_dir(spark, "stream_live_metrics")
    table = run_live_metrics(order_feed(events_stream(spark, sf_dir)), f"{base}/tables",
                             f"{base}/checkpoint", slot="day")
    delete(spark, f"{base}/checkpoint")
    return table


def stream_live_metrics(spark, sf_dir):
    return _money(_stream_metrics(spark, sf_dir).select(*METRICS), "total_revenue")


def stream_dedup(spark, sf_dir):
    """Weeks of orders, one a batch; the last half day of each comes again with the next.

    The repeats are within the watermark, so only the kept ids tell them apart.
    """
    base = fresh_dir(spark, "stream_dedup")
    rows = events(spark, sf_dir)
    day = F.dayofmonth("ts")
    for number, start in enumerate(range(1, 32, 7)):
        again = (day == start - 1) & (F.hour("ts") >= 12)
        week = rows.filter(day.between(start, start + 6) | again)
        order_feed(week).select("json_str").coalesce(1).write.mode("append").text(f"{base}/feed")
    messages = read_orders(spark, "text", f"{base}/feed", maxFilesPerTrigger=1)
    table = run_live_metrics(messages, f"{base}/tables", f"{base}/checkpoint", slot="day",
                             watermark="1 day", dedup=True)
    delete(spark, f"{base}/checkpoint")
    return _money(table.select(*METRICS), "total_revenue")


def stream_daily_summary(spark, sf_dir):
    """The daily table follows the window table: a first merge, then those of a stream."""
    _, early = _early_and_late(spark, sf_dir)
    base = fresh_dir(spark, "stream_daily_summary")

    def follow():
        start_daily_summary(
            spark, f"{base}/tables", f"{base}/following", {"availableNow": True}).awaitTermination()

    merge_table(spark, f"{base}/tables", "live_metrics", op.live_metrics(early))
    follow()
    _stream_metrics(spark, sf_dir, base=base)
    follow()
    delete(spark, f"{base}/following")
    stored = read_table(spark, f"{base}/tables", "daily_summary").drop("summary_year")
    return _money(stored, "total_revenue", "avg_order_value")


def stream_order_log(spark, sf_dir):
    """The feed goes into a log once; metrics follow the log, dead letters stay in it."""
    base = fresh_dir(spark, "stream_order_log")
    now = {"availableNow": True}
    start_order_log(damaged_feed(events_stream(spark, sf_dir)), f"{base}/log",
                    f"{base}/log_checkpoint", now).awaitTermination()
    start_metrics_of_orders(
        read_order_log(spark, f"{base}/log"), f"{base}/tables", f"{base}/checkpoint",
        trigger=now, slot="day").awaitTermination()
    days = op.daily_summary(read_table(spark, f"{base}/tables", "live_metrics"))
    letters = read_dead_letters(spark, f"{base}/log").groupBy("reason").agg(F.count("*").alias("n"))
    delete(spark, f"{base}/log_checkpoint")
    delete(spark, f"{base}/checkpoint")
    return days.select(F.col("summary_date").cast("string").alias("of"), F.col("total_orders").alias("n")).union(
        letters.select("reason", "n"))


def stream_dead_letters(spark, sf_dir):
    base = fresh_dir(spark, "stream_dead_letters")
    query = start_dead_letters(
        order_feed(events_stream(spark, sf_dir)), f"{base}/letters", f"{base}/checkpoint",
        trigger={"availableNow": True})
    query.awaitTermination()
    delete(spark, f"{base}/checkpoint")
    return spark.read.schema("event_id bigint").parquet(f"{base}/letters")


def query_catalog() -> dict[str, Query]:
    return {query.__name__: query for query in (
        payload_decode, json_parse, valid_orders, dead_letters, dead_letter_reasons,
        dead_letter_reasons_strict, message_counts,
        order_json_encode, event_time, revenue_projection,
        tumbling_window, window_sku_list, sku_explode, window_sku_revenue, sku_rank, top_sku,
        live_metrics, live_metrics_joined, latest_windows, part_daily_top,
        live_metrics_exact, sku_rank_exact,
        day_filter, daily_summary, daily_summary_all, hourly_orders, hourly_stats,
        anomaly_bounds, hourly_anomalies, hourly_revenue_anomalies, anomaly_count, daily_report,
        merge_live_metrics, merge_daily_summary, merge_anomalies, reconcile_drift,
        repair_live_metrics,
        stream_live_metrics, stream_dedup, stream_daily_summary, stream_dead_letters,
        stream_order_log,
    )}


flagship = live_metrics
