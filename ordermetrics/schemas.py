"""Declared schemas and keys of every relation; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the message format and of the tables.
TOPIC = "orders"
CUSTOMER_PREFIX = "CUST-"
BROKEN_MARK = "BROKEN_JSON"
HOURLY_ORDER_COUNT = "hourly_order_count"
WINDOW_WIDTH = "1 minute"
WATERMARK = "30 seconds"
TRIGGER = "30 seconds"
Z = 2.0

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])
ORDER_FIELDS = ORDER_SCHEMA.fieldNames()

WINDOW_KEYS = ["window_start", "window_end"]

LIVE_METRICS = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("top_sku", T.StringType()),
])

WINDOW_SKU = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("sku", T.StringType()),
    T.StructField("sku_total_revenue", T.DoubleType()),
    T.StructField("sku_order_count", T.LongType()),
])

DAILY_SUMMARY = T.StructType([
    T.StructField("summary_date", T.DateType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("avg_order_value", T.DoubleType()),
])
DAILY_KEYS = ["summary_date"]

ANOMALIES = T.StructType([
    T.StructField("detected_date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("expected_low", T.DoubleType()),
    T.StructField("expected_high", T.DoubleType()),
    T.StructField("flagged_at", T.TimestampType()),
])
ANOMALY_KEYS = ["detected_date", "metric", "hour"]
