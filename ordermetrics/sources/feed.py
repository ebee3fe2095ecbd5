"""Order feeds derived from the generated tables (definition: FIXTURES.md)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermetrics.functions.order_json import broken_order_json, order_json, order_struct
from ordermetrics.functions.times import day_bounds
from ordermetrics.session import pin_utc

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all cores, where their files are read by fewer tasks than there are cores.

    A file of one row group is one task, and making and parsing JSON costs far more than
    reading. Tables with splits enough are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = rows._jdf.queryExecution().toRdd().getNumPartitions()  # plans the scan, runs nothing
    return rows if tasks >= cores else rows.repartition(cores)


def events(spark: SparkSession, sf_dir: str, day: date | str | None = None) -> DataFrame:
    """The events table; ``day`` limits the scan itself to one day."""
    rows = pin_utc(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    if day is not None:
        start, end = (bound.cast("timestamp_ntz") for bound in day_bounds(day))
        rows = rows.filter((F.col("ts") >= start) & (F.col("ts") < end))
    return spread(rows)


def events_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The same table as a file stream, whether it is one file or a folder of files."""
    reader = pin_utc(spark).readStream.schema(EVENTS).options(**options)
    return reader.parquet(f"{sf_dir}/events.parquet*")


def event_order():
    """Order record of an event."""
    quantity = F.get_json_object("props", "$.k").cast("int") % 5 + 1
    return order_struct(
        F.col("event_id"), F.col("user_id"), F.col("event_type"), quantity,
        F.col("value"), F.unix_millis(F.col("ts").cast("timestamp")),
    )


def order_feed(rows: DataFrame) -> DataFrame:
    """Events as order messages; every fiftieth one is broken on the way."""
    text = order_json(event_order())
    message = F.when(F.col("event_id") % 50 == 0, broken_order_json(text)).otherwise(text)
    return rows.select("event_id", message.alias("json_str"))


# What befalls every fiftieth message of the damaged feed, in turn.
DAMAGES = ["null", "blank", "cut", "number", "list", "order_id", "sku", "quantity", "price",
           "timestamp", "far"]


def damaged_feed(rows: DataFrame) -> DataFrame:
    """Events as order messages; every fiftieth one is damaged, in as many ways as there are
    reasons to refuse a message. A field's name stands for an order without that field."""
    order = event_order()
    text = order_json(order)
    damaged = {
        "null": F.lit(None).cast("string"), "blank": F.lit("  "), "cut": broken_order_json(text),
        "number": F.lit("17"), "list": F.concat(F.lit("["), text, F.lit("]")),
        "far": order_json(order.withField("timestamp", F.lit(10**17))),
    }
    for field in ("order_id", "sku", "quantity", "price", "timestamp"):
        damaged[field] = order_json(order.dropFields(field))
    turn = F.floor(F.col("event_id") / 50) % len(DAMAGES)
    message = F.when(F.col("event_id") % 50 != 0, text)
    for number, name in enumerate(DAMAGES):
        message = message.when(turn == number, damaged[name])
    return rows.select("event_id", message.alias("json_str"))


def lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments as orders: the part is the SKU, the ship date the event time."""
    lines = pin_utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(
        F.col("l_partkey").alias("sku"),
        F.col("l_extendedprice").alias("revenue"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )
