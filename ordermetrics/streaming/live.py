"""Live window metrics: orders in, keyed table out.

One stateful aggregate keyed by (window, sku) runs in update mode, so state grows with
the SKUs of open windows and not with their orders. Update mode emits only the keys
that changed; a window's total and best SKU need all of its SKUs. Each micro-batch
therefore stores its changes, reads back every SKU of the windows it touched, and
merges their new rows into ``live_metrics``. All stored values are cumulative, so a
replayed batch writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ordermetrics.operators.parse import counted, parse_orders, valid_orders
from ordermetrics.operators.windows import roll_up, window_sku_totals
from ordermetrics.schemas import TRIGGER, WATERMARK, WINDOW_WIDTH
from ordermetrics.session import ROCKSDB_STATE, pin_utc, settings
from ordermetrics.sinks.files import exists, merge_table, read_table
from ordermetrics.streaming.changes import (
    current_totals, fold_slot, read_changes, touched_windows, write_changes,
)

CHANGES = "window_sku_changes"

# Receives the new rows of the touched windows and the batch id; must be repeatable.
Sink = Callable[[DataFrame, int], None]


def _apply_batch(
    spark: SparkSession, target: str, slot: str, sink: Sink, batch: DataFrame, batch_id: int
) -> None:
    path = f"{target}/{CHANGES}"
    touched = write_changes(batch, batch_id, path, slot)
    if not touched.keys:
        return
    # From here on plain batch work over the stored files, in the caller's session and
    # so with adaptive execution; the streaming state is not evaluated again.
    in_touched = touched_windows(spark, path, touched, batch_id)
    sink(roll_up(current_totals(in_touched)), batch_id)
    # Batches before this one are committed and will not run again.
    for slot_name in touched.slot_names() or []:
        fold_slot(spark, path, slot_name, batch_id - 1)


def start_live_metrics(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    width: str = WINDOW_WIDTH,
    watermark: str = WATERMARK,
    trigger: dict | None = None,
    strict: bool = False,
    slot: str = "hour",
    sink: Sink | None = None,
    column: str = "json_str",
    dedup: bool = False,
) -> StreamingQuery:
    """Start the stream from JSON messages to the tables below ``target``.

    ``checkpoint`` belongs to ``target``: batch ids order the stored changes, so a new
    checkpoint needs a new target. The trigger defaults to every 30 seconds. ``slot``
    (``hour`` or ``day``) is how finely stored changes are divided. ``sink`` replaces
    the table ``live_metrics`` below ``target`` as the place window rows are merged into.

    ``dedup`` counts an order id once: a repeat is dropped while the id is remembered,
    which is until the watermark passes its first event time plus the delay. The state
    then also holds the ids of that span. Like the width it is fixed at the first start.
    """
    pin_utc(messages.sparkSession)
    orders = valid_orders(counted(parse_orders(messages, column), "orders", strict), strict)
    return start_metrics_of_orders(
        orders, target, checkpoint, width, watermark, trigger, slot, sink, dedup)


def start_metrics_of_orders(
    orders: DataFrame, target: str, checkpoint: str, width: str = WINDOW_WIDTH,
    watermark: str = WATERMARK, trigger: dict | None = None, slot: str = "hour",
    sink: Sink | None = None, dedup: bool = False,
) -> StreamingQuery:
    """:func:`start_live_metrics` from orders with time and revenue, as the event log has them."""
    spark = pin_utc(orders.sparkSession)
    if exists(spark, f"{target}/{CHANGES}") and not exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{target} holds changes of another checkpoint than {checkpoint}")
    if sink is None:
        def sink(rows, batch_id):
            merge_table(spark, target, "live_metrics", rows)
    orders = orders.withWatermark("event_time", watermark)
    if dedup:
        orders = orders.dropDuplicatesWithinWatermark(["order_id"])
    totals = window_sku_totals(orders, width)
    writer = (
        totals.writeStream.queryName(f"live_metrics:{target}")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .foreachBatch(lambda batch, batch_id: _apply_batch(spark, target, slot, sink, batch, batch_id))
    )
    with settings(spark, ROCKSDB_STATE):
        return writer.start()


def run_live_metrics(messages: DataFrame, target: str, checkpoint: str, **options) -> DataFrame:
    """Take in everything that is available now and return the resulting table."""
    spark = messages.sparkSession
    query = start_live_metrics(
        messages, target, checkpoint, trigger={"availableNow": True}, **options
    )
    query.awaitTermination()
    return read_table(spark, target, "live_metrics")


def window_sku_table(spark: SparkSession, target: str) -> DataFrame:
    """Current (window, sku) totals."""
    return current_totals(read_changes(spark, f"{target}/{CHANGES}"))
