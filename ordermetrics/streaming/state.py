"""The keyed state of a live stream against the totals it has stored.

Both are written by the same batches, so they agree unless a checkpoint was put back, or the
stored changes were, by hand. The state of a checkpoint is read with Spark's own source for
it; nothing runs and nothing is changed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermetrics.schemas import WINDOW_SKU
from ordermetrics.session import pin_utc
from ordermetrics.sinks.files import file_names, text_of
from ordermetrics.streaming.changes import SKU_KEYS
from ordermetrics.streaming.live import window_sku_table


def state_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(window, sku) totals as the checkpoint's last committed batch left them: open windows only."""
    operators = pin_utc(spark).read.format("state-metadata").load(checkpoint)
    sums = [row.operatorId for row in operators.filter("operatorName = 'stateStoreSave'").collect()]
    if not sums:
        return spark.createDataFrame([], WINDOW_SKU)
    rows = spark.read.format("statestore").option("operatorId", sums[0]).load(checkpoint)
    key, value = rows.schema["key"].dataType.names, rows.schema["value"].dataType.names
    return rows.select(
        F.col("key")[key[0]]["start"].alias("window_start"),
        F.col("key")[key[0]]["end"].alias("window_end"),
        F.col("key")[key[1]].alias("sku"),
        F.col("value")[value[0]].alias("sku_total_revenue"),
        F.col("value")[value[1]].alias("sku_order_count"),
    )


def watermark_of(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds of the watermark the last planned batch started with; 0 before any."""
    batches = [int(n) for n in file_names(spark, f"{checkpoint}/offsets") if n.isdigit()]
    if not batches:
        return 0
    lines = text_of(spark, f"{checkpoint}/offsets/{max(batches)}").split("\n")
    return int(json.loads(lines[1])["batchWatermarkMs"])


def state_drift(
    spark: SparkSession, target: str, checkpoint: str, cents: float = 0.005
) -> DataFrame:
    """Keys of open windows whose stored totals differ from the checkpoint's state.

    ``missing``: in the state, not stored. ``ahead``: stored, not in the state, though the
    window is open by the checkpoint's watermark. ``different``: both, with other totals.
    Windows that the watermark has closed have no state and are not compared.
    """
    values = ["sku_total_revenue", "sku_order_count"]
    state = state_totals(spark, checkpoint).select(*SKU_KEYS, F.struct(*values).alias("state"))
    stored = window_sku_table(spark, target).select(*SKU_KEYS, F.struct(*values).alias("stored"))
    b = stored.select(*[F.col(k).alias(f"_{k}") for k in SKU_KEYS], "stored")
    same_key = F.lit(True)
    for k in SKU_KEYS:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = state.join(b, same_key, "full").select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in SKU_KEYS], "state", "stored")
    was, now = F.col("stored.sku_total_revenue"), F.col("state.sku_total_revenue")
    same = (was.eqNullSafe(now) | (F.abs(was - now) < cents)) & (
        F.col("stored.sku_order_count") == F.col("state.sku_order_count"))
    open_window = F.unix_millis("window_end") > watermark_of(spark, checkpoint)
    status = (
        F.when(F.col("stored").isNull(), "missing")
        .when(F.col("state").isNull(), F.when(open_window, "ahead"))
        .when(~F.coalesce(same, F.lit(False)), "different")
    )
    return joined.withColumn("status", status).filter("status IS NOT NULL").select(
        *SKU_KEYS, "status",
        now.alias("state_revenue"), was.alias("stored_revenue"),
        F.col("state.sku_order_count").alias("state_count"),
        F.col("stored.sku_order_count").alias("stored_count"))
