"""Order messages as a log of parsed rows: the source is read and parsed once for all uses.

One query takes the messages, parses them, and appends valid orders and dead letters to one
folder, partitioned by kind. The file sink commits both with a batch, so no message is lost
between the two or written twice when a query dies and starts again. Metrics and dead letters
read the log, each at its own pace; a new use reads it from the start, without the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ordermetrics.operators.parse import (
    counted, is_valid, letter_reason, order_fields, parse_orders,
)
from ordermetrics.schemas import ORDER_SCHEMA, TRIGGER
from ordermetrics.session import pin_utc

VALID, DEAD = "valid", "dead"
LOG_SCHEMA = T.StructType([
    *ORDER_SCHEMA.fields,
    T.StructField("payload", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("kind", T.StringType()),
])


def log_rows(messages: DataFrame, strict: bool = False, column: str = "json_str") -> DataFrame:
    """One row a message: a valid order's fields, or a dead letter's text and reason as well."""
    parsed = counted(parse_orders(messages, column), "orders", strict)
    dead = ~is_valid(strict)
    return parsed.select(
        *ORDER_SCHEMA.fieldNames(),
        F.when(dead, F.col(column)).alias("payload"),
        F.when(dead, letter_reason(column)).alias("reason"),
        F.when(dead, DEAD).otherwise(VALID).alias("kind"),
    )


def start_order_log(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    strict: bool = False, column: str = "json_str",
) -> StreamingQuery:
    """Append messages to the log at ``path``; ``strict`` is fixed with its first row."""
    pin_utc(messages.sparkSession)
    return (
        log_rows(messages, strict, column).writeStream.queryName(f"order_log:{path}")
        .format("parquet").outputMode("append").partitionBy("kind")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start(path)
    )


def read_order_log(spark: SparkSession, path: str, streaming: bool = True, **options) -> DataFrame:
    """The valid orders of a log, with time and revenue; dead letters are not opened."""
    reader = (pin_utc(spark).readStream if streaming else spark.read).options(**options)
    rows = reader.schema(LOG_SCHEMA).parquet(path).filter(F.col("kind") == VALID)
    return order_fields(rows.select(*ORDER_SCHEMA.fieldNames()))


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters of a log: payload and reason."""
    rows = spark.read.schema(LOG_SCHEMA).parquet(path)
    return rows.filter(F.col("kind") == DEAD).select("payload", "reason")
