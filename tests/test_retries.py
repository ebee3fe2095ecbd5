"""Results stay whole when tasks fail and run again."""

import json
import random

import pytest
from pyspark import TaskContext

from ordermetrics import operators as op
from ordermetrics.sinks import merge_table, read_table


def failing_once(messages):
    """The same messages; half of the tasks fail after some rows of their first attempt."""
    def flaky(batches):
        context = TaskContext.get()
        for number, batch in enumerate(batches):
            if context.attemptNumber() == 0 and context.partitionId() % 2 == 0 and number == 1:
                raise RuntimeError("executor lost")
            yield batch

    return messages.mapInPandas(flaky, messages.schema)


@pytest.fixture
def messages(spark):
    rng = random.Random(5)
    lines = [(json.dumps({
        "order_id": str(i), "sku": rng.choice(["HOT", f"S{i % 90}"]), "quantity": 1 + i % 4,
        "price": round(rng.uniform(1, 9), 2), "timestamp": 1705276800000 + rng.choice([0, i]) * 100,
    }),) for i in range(4000)]
    return spark.createDataFrame(lines, "json_str string").repartition(4)


def rows(df):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.collect())


def results(messages):
    orders = op.valid_orders(op.parse_orders(messages))
    totals = op.window_sku_totals(orders)
    return {
        "live": rows(op.live_metrics(orders)),
        "pairs": rows(op.explode_sku_lists(op.sku_revenue_lists(orders, block_bits=5))),
        "ranks": rows(op.rank_skus(totals).drop("sku_total_revenue")),
    }


def test_operators(spark, messages):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert results(failing_once(messages)) == results(messages)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merge(spark, messages, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        failing = op.valid_orders(op.parse_orders(failing_once(messages)))
        for _ in range(2):
            merge_table(spark, str(tmp_path), "live_metrics", op.live_metrics(failing))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = op.live_metrics(op.valid_orders(op.parse_orders(messages)))
    assert rows(read_table(spark, str(tmp_path), "live_metrics").drop("window_date")) == rows(expected)
