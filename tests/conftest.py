import json
import os
import sys
import time
from datetime import datetime, timezone
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8,4]").appName("ordermetrics-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def orders(spark):
    """Build orders from rows (time as ISO text, sku, revenue)."""
    def build(rows):
        typed = [(at and datetime.fromisoformat(at), sku, revenue) for at, sku, revenue in rows]
        return spark.createDataFrame(typed, "event_time timestamp, sku string, revenue double")
    return build


@pytest.fixture
def windows(spark):
    """Build live metrics from rows (window start as ISO text, orders, revenue)."""
    def build(rows):
        frame = spark.createDataFrame(
            [(datetime.fromisoformat(at), float(revenue), count) for at, count, revenue in rows],
            "window_start timestamp, total_revenue double, order_count bigint")
        return frame.selectExpr(
            "window_start", "window_start + INTERVAL 1 MINUTE AS window_end",
            "total_revenue", "order_count", "CAST(NULL AS STRING) AS top_sku")
    return build


def plan_text(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


BASE_MILLIS = 1700000040000
W0 = datetime(2023, 11, 14, 22, 14)
W1 = datetime(2023, 11, 14, 22, 15)


def stream_file(folder: Path, number: int, rows) -> None:
    """One file of orders (seconds after base, sku, quantity, price); later files are newer."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({
            "order_id": f"{number}-{i}", "customer_id": "CUST-1", "sku": sku,
            "quantity": quantity, "price": price, "timestamp": BASE_MILLIS + seconds * 1000,
        })
        for i, (seconds, sku, quantity, price) in enumerate(rows)
    ]
    path = folder / f"f{number}.txt"
    path.write_text("\n".join(lines) + "\n")
    at = datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp() + number * 10
    os.utime(path, (at, at))
