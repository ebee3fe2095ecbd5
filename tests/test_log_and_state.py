"""Event log, state against table, observed counts and exact sums."""

import logging
import os
import shutil
import time
from datetime import datetime

import pytest
from conftest import BASE_MILLIS, W0, W1, plan_text, stream_file
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ordermetrics import operators as op
from ordermetrics.jobs import check_state, live_orders
from ordermetrics.sinks import merge_table, read_table
from ordermetrics.sources import read_orders
from ordermetrics.streaming import (
    observed, read_dead_letters, read_order_log, start_live_metrics, start_metrics_of_orders,
    start_order_log, state_drift, state_totals, window_sku_table,
)

NOW = {"availableNow": True}


class Folders:
    def __init__(self, spark, path):
        self.spark, self.inbox = spark, path / "in"
        self.inbox.mkdir()
        self.log, self.target = str(path / "log"), str(path / "tables")
        self.checkpoints = str(path / "checkpoints")

    def messages(self):
        return read_orders(self.spark, "text", str(self.inbox), maxFilesPerTrigger=1)

    def ingest(self, **options):
        start_order_log(self.messages(), self.log, f"{self.checkpoints}/order_log", NOW,
                        **options).awaitTermination()

    def metrics(self, **options):
        start_metrics_of_orders(
            read_order_log(self.spark, self.log), self.target, f"{self.checkpoints}/live_metrics",
            trigger=NOW, **options).awaitTermination()

    def run(self, **options):
        query = start_live_metrics(
            self.messages(), self.target, f"{self.checkpoints}/live_metrics", trigger=NOW, **options)
        query.awaitTermination()
        return query

    def table(self):
        return {r.window_start: (r.total_revenue, r.order_count, r.top_sku)
                for r in read_table(self.spark, self.target, "live_metrics").collect()}


@pytest.fixture
def folders(spark, tmp_path):
    return Folders(spark, tmp_path)


def broken(folders, number, *lines):
    with folders.inbox.joinpath(f"f{number}.txt").open("a") as file:
        file.writelines(line + "\n" for line in lines)
    at = 1_704_067_200 + number * 10
    os.utime(folders.inbox / f"f{number}.txt", (at, at))


# --- event log ---------------------------------------------------------------------

def test_log_serves_metrics_and_letters(spark, folders):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10), (10, "B", 1, 20)])
    broken(folders, 0, '{"sku":"A"}', "[1]")
    folders.ingest()
    folders.metrics()
    assert folders.table() == {W0: (30.0, 2, "B")}
    stream_file(folders.inbox, 1, [(15, "A", 1, 15), (70, "A", 1, 1)])
    broken(folders, 1, "{")
    for _ in range(2):  # a start without new messages adds nothing
        folders.ingest()
        folders.metrics()
    assert folders.table() == {W0: (45.0, 3, "A"), W1: (1.0, 1, "A")}
    letters = sorted((r.payload, r.reason) for r in read_dead_letters(spark, folders.log).collect())
    assert letters == [("[1]", "not_an_object"), ("{", "malformed_json"), ('{"sku":"A"}', "missing_order_id")]
    # Metrics do not open dead letters, and the messages are no part of their plan.
    plan = plan_text(read_order_log(spark, folders.log, streaming=False))
    assert "kind=valid" in plan or "kind" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert "from_json" not in plan


def test_crash_between_log_and_metrics(spark, folders):
    """Messages are in the log with both kinds or not at all; metrics catch up from there."""
    stream_file(folders.inbox, 0, [(5, "A", 1, 10)])
    broken(folders, 0, "{")
    folders.ingest()

    def lost(rows, batch_id):
        raise RuntimeError("driver lost")

    with pytest.raises(StreamingQueryException):
        folders.metrics(sink=lost)
    shutil.rmtree(folders.inbox)  # the source is not read again
    folders.inbox.mkdir()
    folders.metrics()
    assert folders.table() == {W0: (10.0, 1, "A")}
    assert read_dead_letters(spark, folders.log).count() == 1


def test_replayed_log_batch_is_seen_once(spark, folders):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10)])
    broken(folders, 0, "{")
    folders.ingest()
    # The batch ran, but the query died before its commit was written.
    commits = f"{folders.checkpoints}/order_log/commits"
    for name in os.listdir(commits):
        os.remove(f"{commits}/{name}")
    folders.ingest()
    assert read_order_log(spark, folders.log, streaming=False).count() == 1
    assert read_dead_letters(spark, folders.log).count() == 1


def test_strict_log(spark, folders):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10), (6, None, 1, 1)])
    folders.ingest(strict=True)
    assert read_order_log(spark, folders.log, streaming=False).count() == 1
    assert [r.reason for r in read_dead_letters(spark, folders.log).collect()] == ["missing_sku"]


def test_job_with_a_log(spark, folders, caplog):
    caplog.set_level(logging.INFO, "ordermetrics")
    stream_file(folders.inbox, 0, [(0, "A", 2, 5.0), (61, "B", 1, 3.0)])
    broken(folders, 0, "{")
    live_orders.run(spark, live_orders.arguments([
        "--format", "text", "--path", str(folders.inbox), "--target", folders.target,
        "--checkpoint", folders.checkpoints, "--log", folders.log, "--available-now"]))
    assert folders.table() == {W0: (10.0, 1, "A"), W1: (3.0, 1, "B")}
    assert read_dead_letters(spark, folders.log).count() == 1
    until = time.time() + 20
    while "3 read" not in caplog.text and time.time() < until:
        time.sleep(0.2)  # progress arrives on a thread of its own
    assert "orders: 3 read, 2 valid, 1 dead, 0 timeless" in caplog.text


# --- observed counts ---------------------------------------------------------------

MESSAGES = [
    None, "", "{", "[1]", '{"sku":"A"}', '{"order_id":"1","sku":"A","quantity":1,"price":2,"timestamp":0}',
    '{"order_id":"2"}', '{"order_id":"3","timestamp":900000000000000000}']


@pytest.mark.parametrize("strict, expected", [
    (False, {"read": 8, "valid": 3, "dead": 5, "timeless": 2}),
    (True, {"read": 8, "valid": 1, "dead": 7, "timeless": 0})])
def test_counts_come_with_the_query(spark, strict, expected):
    raw = spark.createDataFrame([(m,) for m in MESSAGES], "json_str string").repartition(3)
    seen = Observation("messages")
    rows = op.valid_orders(op.counted(op.parse_orders(raw), seen, strict), strict).collect()
    assert seen.get == expected
    assert seen.get["valid"] + seen.get["dead"] == seen.get["read"] == len(MESSAGES)
    assert len(rows) == expected["valid"]


def test_counted_rows_are_parsed_once(spark):
    raw = spark.createDataFrame([(m,) for m in MESSAGES], "json_str string")
    plan = plan_text(op.window_totals(op.valid_orders(op.counted(op.parse_orders(raw), "n"))))
    assert plan.count("from_json(") == 1


def test_stream_reports_its_counts(spark, folders):
    stream_file(folders.inbox, 0, [(0, "A", 1, 5), (10**16, "A", 1, 5)])
    broken(folders, 0, "{", '{"sku":"A"}')
    stream_file(folders.inbox, 1, [(1, "A", 1, 5)])
    assert observed(folders.run()) == {"read": 5, "valid": 3, "dead": 2, "timeless": 1}


# --- state against table -----------------------------------------------------------

def drift(folders, checkpoint=None):
    rows = state_drift(folders.spark, folders.target, checkpoint or f"{folders.checkpoints}/live_metrics")
    return sorted((r.window_start, r.sku, r.status, r.state_count, r.stored_count) for r in rows.collect())


def test_state_equals_what_is_stored(spark, folders):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10), (10, None, 2, 20)])
    stream_file(folders.inbox, 1, [(50, "A", 1, 10), (62, "C", 1, 1)])
    folders.run()
    checkpoint = f"{folders.checkpoints}/live_metrics"
    state = {(r.window_start, r.sku, r.sku_total_revenue, r.sku_order_count)
             for r in state_totals(spark, checkpoint).collect()}
    assert state == {(r.window_start, r.sku, r.sku_total_revenue, r.sku_order_count)
                     for r in window_sku_table(spark, folders.target).collect()}
    assert len(state) == 3 and drift(folders) == []


@pytest.mark.parametrize("dedup", [False, True])
def test_checkpoint_put_back_by_two_batches(spark, folders, tmp_path, dedup, capsys):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10), (6, "B", 1, 1)])
    folders.run(dedup=dedup)
    old = tmp_path / "older"
    shutil.copytree(folders.checkpoints, old)
    stream_file(folders.inbox, 1, [(15, "A", 1, 15)])
    stream_file(folders.inbox, 2, [(20, "C", 1, 2), (25, "A", 1, 1)])
    folders.run(dedup=dedup)
    assert drift(folders) == []
    assert drift(folders, f"{old}/live_metrics") == [(W0, "A", "different", 1, 3), (W0, "C", "ahead", None, 1)]
    job, out = check_state, str(tmp_path / "out")
    assert job.run(spark, job.arguments(
        ["--target", folders.target, "--checkpoint", str(old), "--out", out])) == 2
    assert "ahead: 1 keys\ndifferent: 1 keys" in capsys.readouterr().out
    assert spark.read.parquet(out).count() == 2
    assert job.run(spark, job.arguments(
        ["--target", folders.target, "--checkpoint", folders.checkpoints])) == 0


def test_stored_changes_that_are_lost(spark, folders):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10)])
    stream_file(folders.inbox, 1, [(6, "B", 1, 1)])
    folders.run()
    for folder in (os.path.join(folders.target, "window_sku_changes", "slot=2023-11-14-22", "batch_id=1"),):
        shutil.rmtree(folder)
    assert drift(folders) == [(W0, "B", "missing", 1, None)]


def test_closed_windows_are_not_compared(spark, folders):
    stream_file(folders.inbox, 0, [(5, "A", 1, 10)])
    stream_file(folders.inbox, 1, [(1000, "A", 1, 10)])
    stream_file(folders.inbox, 2, [(1001, "A", 1, 10)])
    folders.run()
    assert drift(folders) == []


# --- exact sums --------------------------------------------------------------------

@pytest.fixture
def uneven(spark):
    """Revenues whose double sum depends on the order of addition."""
    return spark.range(3000).select(
        F.timestamp_millis(F.lit(BASE_MILLIS) + F.col("id") % 3 * 60_000).alias("event_time"),
        F.concat(F.lit("S"), F.col("id") % 7).alias("sku"),
        F.when(F.col("id") % 5 == 0, 1e9 + F.col("id") / 7).otherwise(F.col("id") / 10_000).alias("revenue"))


def test_exact_totals_do_not_depend_on_order(spark, uneven):
    exact = op.exact_revenue(uneven)
    first = sorted(op.live_metrics(exact.repartition(1)).collect())
    for n, seed in ((5, 1), (11, 2), (3, 3)):
        assert sorted(op.live_metrics(exact.repartition(n, F.rand(seed))).collect()) == first
    assert str(op.live_metrics(exact).schema["total_revenue"].dataType) == "DecimalType(38,6)"
    days = {op.daily_summary(op.live_metrics(exact.repartition(n, F.rand(n)))).first() for n in (1, 4, 9)}
    assert len(days) == 1


def test_exact_ranking_equals_python(spark, orders):
    from decimal import Decimal
    at = "2024-01-15 10:00:00"
    rows = [(at, "A", 0.1), (at, "A", 0.2), (at, "B", 0.3), (at, "C", 0.3000004), (at, "D", None),
            (at, None, 0.3), (at, "E", float("nan")), (at, "F", 1e30)]
    ranked = op.rank_skus(op.window_sku_totals(op.exact_revenue(orders(rows)))).orderBy("rank").collect()
    # Three tenths thrice, told from each other by name; what is no decimal has no total.
    assert [(r.sku, r.sku_total_revenue) for r in ranked] == [
        ("A", Decimal("0.3")), ("B", Decimal("0.3")), ("C", Decimal("0.3")), (None, Decimal("0.3")),
        ("D", None), ("E", None), ("F", None)]
    assert op.top_sku(op.window_sku_totals(op.exact_revenue(orders(rows)))).first().top_sku == "A"


def test_exact_rows_can_be_stored(spark, tmp_path, orders):
    rows = op.live_metrics(op.exact_revenue(orders([("2024-01-15 10:00:00", "A", 0.1)] * 3)))
    merge_table(spark, str(tmp_path), "live_metrics", rows.withColumn(
        "total_revenue", F.col("total_revenue").cast("double")))
    stored = read_table(spark, str(tmp_path), "live_metrics").first()
    assert stored.total_revenue == 0.3 and stored.window_start == datetime(2024, 1, 15, 10)
