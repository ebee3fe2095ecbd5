import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_text
from ordermetrics import operators as op
from ordermetrics.operators.windows import rank_slices
from ordermetrics.session import settings

NAN = float("nan")


def by_window(df, *columns):
    return {r.window_start.strftime("%H:%M"): tuple(r[c] for c in columns) for r in df.collect()}


def test_window_edges_and_null_times(orders):
    df = orders([
        ("2024-01-15 10:00:00", "A", 1.0), ("2024-01-15 10:00:59.999", "A", 2.0),
        ("2024-01-15 10:01:00", "A", 4.0), (None, "A", 8.0),
    ])
    assert by_window(op.window_totals(df), "total_revenue", "order_count") == {
        "10:00": (3.0, 2), "10:01": (4.0, 1)}
    assert {(r.window_end - r.window_start).seconds for r in op.window_totals(df).collect()} == {60}


def test_best_sku_rules(orders):
    df = orders([
        # tie between B and A
        ("2024-01-15 10:00:00", "B", 5.0), ("2024-01-15 10:00:01", "A", 5.0),
        # the null SKU has most
        ("2024-01-15 10:01:00", None, 9.0), ("2024-01-15 10:01:01", "A", 5.0),
        # tie between null and Z
        ("2024-01-15 10:02:00", None, 5.0), ("2024-01-15 10:02:01", "Z", 5.0),
        # revenue unknown throughout
        ("2024-01-15 10:03:00", "Q", None), ("2024-01-15 10:03:01", "P", None),
        # a negative total beats an unknown one
        ("2024-01-15 10:04:00", "Q", None), ("2024-01-15 10:04:01", "P", -1.0),
        # not-a-number sorts above all numbers
        ("2024-01-15 10:05:00", "Q", NAN), ("2024-01-15 10:05:01", "P", 1e300),
    ])
    live = op.live_metrics(df)
    assert {w: v[0] for w, v in by_window(live, "top_sku").items()} == {
        "10:00": "A", "10:01": None, "10:02": "Z", "10:03": "P", "10:04": "P", "10:05": "Q"}
    metrics = by_window(live, "total_revenue", "order_count")
    assert metrics["10:03"] == (0.0, 2)
    assert metrics["10:04"] == (-1.0, 2)


def random_orders(spark, n=4000, hot_share=0.4):
    """Many SKUs over few windows; one window and one SKU hold a large share."""
    rng = random.Random(7)
    rows = []
    for _ in range(n):
        minute = 0 if rng.random() < hot_share else rng.randrange(1, 6)
        sku = "S0" if rng.random() < hot_share else rng.choice([None, *[f"S{i}" for i in range(300)]])
        revenue = rng.choice([None, round(rng.uniform(0, 50), 2), 10.0])
        rows.append((datetime(2024, 1, 15, 10, minute, rng.randrange(60)), sku, revenue))
    return spark.createDataFrame(rows, "event_time timestamp, sku string, revenue double")


def test_roll_up_equals_join_form(spark):
    df = random_orders(spark)
    rolled = op.live_metrics(df)
    joined = op.attach_top_sku(op.window_totals(df), op.top_sku(op.window_sku_totals(df)))
    order = ["window_start", "window_end", "order_count", "top_sku"]
    assert sorted(rolled.select(order).collect()) == sorted(joined.select(order).collect())
    left = by_window(rolled, "total_revenue")
    right = by_window(joined, "total_revenue")
    assert left.keys() == right.keys()
    for window, (total,) in left.items():
        assert total == pytest.approx(right[window][0])


def test_live_metrics_against_plain_python(spark):
    df = random_orders(spark)
    windows = {}
    for r in df.collect():
        skus = windows.setdefault(r.event_time.replace(second=0), {})
        skus.setdefault(r.sku, []).append(r.revenue)
    expected = {}
    for start, skus in windows.items():
        totals = {}
        for sku, values in skus.items():
            known = [v for v in values if v is not None]
            totals[sku] = round(sum(known), 6) if known else None
        best = min(totals, key=lambda s: (totals[s] is None, -(totals[s] or 0), s is None, s or ""))
        expected[start] = (
            round(sum(t for t in totals.values() if t is not None), 2),
            sum(map(len, skus.values())), best)
    got = {r.window_start: (round(r.total_revenue, 2), r.order_count, r.top_sku)
           for r in op.live_metrics(df).collect()}
    assert got == expected


def test_rank_equals_row_number(spark):
    totals = op.window_sku_totals(random_orders(spark))
    spec = Window.partitionBy("window_start", "window_end").orderBy(
        F.round("sku_total_revenue", 6).desc_nulls_last(), F.col("sku").asc_nulls_last())
    expected = totals.withColumn("rank", F.row_number().over(spec))
    got = op.rank_skus(totals)
    columns = ["window_start", "sku", "rank"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(
        map(str, expected.select(columns).collect()))
    best = {(r.window_start, r.sku) for r in got.filter("rank = 1").collect()}
    assert best == {(r.window_start, r.top_sku) for r in op.top_sku(totals).collect()}


def test_rank_of_one_large_window_is_split(spark):
    totals = op.window_sku_totals(random_orders(spark, n=20000, hot_share=1.0).withColumn(
        "sku", F.concat(F.lit("S"), F.monotonically_increasing_id().cast("string"))))
    assert totals.select("window_start").distinct().count() == 1
    # Adaptive execution would join the slices of so few rows again.
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        sizes = [r["count"] for r in rank_slices(totals).groupBy("slice").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 10000
        ranks = [r.rank for r in op.rank_skus(totals).orderBy("rank").collect()]
    assert ranks == list(range(1, 20001))


def test_best_sku_needs_no_ranked_window(spark):
    plan = plan_text(op.live_metrics(random_orders(spark)))
    assert "Window (" not in plan and "Join" not in plan
    assert plan.count("Exchange (") == 2
    assert "partial_min" in plan


def test_lists_are_bounded_and_complete(spark):
    df = random_orders(spark)
    lists = op.sku_revenue_lists(df, block_bits=4)
    assert lists.agg(F.max(F.size("sku_revenues"))).first()[0] <= 16
    pairs = op.explode_sku_lists(lists)
    got = sorted((tuple(r) for r in pairs.select("sku", "revenue").collect()), key=str)
    assert got == sorted((tuple(r) for r in df.select("sku", "revenue").collect()), key=str)
    assert pairs.groupBy("window_start").count().count() == 6


def test_conservation(spark):
    df = random_orders(spark)
    live = op.live_metrics(df).agg(F.sum("order_count"), F.sum("total_revenue")).first()
    assert live[0] == df.count()
    assert live[1] == pytest.approx(df.agg(F.sum("revenue")).first()[0])


def test_latest_windows(windows):
    df = windows([(f"2024-01-15 10:{m:02d}:00", 1, 1.0) for m in range(9)])
    got = [r.window_start.minute for r in op.latest_windows(df, 5).collect()]
    assert got == [8, 7, 6, 5, 4]
