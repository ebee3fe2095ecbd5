"""Digests, differing days and the repair of stored windows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ordermetrics import operators as op
from ordermetrics.operators.drift import day_digests, differing_days
from ordermetrics.plans.repair import repair_live_metrics
from ordermetrics.sinks import merge_table, read_table
from ordermetrics.sinks.files import current_versions


@pytest.fixture
def archive(orders):
    return orders([(f"2024-01-{day:02d} {hour:02d}:00:{n:02d}", sku, 1.1 * n)
                   for day in range(10, 16) for hour in (3, 17) for n, sku in enumerate("ABCA")])


@pytest.fixture
def root(spark, tmp_path, archive):
    merge_table(spark, str(tmp_path), "live_metrics", op.live_metrics(archive))
    return str(tmp_path)


def content(spark, root):
    return sorted(map(tuple, read_table(spark, root, "live_metrics").collect()))


def days(spark, root):
    return {f.partition("=")[2]: v for f, v in current_versions(spark, f"{root}/live_metrics")[1].items()}


def test_digests_do_not_depend_on_order(spark, archive):
    rows = op.live_metrics(archive).withColumn("window_date", F.to_date("window_start"))
    a = day_digests(rows.repartition(7, F.rand())).collect()
    assert sorted(a) == sorted(day_digests(rows.orderBy(F.desc("order_count")).coalesce(1)).collect())


@pytest.mark.parametrize("change", [
    "order_count = order_count + 1", "total_revenue = total_revenue + 0.01", "top_sku = NULL",
    "top_sku = 'Z'", "window_end = window_end + INTERVAL 1 MINUTE", "total_revenue = NULL"])
def test_every_column_counts(archive, change):
    name, _, value = change.partition(" = ")
    rows = op.live_metrics(archive).withColumn("window_date", F.to_date("window_start"))
    hit = F.col("window_start") == F.lit(datetime(2024, 1, 12, 3))
    damaged = rows.withColumn(name, F.when(hit, F.expr(value)).otherwise(F.col(name)))
    found = differing_days(day_digests(damaged), day_digests(rows)).collect()
    assert [str(r.window_date) for r in found] == ["2024-01-12"]


def test_repair_swaps_only_damaged_days(spark, root, archive):
    before, whole = days(spark, root), content(spark, root)
    damaged = read_table(spark, root, "live_metrics").filter(
        "window_start = '2024-01-11 03:00:00'").withColumn("order_count", F.lit(99).cast("bigint"))
    merge_table(spark, root, "live_metrics", damaged.drop("window_date"))
    extra = spark.sql("SELECT TIMESTAMP '2024-01-13 23:00:00' AS window_start, TIMESTAMP '2024-01-13 23:01:00' "
                      "AS window_end, 1D AS total_revenue, 1L AS order_count, 'X' AS top_sku")
    merge_table(spark, root, "live_metrics", extra)
    number = current_versions(spark, f"{root}/live_metrics")[0]
    assert repair_live_metrics(spark, root, archive) == [date(2024, 1, 11), date(2024, 1, 13)]
    assert content(spark, root) == whole
    # One step, and the other days keep their folders.
    assert current_versions(spark, f"{root}/live_metrics")[0] == number + 1
    after = days(spark, root)
    assert {d for d in after if after[d] == before[d]} == after.keys() - {"2024-01-11", "2024-01-13"}
    assert repair_live_metrics(spark, root, archive) == []
    assert current_versions(spark, f"{root}/live_metrics")[0] == number + 1


def test_repair_within_bounds(spark, root, archive):
    whole = content(spark, root)
    none = archive.filter("event_time < '2024-01-13'")
    # The archive ends early: later days stay unless they are asked for.
    assert repair_live_metrics(spark, root, none) == []
    assert content(spark, root) == whole
    assert repair_live_metrics(spark, root, none, "2024-01-13", date(2024, 1, 14)) == [
        date(2024, 1, 13), date(2024, 1, 14)]
    assert days(spark, root).keys() == {f"2024-01-{d}" for d in (10, 11, 12, 15)}
    assert repair_live_metrics(spark, root, archive, last="2024-01-14") == [
        date(2024, 1, 13), date(2024, 1, 14)]
    assert content(spark, root) == whole


def test_repair_of_nothing(spark, tmp_path, archive):
    assert repair_live_metrics(spark, str(tmp_path), archive.filter("false")) == []
    assert len(repair_live_metrics(spark, str(tmp_path), archive)) == 6
