from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from conftest import TESTDATA, plan_text
from ordermetrics import operators as op
from ordermetrics.schemas import (
    ANOMALIES, ANOMALY_KEYS, DAILY_KEYS, DAILY_SUMMARY, LIVE_METRICS, WINDOW_KEYS,
)
from ordermetrics.session import fresh_dir, settings, shared_dir
from ordermetrics.sinks import create_table_sql, jdbc, merge_sql, publish_orders
from ordermetrics.sources import (
    hour_predicates, order_feed, orders, read_live_metrics_jdbc, read_orders,
)
from ordermetrics.sources.feed import events, events_stream, spread

SF = str(TESTDATA / "sf0.01")


def test_publish_and_read_back(spark, tmp_path):
    parsed = op.parse_orders(order_feed(events(spark, SF)))
    sent = parsed.filter("order_id IS NOT NULL")
    publish_orders(sent, "text", str(tmp_path / "topic"))
    got = op.parse_orders(read_orders(spark, "text", str(tmp_path / "topic"), streaming=False))
    columns = ["order_id", "customer_id", "sku", "quantity", "price", "timestamp"]
    assert got.count() == sent.count() == 9800
    assert got.select(columns).exceptAll(sent.select(columns)).isEmpty()


def test_binary_payload(spark):
    df = spark.createDataFrame([(1, bytearray('{"sku":"ü"}', "utf-8"))], "id int, value binary")
    assert orders.decode_payload(df).first().asDict() == {"id": 1, "json_str": '{"sku":"ü"}'}


class FakeReader:
    def __init__(self, seen):
        self.seen = seen

    def format(self, fmt):
        self.seen["format"] = fmt
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        raise StopIteration


@pytest.mark.parametrize("streaming, start", [(True, "latest"), (False, None)])
def test_topic_options(streaming, start):
    seen = {}

    class FakeSession:
        read = readStream = FakeReader(seen)

        class conf:
            set = staticmethod(seen.__setitem__)

    with pytest.raises(StopIteration):
        read_orders(FakeSession(), "kafka", streaming=streaming,
                    **{"kafka.bootstrap.servers": "h:1", "minPartitions": 64})
    assert seen["format"] == "kafka" and seen["subscribe"] == "orders"
    assert seen.get("startingOffsets") == start
    assert seen["minPartitions"] == 64
    assert seen["spark.sql.session.timeZone"] == "UTC"


@pytest.mark.parametrize("column", ["value", "json_str"])
def test_orders_from_a_table(spark, tmp_path, column):
    name = f"archived_{column}"
    spark.sql(f"CREATE TABLE {name} ({column} STRING, at DATE) USING parquet LOCATION '{tmp_path / name}'")
    try:
        spark.sql(f"INSERT INTO {name} VALUES ('{{\"order_id\":\"1\"}}', DATE '2024-01-01')")
        rows = read_orders(spark, "table", name, streaming=False)
        assert [r.json_str for r in rows.collect()] == ['{"order_id":"1"}']
        stream, out = read_orders(spark, "table", name), str(tmp_path / "out")
        for count in (1, 2):
            stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(
                availableNow=True).format("parquet").start(out).awaitTermination()
            assert spark.read.parquet(out).count() == count
            spark.sql(f"INSERT INTO {name} VALUES ('{{\"order_id\":\"2\"}}', NULL)")
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_feed_counts_and_first_days(spark):
    parsed = op.parse_orders(order_feed(events(spark, SF)))
    assert op.dead_letters(parsed).count() == 200
    days = op.daily_summary(op.window_totals(op.valid_orders(parsed))).orderBy("summary_date")
    got = [(r.total_orders, round(r.total_revenue, 2)) for r in days.limit(3).collect()]
    assert got == [(356, 54933.87), (332, 48711.22), (327, 45804.19)]


def test_small_files_are_spread_over_the_cores(spark):
    rows = events(spark, SF)
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 20)
    assert spread(many) is many


def test_day_limits_the_scan(spark):
    plan = plan_text(events(spark, SF, "2024-01-15"))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan


def test_events_stream_reads_file_or_folder(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/events.parquet").limit(100)
    rows.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for number, (source, expected) in enumerate([(SF, 10000), (str(tmp_path), 100)]):
        out = str(tmp_path / f"out{number}")
        (events_stream(spark, source).writeStream.format("parquet")
         .option("checkpointLocation", f"{out}_checkpoint").trigger(availableNow=True)
         .start(out).awaitTermination())
        assert spark.read.parquet(out).count() == expected


def test_hour_predicates_cover_each_day_once():
    predicates = hour_predicates(date(2024, 1, 15), date(2024, 1, 16))
    assert len(predicates) == 48
    db = duckdb.connect()
    db.execute("CREATE TABLE t AS SELECT * FROM range(TIMESTAMP '2024-01-14 12:00:00', "
               "TIMESTAMP '2024-01-17 12:00:00', INTERVAL 7 MINUTE) r(window_start)")
    hits = sum(db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates)
    whole = db.execute("SELECT count(*) FROM t WHERE CAST(window_start AS DATE) "
                       "BETWEEN '2024-01-15' AND '2024-01-16'").fetchone()[0]
    assert hits == whole > 0


def test_database_statements():
    db = duckdb.connect()
    for name, schema, keys in [("live_metrics", LIVE_METRICS, WINDOW_KEYS),
                               ("daily_summary", DAILY_SUMMARY, DAILY_KEYS),
                               ("anomalies", ANOMALIES, ANOMALY_KEYS)]:
        for _ in range(2):
            db.execute(create_table_sql(name, schema, keys))
    db.execute("INSERT INTO daily_summary VALUES ('2024-01-01', 1, 1, 1), ('2024-01-02', 2, 2, 2)")
    db.execute("CREATE TABLE staged AS SELECT * FROM (VALUES "
               "(DATE '2024-01-02', 20, 20, 20), (DATE '2024-01-03', 3, 3, 3)) "
               "t(summary_date, total_orders, total_revenue, avg_order_value)")
    sql = merge_sql("daily_summary", "staged", DAILY_SUMMARY.fieldNames(), DAILY_KEYS)
    for _ in range(2):
        db.execute(sql)
        got = db.execute("SELECT total_orders FROM daily_summary ORDER BY summary_date").fetchall()
        assert got == [(1,), (20,), (3,)]


def test_database_merge_goes_through_a_staging_table(spark, monkeypatch):
    """The calls made; the transfer itself would need a database."""
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None:
                        calls.append((url, table, properties)))
    monkeypatch.setattr(jdbc, "execute", lambda spark, options, *sql: calls.append(sql))
    rows = spark.sql("SELECT DATE '2024-01-15' AS summary_date, 1L AS total_orders")
    jdbc.merge_into_jdbc(
        spark, rows, {"url": "jdbc:x", "user": "u"}, "daily_summary", DAILY_KEYS, batch_id=7)
    staging = calls[0][1]
    assert staging.startswith("daily_summary_incoming_7_")
    assert calls == [
        ("jdbc:x", staging, {"user": "u"}),
        ("CREATE TABLE IF NOT EXISTS daily_summary (summary_date DATE, total_orders BIGINT, "
         "PRIMARY KEY (summary_date))",
         "INSERT INTO daily_summary (summary_date, total_orders) "
         f"SELECT summary_date, total_orders FROM {staging} "
         "ON CONFLICT (summary_date) DO UPDATE SET total_orders = EXCLUDED.total_orders"),
        (f"DROP TABLE {staging}",),
    ]


def test_failed_database_merge_drops_its_staging_table(spark, monkeypatch):
    staged, dropped = [], []

    def execute(spark, options, *sql):
        if sql[0].startswith("CREATE"):
            raise RuntimeError("database lost")
        dropped.extend(sql)

    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None:
                        staged.append(table))
    monkeypatch.setattr(jdbc, "execute", execute)
    rows = spark.sql("SELECT DATE '2024-01-15' AS summary_date, 1L AS total_orders")
    for _ in range(2):
        with pytest.raises(RuntimeError):
            jdbc.merge_into_jdbc(spark, rows, {"url": "jdbc:x"}, "daily_summary", DAILY_KEYS)
    assert dropped == [f"DROP TABLE {name}" for name in staged] and len(set(staged)) == 2


def test_times_cross_the_database_border_as_utc_wall_times(spark, monkeypatch):
    at = datetime(2024, 1, 15, 10, 5)
    rows = spark.sql("SELECT TIMESTAMP '2024-01-15 10:05:00' AS window_start, 1L AS order_count")
    stored = jdbc.utc_wall_times(rows)
    assert dict(stored.dtypes) == {"window_start": "timestamp_ntz", "order_count": "bigint"}
    assert stored.first().window_start == at
    monkeypatch.setattr(DataFrameReader, "jdbc",
                        lambda self, url, table, predicates=None, properties=None: stored)
    read = read_live_metrics_jdbc(spark, {"url": "jdbc:x"}, at.date(), at.date())
    assert read.dtypes == rows.dtypes and read.collect() == rows.collect()


def test_database_scan_is_split_by_hour(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, predicates=None, properties=None:
                        calls.append((url, table, len(predicates), properties)) or rows)
    rows, day = spark.range(1), date(2024, 1, 15)
    read_live_metrics_jdbc(spark, {"url": "jdbc:x", "password": "p"}, day, day)
    assert calls == [("jdbc:x", "live_metrics", 24, {"password": "p", "preferTimestampNTZ": "true"})]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    first, second = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert first != second and first.startswith(configured)


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(KeyError):
        with settings(spark, {"spark.sql.shuffle.partitions": "77", "spark.my.own": "1"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
            raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.my.own", None) is None


def test_price_is_rounded_half_up(spark):
    from ordermetrics.functions import order_struct
    row = spark.sql("SELECT 1L AS id, 2.345D AS price").select(order_struct(
        F.col("id"), F.col("id"), F.lit("s"), F.lit(1), F.col("price"), F.lit(0)).alias("o"))
    assert row.first().o.price == 2.35 and row.first().o.customer_id == "CUST-1"
