import logging
import time
from datetime import date

import pytest
from conftest import W0, W1, stream_file

from ordermetrics.jobs import compact_changes, live_orders, reconcile_days, repair_days
from ordermetrics.sinks import read_table
from ordermetrics.streaming import window_sku_table


def test_stream_then_reconcile(spark, tmp_path, capsys, caplog):
    caplog.set_level(logging.INFO, "ordermetrics")
    stream_file(tmp_path / "in", 0, [(0, "A", 2, 5.0), (61, "B", 1, 3.0)])
    (tmp_path / "in" / "f1.txt").write_text('{"order_id":"x",BROKEN_JSON\n')
    root = str(tmp_path / "tables")
    live_orders.run(spark, live_orders.arguments([
        "--format", "text", "--path", str(tmp_path / "in"), "--option", "maxFilesPerTrigger=1",
        "--target", root, "--checkpoint", str(tmp_path / "checkpoint"), "--available-now"]))
    got = {r.window_start: r.top_sku for r in read_table(spark, root, "live_metrics").collect()}
    assert got == {W0: "A", W1: "B"}
    assert spark.read.parquet(f"{root}/dead_letters").count() == 1

    until = time.time() + 20
    while "state rows" not in caplog.text and time.time() < until:
        time.sleep(0.2)  # progress arrives on a thread of its own
    assert "2 rows in, 2 state rows, 0 dropped late" in caplog.text
    assert "batch 0: 2 keys changed" in caplog.text

    job = reconcile_days
    assert job.run(spark, job.arguments(["--root", root, "--date", "2020-01-01"])) == []
    assert "no windows stored for 2020-01-01" in capsys.readouterr().out
    lines = job.run(spark, job.arguments(["--root", root, "--date", "2023-11-14"]))
    assert lines == job.run(spark, job.arguments(["--root", root]))
    assert lines[0].startswith("2023-11-14: 2 orders, revenue 13.00, average 6.50; 0 odd hours")
    assert read_table(spark, root, "daily_summary").count() == 1


@pytest.mark.parametrize("argv", [
    ["--root", "x", "--date", "soon"], [], ["--root", "x", "--jdbc", "url=y"], ["--jdbc", "url=y"],
])
def test_bad_arguments_are_refused(argv):
    with pytest.raises(SystemExit):
        reconcile_days.arguments(argv)


def test_database_form(spark, windows, monkeypatch):
    """What the job hands to the database functions; they themselves need a real database."""
    merged = {}

    def read(session, options, first, last):
        assert options == {"url": "jdbc:x", "user": "u"} and first == last == date(2024, 1, 15)
        return windows([(f"2024-01-15 {h:02d}:00:00", n, n) for h, n in enumerate([1] * 5 + [90])])

    def merge(session, rows, options, name, keys, scope):
        merged[name] = (rows.count(), keys, scope and scope.columns)

    monkeypatch.setattr(reconcile_days, "read_live_metrics_jdbc", read)
    monkeypatch.setattr(reconcile_days, "merge_into_jdbc", merge)
    job = reconcile_days
    job.run(spark, job.arguments(
        ["--jdbc", "url=jdbc:x", "--jdbc", "user=u", "--date", "2024-01-15"]))
    assert merged == {
        "daily_summary": (1, ["summary_date"], None),
        "anomalies": (1, ["detected_date", "metric", "hour"], ["detected_date", "metric"])}


def test_compaction_of_closed_hours(spark, tmp_path):
    for number, at in enumerate([0, 10, 3600, 3610, 7200]):
        stream_file(tmp_path / "in", number, [(at, "A", 1, 1.0)])
    root = str(tmp_path / "tables")
    live_orders.run(spark, live_orders.arguments([
        "--format", "text", "--path", str(tmp_path / "in"), "--option", "maxFilesPerTrigger=1",
        "--target", root, "--checkpoint", str(tmp_path / "checkpoint"), "--available-now"]))
    before = sorted(map(str, window_sku_table(spark, root).collect()))
    args = compact_changes.arguments([
        "--target", root, "--checkpoint", str(tmp_path / "checkpoint"), "--before", "2023-11-14-23"])
    assert compact_changes.run(spark, args) == 1

    # What was replaced stays for running queries until the next run of the job.
    path = tmp_path / "tables" / "window_sku_changes"
    assert sorted(f.name for f in path.glob("slot=2023-11-14-22/*")) == ["batch_id=0", "batch_id=1"]
    assert compact_changes.run(spark, args) == 0
    assert list(path.glob("slot=2023-11-14-22/*")) == []
    assert sorted(f.name for f in path.glob("slot=2023-11-14-23/*")) == ["batch_id=2", "batch_id=3"]
    assert sorted(map(str, window_sku_table(spark, root).collect())) == before


def test_repair_job(spark, tmp_path, capsys):
    stream_file(tmp_path / "archive", 0, [(0, "A", 2, 5.0), (61, "B", 1, 3.0), (90_000, "C", 1, 1.0)])
    (tmp_path / "archive" / "f1.txt").write_text('{"order_id":"x",BROKEN_JSON\n')
    root = str(tmp_path / "tables")
    job = repair_days
    days = job.run(spark, job.arguments(["--root", root, "--path", str(tmp_path / "archive")]))
    assert list(map(str, days)) == ["2023-11-14", "2023-11-15"]
    assert "2 days repaired\n2023-11-14\n2023-11-15" in capsys.readouterr().out
    assert read_table(spark, root, "live_metrics").count() == 3
    assert job.run(spark, job.arguments([
        "--root", root, "--path", str(tmp_path / "archive"), "--last", "2023-11-14"])) == []
