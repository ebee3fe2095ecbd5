from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ordermetrics.operators import latest_per_key, merge_rows
from ordermetrics.session import settings
from ordermetrics.sinks import create_tables, files, merge_into, merge_table, read_table
from ordermetrics.sinks.files import TABLES, exists

SCHEMA = "day date, k string, v bigint"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "day string, k string, v bigint").withColumn(
        "day", F.to_date("day"))


def content(df):
    return sorted(((str(r.day), r.k, r.v) for r in df.collect()), key=str)


def test_merge_rows(spark):
    target = rows(spark, ("2024-01-01", "a", 1), ("2024-01-01", None, 2), ("2024-01-02", "a", 3))
    updates = rows(spark, ("2024-01-01", None, 20), ("2024-01-01", "b", 4))
    merged = merge_rows(target, updates, ["day", "k"])
    expected = [("2024-01-01", "a", 1), ("2024-01-01", "b", 4), ("2024-01-01", None, 20),
                ("2024-01-02", "a", 3)]
    assert content(merged) == sorted(expected, key=str)
    assert content(merge_rows(merged, updates, ["day", "k"])) == content(merged)


def test_merge_rows_from_one_source(spark):
    source = rows(spark, ("2024-01-01", "a", 1), ("2024-01-01", "b", 2))
    updates = source.filter("k = 'a'").withColumn("v", F.col("v") + 10)
    assert content(merge_rows(source, updates, ["day", "k"])) == [
        ("2024-01-01", "a", 11), ("2024-01-01", "b", 2)]


def test_latest_per_key(spark):
    changes = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 3, None), ("a", 2, 5.0), (None, 1, 2.0)], "k string, n bigint, v double")
    got = {r.k: r.v for r in latest_per_key(changes, ["k"], "n").collect()}
    assert got == {"a": None, None: 2.0}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = rows(spark).schema
    full = files._with_partition(schema, "p")

    class Table:
        def merge(self, *values, scope=None):
            merge_into(spark, path, rows(spark, *values), ["day", "k"], schema,
                       "p", F.to_date("day"), scope)

        def frame(self):
            return files._read(spark, path, full, files.current_versions(spark, path)[1])

        def content(self):
            return content(self.frame())

        def versions(self):
            """Each partition's merge number; the folder name also has a drawn part."""
            named = files.current_versions(spark, path)[1]
            return {k: int(v.partition("-")[0]) for k, v in named.items()}

        def folders(self):
            return sorted(str(f.relative_to(path)).rpartition("-")[0]
                          for f in (tmp_path / "table").glob("p=*/version=*"))

    built = Table()
    built.path = path
    return built


def test_merge_into_touches_only_its_partitions(table):
    table.merge(("2024-01-01", "a", 1), ("2024-01-02", "a", 2), (None, "n", 0))
    table.merge(("2024-01-02", "a", 20), ("2024-01-03", "c", 3))
    assert table.versions() == {
        "p=2024-01-01": 1, "p=2024-01-02": 2, "p=2024-01-03": 2,
        "p=__HIVE_DEFAULT_PARTITION__": 1}
    expected = [("2024-01-01", "a", 1), ("2024-01-02", "a", 20), ("2024-01-03", "c", 3),
                ("None", "n", 0)]
    assert table.content() == expected
    table.merge((None, "n", 9))
    assert table.content()[-1] == ("None", "n", 9)


def test_merge_into_repeated_or_empty(table, spark):
    table.merge()
    assert not exists(spark, table.path)
    for _ in range(2):
        table.merge(("2024-01-01", "a", 1), ("2024-01-01", None, 2))
    table.merge()
    assert table.content() == [("2024-01-01", "a", 1), ("2024-01-01", None, 2)]


def test_merge_into_many_partitions(table):
    table.merge(("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "a", 3))
    table.merge(("2024-01-01", "a", 10), ("2024-01-02", "b", 20))
    assert table.versions() == {"p=2024-01-01": 2, "p=2024-01-02": 2, "p=2024-01-03": 1}
    assert table.content() == [("2024-01-01", "a", 10), ("2024-01-02", "a", 2),
                               ("2024-01-02", "b", 20), ("2024-01-03", "a", 3)]


def test_crash_before_the_switch_changes_nothing(table, monkeypatch):
    table.merge(("2024-01-01", "a", 1), ("2024-01-02", "a", 2))

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(files, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.merge(("2024-01-01", "a", 99), ("2024-01-02", "z", 99))
    assert table.content() == [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]
    # The next merge uses the same number; what the crash left elsewhere stays unseen.
    table.merge(("2024-01-01", "b", 3))
    assert table.content() == [("2024-01-01", "a", 1), ("2024-01-01", "b", 3),
                               ("2024-01-02", "a", 2)]


def test_crash_then_a_merge_elsewhere(table, monkeypatch):
    days = [f"2024-01-{d:02d}" for d in range(1, 29)]
    table.merge(*((day, "a", 1) for day in days))
    with monkeypatch.context() as patch:
        patch.setattr(files, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(*((day, "uncommitted", 99) for day in days))
    table.merge(*((f"2024-02-{d:02d}", "b", 2) for d in range(1, 29)))
    assert {row[1] for row in table.content()} == {"a", "b"}


def test_reader_of_an_old_partition_keeps_its_files(table, monkeypatch):
    monkeypatch.setattr(files, "KEPT_VERSIONS", 3)
    table.merge(("2024-01-01", "a", 1))
    for v in range(5):
        table.merge(("2024-01-02", "b", v))
    started = table.frame()
    table.merge(("2024-01-01", "a", 2))
    assert content(started)[0] == ("2024-01-01", "a", 1)
    assert table.content()[0] == ("2024-01-01", "a", 2)


def test_running_query_keeps_its_version(table, monkeypatch):
    monkeypatch.setattr(files, "KEPT_VERSIONS", 3)
    table.merge(("2024-01-01", "a", 1), ("2024-01-02", "a", 0))
    started = table.frame()
    for v in (2, 3):
        table.merge(("2024-01-01", "a", v))
    assert content(started) == [("2024-01-01", "a", 1), ("2024-01-02", "a", 0)]
    for v in (4, 5, 6):
        table.merge(("2024-01-01", "a", v))
    assert table.folders() == [
        "p=2024-01-01/version=4", "p=2024-01-01/version=5", "p=2024-01-01/version=6",
        "p=2024-01-02/version=1"]
    assert table.content() == [("2024-01-01", "a", 6), ("2024-01-02", "a", 0)]


def beaten_by(monkeypatch, spark, table, *merges):
    """Let other writers commit between a merge's reading and its commit; counts the attempts."""
    commit, left, attempts = files._commit, list(merges), []

    def late(*args):
        attempts.append(args)
        if left:
            others = left.pop(0)
            with monkeypatch.context() as patch:
                patch.setattr(files, "_commit", commit)
                for rows_of_other in others:
                    table.merge(*rows_of_other)
        return commit(*args)

    monkeypatch.setattr(files, "_commit", late)
    return attempts


def test_two_writers_of_different_partitions_both_survive(table, spark, monkeypatch):
    table.merge(("2024-01-01", "a", 1), ("2024-01-02", "a", 2))
    attempts = beaten_by(monkeypatch, spark, table, [[("2024-01-02", "b", 20)], [("2024-01-03", "c", 3)]])
    table.merge(("2024-01-01", "b", 10))
    assert len(attempts) == 1
    assert files.current_versions(spark, table.path)[0] == 4
    assert table.content() == [("2024-01-01", "a", 1), ("2024-01-01", "b", 10), ("2024-01-02", "a", 2),
                               ("2024-01-02", "b", 20), ("2024-01-03", "c", 3)]


def test_loser_of_one_partition_merges_again(table, spark, monkeypatch):
    table.merge(("2024-01-01", "a", 1))
    attempts = beaten_by(monkeypatch, spark, table, [[("2024-01-01", "b", 2)]], [[("2024-01-01", "c", 3)]])
    table.merge(("2024-01-01", "a", 10))
    assert len(attempts) == 3
    assert table.content() == [("2024-01-01", "a", 10), ("2024-01-01", "b", 2), ("2024-01-01", "c", 3)]
    # Beaten attempts leave nothing behind.
    assert len(table.folders()) == 4


def test_writer_far_behind_merges_again(table, spark, monkeypatch):
    monkeypatch.setattr(files, "KEPT_VERSIONS", 3)
    table.merge(("2024-01-01", "a", 1))
    attempts = beaten_by(monkeypatch, spark, table, [[("2024-01-02", "b", v)] for v in range(4)])
    table.merge(("2024-01-01", "a", 2))
    assert len(attempts) == 2
    assert table.content() == [("2024-01-01", "a", 2), ("2024-01-02", "b", 3)]


def test_concurrent_writers(spark, table):
    table.merge(("2024-01-01", "start", 0))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: table.merge((f"2024-01-0{1 + i % 3}", f"k{i}", i)), range(8)))
    assert {(k, v) for _, k, v in table.content()} == {("start", 0)} | {(f"k{i}", i) for i in range(8)}
    assert files.current_versions(spark, table.path)[0] == 9


def test_a_number_is_given_once(spark, tmp_path):
    path = str(tmp_path / "t" / "_current" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: files.create_exclusively(spark, path, f"{i}" * 1000), range(16)))
    assert won.count(True) == 1
    assert files.text_of(spark, path) == f"{won.index(True)}" * 1000
    assert [f.name for f in (tmp_path / "t" / "_current").iterdir()] == ["1.json"]


def test_unfinished_list_is_no_merge(table, spark, tmp_path, monkeypatch):
    table.merge(("2024-01-01", "a", 1))
    unfinished = tmp_path / "table" / "_current" / "000000000002.json"
    unfinished.write_text('{"p=2024-01-01": ')
    assert table.content() == [("2024-01-01", "a", 1)]
    monkeypatch.setattr(files, "PATIENCE", 0.2)
    with pytest.raises(OSError, match="unfinished"):
        table.merge(("2024-01-01", "a", 2))
    unfinished.unlink()
    table.merge(("2024-01-01", "a", 2))
    assert table.content() == [("2024-01-01", "a", 2)]


def test_scope_withdraws_what_is_not_named(table, spark):
    table.merge(("2024-01-01", "a", 1), ("2024-01-01", "b", 2), ("2024-01-02", "a", 3),
                ("2024-01-03", "a", 4), (None, "a", 5))
    scope = rows(spark, ("2024-01-01", "", 0), ("2024-01-03", "", 0), (None, "", 0)).select("day")
    table.merge(("2024-01-01", "b", 20), ("2024-01-02", "c", 30), scope=scope)
    assert table.content() == [("2024-01-01", "b", 20), ("2024-01-02", "a", 3), ("2024-01-02", "c", 30)]
    # A partition without rows is named no more; others keep their files.
    assert table.versions() == {"p=2024-01-01": 2, "p=2024-01-02": 2}
    table.merge(scope=rows(spark, ("2024-01-02", "", 0)).select("day"))
    assert table.versions() == {"p=2024-01-01": 2}
    table.merge(("2024-01-02", "z", 1))
    assert table.content()[-1] == ("2024-01-02", "z", 1)


def test_scope_of_some_keys_only(table, spark):
    table.merge(("2024-01-01", "a", 1), ("2024-01-01", "b", 2))
    table.merge(scope=rows(spark, ("2024-01-01", "a", 0)).select("day", "k"))
    assert table.content() == [("2024-01-01", "b", 2)]


def test_create_tables(spark, tmp_path, windows):
    root = str(tmp_path)
    create_tables(spark, root)
    for name, declared in TABLES.items():
        empty = read_table(spark, root, name)
        assert empty.count() == 0
        assert empty.columns == [*declared.schema.fieldNames(), declared.partition]
    merge_table(spark, root, "live_metrics", windows([("2024-01-15 10:00:00", 1, 1.0)]))
    create_tables(spark, root)
    assert read_table(spark, root, "live_metrics").count() == 1


def test_partition_does_not_depend_on_the_session_zone(spark, tmp_path, windows):
    root = str(tmp_path)
    rows = windows([("2024-01-15 23:30:00", 1, 1.0)])
    merge_table(spark, root, "live_metrics", rows)
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        merge_table(spark, root, "live_metrics", rows)
    stored = read_table(spark, root, "live_metrics")
    assert [str(r.window_date) for r in stored.collect()] == ["2024-01-15"]
