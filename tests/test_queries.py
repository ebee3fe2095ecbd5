"""Every registered query against its SQL, and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import TESTDATA
from ordermetrics.plans import oracle_catalog, query_catalog

SF = TESTDATA / "sf0.01"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert query_catalog().keys() == oracle_catalog().keys()
    assert entry_points.queries().keys() >= query_catalog().keys()


@pytest.mark.parametrize("name", query_catalog())
def test_query_equals_sql(spark, db, name):
    frame = entry_points.queries()[name](spark, str(SF))
    columns = sorted(frame.columns)
    expected = db.sql(entry_points.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    selected = ", ".join(f'"{c}"' for c in columns)
    want = sorted(map(str, db.sql(f"SELECT {selected} FROM expected").fetchall()))
    got = sorted(str(tuple(row)) for row in frame.select(*columns).collect())
    assert got == want and got


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "window_start", "window_end", "total_revenue", "order_count", "top_sku"]
    assert entry_points.entry(spark).count() > 900
