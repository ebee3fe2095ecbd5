"""Keyed tables in a database.

Rows go from the executors to a staging table in parallel; one statement in the
database then merges it into the target. No row passes through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermetrics.session import pin_utc

# SQL column types of the tables; sums of money are NUMERIC at this border only.
SQL_TYPES = {
    T.TimestampType: "TIMESTAMP", T.DateType: "DATE", T.StringType: "TEXT",
    T.LongType: "BIGINT", T.IntegerType: "INT", T.DoubleType: "NUMERIC",
}


def create_table_sql(table: str, schema: T.StructType, keys: list[str]) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the key; ``flagged_at`` defaults to now."""
    columns = []
    for field in schema:
        default = " DEFAULT CURRENT_TIMESTAMP" if field.name == "flagged_at" else ""
        columns.append(f"{field.name} {SQL_TYPES[type(field.dataType)]}{default}")
    columns.append(f"PRIMARY KEY ({', '.join(keys)})")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def merge_sql(table: str, staging: str, columns: list[str], keys: list[str]) -> str:
    """Insert the staged rows, overwriting rows with equal keys."""
    names = ", ".join(columns)
    changes = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {changes}"
    )


def withdraw_sql(table: str, staging: str, scoped: str, keys: list[str], scope: list[str]) -> str:
    """Delete rows within the staged scope that the staged rows do not name."""
    within = " AND ".join(f"{scoped}.{c} = {table}.{c}" for c in scope)
    named = " AND ".join(f"{staging}.{c} = {table}.{c}" for c in keys)
    return (
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {scoped} WHERE {within}) "
        f"AND NOT EXISTS (SELECT 1 FROM {staging} WHERE {named})"
    )


def execute(spark: SparkSession, options: dict[str, str], *statements: str) -> None:
    """Run statements in one transaction over a connection of the Spark driver.

    Spark has registered the database driver by then: the staging write comes first.
    """
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        if key not in ("url", "driver"):
            properties.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    finally:
        connection.close()


def utc_wall_times(rows: DataFrame) -> DataFrame:
    """Timestamps as UTC wall times, which no zone of the host or the database shifts."""
    pin_utc(rows.sparkSession)
    return rows.select(*(
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else f.name for f in rows.schema))


def merge_into_jdbc(
    spark: SparkSession, updates: DataFrame, options: dict[str, str], table: str,
    keys: list[str], batch_id: int = 0, max_connections: int = 16, scope: DataFrame | None = None,
) -> None:
    """Merge ``updates`` into a database table. Repeating a batch changes nothing.

    ``options`` holds ``url``, credentials and optionally ``driver``. The table is created
    where it does not exist. Each call has staging tables of its own, which go whether
    the merge succeeds or not; a lost driver leaves them behind. ``scope`` is as in
    ``merge_into``; removal and upsert are one transaction.
    """
    staging = f"{table}_incoming_{batch_id}_{uuid.uuid4().hex[:12]}"
    properties = {k: v for k, v in options.items() if k != "url"}
    # A shuffle of few rows; coalesce would also compute them on so few tasks.
    utc_wall_times(updates).repartition(max_connections).write.mode("overwrite").jdbc(
        options["url"], staging, properties=properties
    )
    scoped, statements = f"{staging}_scope", [create_table_sql(table, updates.schema, keys)]
    staged = [staging]
    try:
        if scope is not None:
            utc_wall_times(scope).coalesce(1).write.mode("overwrite").jdbc(
                options["url"], scoped, properties=properties)
            staged.append(scoped)
            statements.append(withdraw_sql(table, staging, scoped, keys, scope.columns))
        execute(spark, options, *statements, merge_sql(table, staging, updates.columns, keys))
    finally:
        execute(spark, options, *(f"DROP TABLE {name}" for name in staged))
