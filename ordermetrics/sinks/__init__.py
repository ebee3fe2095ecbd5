from ordermetrics.sinks.files import create_tables, merge_into, merge_table, read_table
from ordermetrics.sinks.jdbc import create_table_sql, merge_into_jdbc, merge_sql
from ordermetrics.sinks.publish import publish_orders

__all__ = [
    "create_table_sql", "create_tables", "merge_into", "merge_into_jdbc", "merge_sql",
    "merge_table", "publish_orders", "read_table",
]
