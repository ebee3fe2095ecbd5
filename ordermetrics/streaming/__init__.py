from ordermetrics.streaming.changes import (
    compact_slots, read_changes, slots_before, write_changes,
)
from ordermetrics.streaming.dead_letters import start_dead_letters
from ordermetrics.streaming.event_log import read_dead_letters, read_order_log, start_order_log
from ordermetrics.streaming.live import (
    run_live_metrics, start_live_metrics, start_metrics_of_orders, window_sku_table,
)
from ordermetrics.streaming.monitor import ProgressLog, observed, rows_dropped_late
from ordermetrics.streaming.state import state_drift, state_totals
from ordermetrics.streaming.table_changes import start_daily_summary, start_table_changes

__all__ = [
    "ProgressLog", "compact_slots", "observed", "read_changes", "read_dead_letters", "read_order_log",
    "rows_dropped_late", "run_live_metrics", "slots_before", "start_daily_summary",
    "start_dead_letters", "start_live_metrics", "start_metrics_of_orders", "start_order_log",
    "start_table_changes", "state_drift", "state_totals", "window_sku_table", "write_changes",
]
