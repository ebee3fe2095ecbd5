from ordermetrics.operators.daily import (
    anomaly_counts, daily_report, daily_summary, day_filter, hourly_anomalies, hourly_totals,
)
from ordermetrics.operators.drift import drift_report
from ordermetrics.operators.merge import latest_per_key, merge_rows
from ordermetrics.operators.outliers import expected_range, flag_outliers, value_stats
from ordermetrics.operators.parse import (
    counted, dead_letter_reasons, dead_letters, exact_revenue, parse_orders, valid_orders,
)
from ordermetrics.operators.windows import (
    attach_top_sku, explode_sku_lists, latest_windows, live_metrics, rank_skus, roll_up,
    sku_revenue_lists, top_sku, window_sku_totals, window_totals,
)

__all__ = [
    "anomaly_counts", "attach_top_sku", "counted", "daily_report", "daily_summary", "day_filter",
    "dead_letter_reasons", "dead_letters", "drift_report", "exact_revenue", "expected_range",
    "explode_sku_lists", "flag_outliers", "hourly_anomalies", "hourly_totals",
    "latest_per_key", "latest_windows", "live_metrics", "merge_rows", "parse_orders",
    "rank_skus", "roll_up", "sku_revenue_lists", "top_sku", "valid_orders", "value_stats",
    "window_sku_totals", "window_totals",
]
