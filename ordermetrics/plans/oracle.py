"""The registered queries as SQL over the same tables, written independently of the plans."""

from __future__ import annotations

from ordermetrics.plans.catalog import REPORT_DAY

FEED = """
WITH feed AS (
  SELECT event_id,
         CAST(event_id AS VARCHAR) AS order_id,
         'CUST-' || CAST(user_id AS VARCHAR) AS customer_id,
         event_type AS sku,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1 AS quantity,
         value AS price,
         epoch_us(ts) // 1000 AS millis
  FROM events
), valid AS (
  SELECT *, quantity * price AS revenue, make_timestamp_ms(millis) AS event_time,
         date_trunc('minute', make_timestamp_ms(millis)) AS window_start
  FROM feed WHERE event_id % 50 <> 0
)"""


def _metrics(name: str, orders: str) -> str:
    """CTEs ``<name>_sku`` and ``<name>`` with the window rows of the CTE ``orders``."""
    return f""", {name}_sku AS (
  SELECT window_start, sku, sum(revenue) AS sku_total_revenue, count(*) AS sku_order_count
  FROM {orders} GROUP BY ALL
), {name}_top AS (
  SELECT window_start, sku AS top_sku FROM (
    SELECT *, row_number() OVER (
      PARTITION BY window_start
      ORDER BY round(sku_total_revenue, 6) DESC NULLS LAST, sku ASC NULLS LAST) AS rank
    FROM {name}_sku)
  WHERE rank = 1
), {name} AS (
  SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end,
         coalesce(t.revenue, 0.0) AS total_revenue, t.n AS order_count, top_sku
  FROM (SELECT window_start, sum(revenue) AS revenue, count(*) AS n
        FROM {orders} GROUP BY window_start) t
  LEFT JOIN {name}_top USING (window_start)
)"""


LIVE = FEED + _metrics("live", "valid")

HOURS = """
  SELECT CAST(window_start AS DATE) AS d, CAST(hour(window_start) AS INTEGER) AS hour,
         CAST(sum(order_count) AS BIGINT) AS hourly_orders, sum(total_revenue) AS hourly_revenue
  FROM {table} GROUP BY ALL"""

HOURLY = LIVE + f""", hourly AS ({HOURS.format(table="live")}
), stats AS (
  SELECT d, avg(hourly_orders) AS mean, stddev_pop(hourly_orders) AS stddev,
         avg(hourly_revenue) AS revenue_mean, stddev_pop(hourly_revenue) AS revenue_stddev
  FROM hourly GROUP BY d
)"""

# The damaged feed as text, and what is wrong with each message according to JSON functions.
DAMAGED = """
WITH parts AS (
  SELECT event_id, ts, event_id // 50 % 11 AS turn,
         '"order_id":"' || event_id || '"' AS f0, '"customer_id":"CUST-' || user_id || '"' AS f1,
         '"sku":"' || event_type || '"' AS f2,
         '"quantity":' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1) AS f3,
         '"price":' || value AS f4, '"timestamp":' || (epoch_us(ts) // 1000) AS f5
  FROM events
), feed AS (
  SELECT event_id, ts, CASE
    WHEN event_id % 50 <> 0 THEN '{' || concat_ws(',', f0, f1, f2, f3, f4, f5) || '}'
    WHEN turn = 0 THEN NULL
    WHEN turn = 1 THEN '  '
    WHEN turn = 2 THEN '{' || concat_ws(',', f0, f1, f2) || ',BROKEN_JSON'
    WHEN turn = 3 THEN '17'
    WHEN turn = 4 THEN '[{' || concat_ws(',', f0, f1, f2, f3, f4, f5) || '}]'
    WHEN turn = 5 THEN '{' || concat_ws(',', f1, f2, f3, f4, f5) || '}'
    WHEN turn = 6 THEN '{' || concat_ws(',', f0, f1, f3, f4, f5) || '}'
    WHEN turn = 7 THEN '{' || concat_ws(',', f0, f1, f2, f4, f5) || '}'
    WHEN turn = 8 THEN '{' || concat_ws(',', f0, f1, f2, f3, f5) || '}'
    WHEN turn = 9 THEN '{' || concat_ws(',', f0, f1, f2, f3, f4) || '}'
    ELSE '{' || concat_ws(',', f0, f1, f2, f3, f4, '"timestamp":100000000000000000') || '}' END AS body
  FROM parts
), read AS (
  SELECT *, CASE WHEN json_valid(body) THEN body END AS doc FROM feed
), judged AS (
  SELECT *, CASE
    WHEN body IS NULL THEN 'null_payload'
    WHEN trim(body) = '' THEN 'empty_payload'
    WHEN doc IS NULL THEN 'malformed_json'
    WHEN json_type(doc) <> 'OBJECT' THEN 'not_an_object'
    WHEN json_extract_string(doc, '$.order_id') IS NULL THEN 'missing_order_id'
    WHEN json_extract_string(doc, '$.sku') IS NULL THEN 'missing_sku'
    WHEN json_extract_string(doc, '$.quantity') IS NULL THEN 'missing_quantity'
    WHEN json_extract_string(doc, '$.price') IS NULL THEN 'missing_price'
    WHEN json_extract_string(doc, '$.timestamp') IS NULL THEN 'missing_timestamp'
    WHEN CAST(json_extract_string(doc, '$.timestamp') AS HUGEINT) > 253402300799999
      THEN 'time_out_of_range' END AS reason
  FROM read
), letters AS (  -- without an id no order; the strict reading refuses the others too
  SELECT event_id, ts, reason, reason IN ('null_payload', 'empty_payload', 'malformed_json',
    'not_an_object', 'missing_order_id') AS dead FROM judged
)"""


def _exact(name: str, columns: str) -> str:
    """Windows and SKUs from sums of DECIMAL, without rounding."""
    return FEED + f""", exact AS (
  SELECT window_start, sku, CAST(revenue AS DECIMAL(28, 6)) AS revenue FROM valid
), sku_totals AS (
  SELECT window_start, sku, sum(revenue) AS sku_total_revenue, count(*) AS n FROM exact GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY window_start ORDER BY sku_total_revenue DESC NULLS LAST, sku ASC NULLS LAST) AS INTEGER) AS rank
  FROM sku_totals
), windows AS (
  SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end,
         coalesce(sum(sku_total_revenue), 0) AS total_revenue, CAST(sum(n) AS BIGINT) AS order_count,
         max(sku) FILTER (WHERE rank = 1) AS top_sku
  FROM ranked GROUP BY window_start
)
SELECT {columns} FROM {name}"""


LIVE_ROWS = """
SELECT window_start, window_end, round(total_revenue, 2) AS total_revenue, order_count, top_sku
FROM {table}"""


def _daily(table: str) -> str:
    return f"""
SELECT CAST(window_start AS DATE) AS summary_date,
       CAST(sum(order_count) AS BIGINT) AS total_orders,
       round(sum(total_revenue), 2) AS total_revenue,
       round(CASE WHEN sum(order_count) > 0
             THEN sum(total_revenue) / sum(order_count) ELSE 0.0 END, 2) AS avg_order_value
FROM {table}"""


def oracle_catalog() -> dict[str, str]:
    live_rows = LIVE_ROWS.format(table="live")
    one_day = (f" WHERE window_start >= TIMESTAMP '{REPORT_DAY}'"
               f" AND window_start < TIMESTAMP '{REPORT_DAY}' + INTERVAL 1 DAY")
    days = LIVE + _daily("live") + " GROUP BY 1"
    dead = "SELECT event_id FROM events WHERE event_id % 50 = 0"
    return {
        "payload_decode": """
SELECT event_id, props AS json_str, CAST(length(props) AS INTEGER) AS n_chars FROM events""",
        "json_parse": FEED + """
SELECT event_id,
       CASE WHEN event_id % 50 <> 0 THEN order_id END AS order_id,
       CASE WHEN event_id % 50 <> 0 THEN sku END AS sku,
       CASE WHEN event_id % 50 <> 0 THEN quantity END AS quantity,
       CASE WHEN event_id % 50 <> 0 THEN price END AS price,
       CASE WHEN event_id % 50 <> 0 THEN millis END AS "timestamp"
FROM feed""",
        "valid_orders": FEED + "\nSELECT order_id, sku, quantity, price FROM valid",
        "dead_letters": dead,
        "dead_letter_reasons": DAMAGED + """
SELECT event_id, reason FROM letters WHERE dead""",
        "dead_letter_reasons_strict": DAMAGED + """
SELECT event_id, reason FROM letters WHERE reason IS NOT NULL""",
        "message_counts": DAMAGED + """
SELECT count(*) AS n_read, count(*) FILTER (WHERE dead IS NOT TRUE) AS n_valid,
       count(*) FILTER (WHERE dead) AS n_dead,
       count(*) FILTER (WHERE reason IN ('missing_timestamp', 'time_out_of_range')) AS n_timeless,
       count(*) FILTER (WHERE dead IS NOT TRUE AND
         (reason IS NULL OR reason NOT IN ('missing_timestamp', 'time_out_of_range'))) AS n_in_windows
FROM letters""",
        "order_json_encode": FEED + """
SELECT event_id, customer_id, round(price, 2) AS price FROM feed""",
        "event_time": FEED + "\nSELECT order_id, event_time FROM valid",
        "revenue_projection": FEED + "\nSELECT order_id, round(revenue, 2) AS revenue FROM valid",
        "tumbling_window": FEED + """
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end,
       round(coalesce(sum(revenue), 0.0), 2) AS total_revenue, count(*) AS order_count
FROM valid GROUP BY window_start""",
        "window_sku_list": FEED + """
SELECT window_start, CAST(len(list({'sku': sku, 'revenue': revenue})) AS BIGINT) AS n_pairs,
       round(list_sum(list(coalesce(revenue, 0.0))), 2) AS pair_revenue
FROM valid GROUP BY window_start""",
        "sku_explode": FEED + """
SELECT window_start, sku, round(revenue, 2) AS revenue FROM valid""",
        "window_sku_revenue": LIVE + """
SELECT window_start, sku, round(sku_total_revenue, 2) AS sku_total_revenue FROM live_sku""",
        "sku_rank": LIVE + """
SELECT window_start, sku, CAST(row_number() OVER (
         PARTITION BY window_start
         ORDER BY round(sku_total_revenue, 6) DESC NULLS LAST, sku ASC NULLS LAST
       ) AS INTEGER) AS rank
FROM live_sku""",
        "top_sku": LIVE + "\nSELECT window_start, window_end, top_sku FROM live",
        "live_metrics": LIVE + live_rows,
        "live_metrics_joined": LIVE + live_rows,
        "live_metrics_exact": _exact(
            "windows", "window_start, window_end, total_revenue, order_count, top_sku"),
        "sku_rank_exact": _exact("ranked", "window_start, sku, sku_total_revenue, rank"),
        "latest_windows": LIVE + live_rows + " ORDER BY window_start DESC NULLS LAST LIMIT 5",
        "part_daily_top": """
WITH per_part AS (
  SELECT CAST(l_shipdate AS DATE) AS ship_day, l_partkey AS part,
         sum(l_extendedprice) AS part_revenue, count(*) AS n
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY ship_day
    ORDER BY round(part_revenue, 6) DESC NULLS LAST, part ASC NULLS LAST) AS rank
  FROM per_part
)
SELECT ship_day, round(coalesce(sum(part_revenue), 0.0), 2) AS revenue,
       CAST(sum(n) AS BIGINT) AS n_lines, max(part) FILTER (WHERE rank = 1) AS top_part
FROM ranked GROUP BY ship_day""",
        "day_filter": LIVE + live_rows + one_day,
        "daily_summary": LIVE + _daily("live") + one_day + " GROUP BY 1",
        "daily_summary_all": days,
        "hourly_orders": HOURLY + "\nSELECT d, hour, hourly_orders FROM hourly",
        "hourly_stats": HOURLY + """
SELECT d, round(mean, 6) AS mean, round(stddev, 6) AS stddev FROM stats""",
        "anomaly_bounds": HOURLY + """
SELECT d, round(mean - 2 * stddev, 6) AS expected_low, round(mean + 2 * stddev, 6) AS expected_high
FROM stats""",
        "hourly_anomalies": HOURLY + """
SELECT d AS detected_date, hour, 'hourly_order_count' AS metric,
       CAST(hourly_orders AS DOUBLE) AS value,
       round(mean - 2 * stddev, 6) AS expected_low, round(mean + 2 * stddev, 6) AS expected_high
FROM hourly JOIN stats USING (d)
WHERE stddev > 0 AND abs(hourly_orders - mean) > 2 * stddev""",
        "hourly_revenue_anomalies": HOURLY + """
SELECT d AS detected_date, hour, 'hourly_revenue' AS metric, round(hourly_revenue, 2) AS value,
       round(revenue_mean - 2 * revenue_stddev, 2) AS expected_low,
       round(revenue_mean + 2 * revenue_stddev, 2) AS expected_high
FROM hourly JOIN stats USING (d)
WHERE revenue_stddev > 0 AND abs(hourly_revenue - revenue_mean) > 2 * revenue_stddev""",
        "anomaly_count": HOURLY + """
SELECT d, count(*) FILTER (WHERE stddev > 0 AND abs(hourly_orders - mean) > 2 * stddev) AS flagged
FROM hourly JOIN stats USING (d) GROUP BY d""",
        "daily_report": HOURLY + """, days AS (""" + _daily("live") + """ GROUP BY 1
), odd AS (
  SELECT d, mean - 2 * stddev AS low, mean + 2 * stddev AS high,
         count(*) FILTER (WHERE stddev > 0 AND abs(hourly_orders - mean) > 2 * stddev) AS flagged
  FROM hourly JOIN stats USING (d) GROUP BY ALL
)
SELECT d, printf('%s: %d orders, revenue %.2f, average %.2f; %d odd hours (expected %.1f to %.1f)',
                 CAST(d AS VARCHAR), total_orders, total_revenue, avg_order_value, flagged,
                 round(low, 1) + 0.0, round(high, 1) + 0.0) AS line  -- no negative zero
FROM days JOIN odd ON d = summary_date""",
        "merge_live_metrics": LIVE + """
, early_orders AS (SELECT * FROM valid WHERE sku <> 'purchase'
)""" + _metrics("early", "early_orders") + """
, later AS (
  SELECT * FROM live WHERE window_start IN (SELECT window_start FROM valid WHERE sku = 'purchase')
), merged AS (
  SELECT coalesce(u.window_start, t.window_start) AS window_start,
         coalesce(u.window_end, t.window_end) AS window_end,
         CASE WHEN u.window_start IS NULL THEN t.total_revenue ELSE u.total_revenue END AS total_revenue,
         CASE WHEN u.window_start IS NULL THEN t.order_count ELSE u.order_count END AS order_count,
         CASE WHEN u.window_start IS NULL THEN t.top_sku ELSE u.top_sku END AS top_sku
  FROM early t FULL JOIN later u ON t.window_start = u.window_start
)""" + LIVE_ROWS.format(table="merged"),
        "merge_daily_summary": LIVE + """
, early_orders AS (SELECT * FROM valid WHERE sku <> 'purchase'
)""" + _metrics("early", "early_orders") + f"""
, t AS ({_daily("early")} GROUP BY 1), u AS ({_daily("live")}
  WHERE window_start >= TIMESTAMP '{REPORT_DAY}' GROUP BY 1)
SELECT coalesce(u.summary_date, t.summary_date) AS summary_date,
       coalesce(u.total_orders, t.total_orders) AS total_orders,
       coalesce(u.total_revenue, t.total_revenue) AS total_revenue,
       coalesce(u.avg_order_value, t.avg_order_value) AS avg_order_value
FROM t FULL JOIN u ON t.summary_date = u.summary_date""",
        "merge_anomalies": HOURLY + """
, early_orders AS (SELECT * FROM valid WHERE sku <> 'purchase'
)""" + _metrics("early", "early_orders") + f"""
, early_hourly AS ({HOURS.format(table="early")}
), early_stats AS (
  SELECT d, avg(hourly_orders) AS mean, stddev_pop(hourly_orders) AS stddev
  FROM early_hourly GROUP BY d
), settled AS (  -- a day's flags are those of the last run that had hours of that day
  SELECT d, hour, hourly_orders, mean, stddev FROM hourly JOIN stats USING (d)
  UNION ALL
  SELECT d, hour, hourly_orders, mean, stddev FROM early_hourly JOIN early_stats USING (d)
  WHERE d NOT IN (SELECT d FROM hourly)
)
SELECT d AS detected_date, hour, 'hourly_order_count' AS metric,
       CAST(hourly_orders AS DOUBLE) AS value,
       round(mean - 2 * stddev, 6) AS expected_low, round(mean + 2 * stddev, 6) AS expected_high
FROM settled WHERE stddev > 0 AND abs(hourly_orders - mean) > 2 * stddev""",
        "reconcile_drift": LIVE + """
, seen_orders AS (
  SELECT sku, revenue,
         CASE WHEN sku = 'signup' THEN window_start + INTERVAL 1 MINUTE ELSE window_start END
           AS window_start
  FROM valid WHERE sku <> 'purchase'
)""" + _metrics("seen", "seen_orders") + """
SELECT coalesce(s.window_start, a.window_start) AS window_start,
       coalesce(s.window_end, a.window_end) AS window_end,
       CASE WHEN s.window_start IS NULL THEN 'missing'
            WHEN a.window_start IS NULL THEN 'extra' ELSE 'different' END AS status,
       round(s.total_revenue, 2) AS stored_revenue, round(a.total_revenue, 2) AS actual_revenue,
       s.order_count AS stored_count, a.order_count AS actual_count,
       s.top_sku AS stored_top_sku, a.top_sku AS actual_top_sku
FROM seen s FULL JOIN live a ON s.window_start = a.window_start
WHERE s.window_start IS NULL OR a.window_start IS NULL
   OR abs(s.total_revenue - a.total_revenue) >= 0.005
   OR s.order_count <> a.order_count OR s.top_sku IS DISTINCT FROM a.top_sku""",
        "repair_live_metrics": LIVE + live_rows,
        "stream_live_metrics": LIVE + live_rows,
        "stream_dedup": LIVE + live_rows,
        "stream_daily_summary": days,
        "stream_dead_letters": dead,
        "stream_order_log": DAMAGED + """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS "of", count(*) AS n FROM letters
WHERE dead IS NOT TRUE AND (reason IS NULL OR reason NOT IN ('missing_timestamp', 'time_out_of_range'))
GROUP BY 1
UNION ALL SELECT reason, count(*) FROM letters WHERE dead GROUP BY 1""",
    }
