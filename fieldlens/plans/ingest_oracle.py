"""DuckDB SQL of the ingest queries, stated as results: what a merge, a reload or a sink leaves behind."""

from __future__ import annotations

from fieldlens.plans.oracle_roles import with_roles as W

_DURATION = "date_diff('microsecond', enroute_time, clear_time) / 60000000.0"
SQL: dict[str, str] = {
    "window_scan_business": W("run_header") + """
SELECT leg_id, source_database, created, pickup_time, policy FROM run_header, (VALUES ('modified'), ('business')) p(policy)
WHERE CASE policy WHEN 'modified' THEN created ELSE pickup_time END BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-31 23:59:59.999999'""",
    "keyed_periods": W("shifts", "periods") + """,
own AS (SELECT s.*, CASE source_database WHEN 'src1' THEN 7 ELSE 0 END AS off FROM shifts s)
SELECT assignment_id, source_database, date_line, pay_period_number, start_date + off AS pay_period_start,
  CASE WHEN start_date IS NOT NULL THEN IF(date_line - (start_date + off) < 7, 1, 2) END AS period_week
FROM own LEFT JOIN periods p ON date_line - off BETWEEN p.start_date AND p.end_date""",
    "upsert_refresh": """
SELECT event_id, ts, user_id, event_type, IF(ts >= TIMESTAMP '2024-01-24', round(value + 1, 2), value) AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN TIMESTAMP '2024-02-01 06:00:00' END AS refreshed_at FROM events""",
    "reconcile_merge": W("run_header") + "SELECT leg_id, source_database, service_date, last_status_id FROM run_header",
    "sinks_read_back": W("runs") + f""",
bad AS (SELECT leg_id FROM runs WHERE {_DURATION} < 0 OR {_DURATION} > 720)
SELECT sink, CASE sink WHEN 'quarantine' THEN (SELECT count(*) FROM bad) ELSE (SELECT count(*) FROM runs) END AS row_count,
  CASE sink WHEN 'quarantine' THEN (SELECT count(DISTINCT leg_id) FROM bad) ELSE (SELECT count(DISTINCT leg_id) FROM runs) END AS legs
FROM (VALUES ('replace'), ('quarantine'), ('mart'), ('report')) v(sink)""",
    "report_sorted": W("report_shifts") + """
SELECT region, pay_period_start, assignment_id, is_open, CAST(row_number() OVER (PARTITION BY region, pay_period_start
  ORDER BY IF(is_open, 0, 1), shift_start NULLS LAST, assigned_name NULLS LAST, assignment_id) AS INTEGER) AS place FROM report_shifts""",
    "backfill": """
SELECT event_id, ts, event_type, CAST(DATE '2024-01-03' + 7 * (date_diff('day', DATE '2024-01-03', CAST(ts AS DATE)) // 7)::INTEGER AS DATE) AS chunk_start
FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-24'""",
    "stored_cursor": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "quality_run": W("runs") + f""",
f AS (SELECT 'invalid_durations' AS rule, count(*) FILTER ({_DURATION} < 0 OR {_DURATION} > 720) AS failures, 'warn' AS at_worst FROM runs
  UNION ALL SELECT 'missing_clear_time', count(*) FILTER (clear_time IS NULL), 'error' FROM runs UNION ALL SELECT 'missing_leg', count(*) FILTER (leg_id IS NULL), 'error' FROM runs)
SELECT rule, '2024-02-01' AS run_id, failures, IF(failures > 0, at_worst, 'pass') AS severity, failures AS stored_rows FROM f""",
    "day_model": """
SELECT CAST(ts AS DATE) AS event_day, event_type, count(*) AS events, count(DISTINCT user_id) AS users, round(sum(value), 4) AS value_sum
FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL""",
    "measures": W("run_header") + """
SELECT leg_id, service_date, CAST(weekofyear(service_date) AS INTEGER) AS iso_week, CAST(isoyear(service_date) AS INTEGER) AS iso_year,
  round(mileage * 1000.0 / 1609.344, 4) AS miles FROM run_header WHERE mileage * 1000.0 > 100000""",
}
