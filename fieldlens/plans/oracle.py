"""Oracle SQL (DuckDB) for each registered query: an independent formulation over the
same parquet tables, used by the correctness check."""

from __future__ import annotations

from fieldlens.plans.oracle_roles import (hrs, level_sql, mins, region_cc_sql, region_market_sql, rn,
                                          sunday_week, with_roles)

W = with_roles
SQL: dict[str, str] = {}


def r4(x: str) -> str:
    return f"round({x}, 4)"


def tally(source: str, keys: str, counts: dict[str, str], sums: dict[str, tuple[str, str]] | None = None) -> str:
    """One row per ``keys`` of ``source``: for each name the number of rows where its condition
    holds, and for each name of ``sums`` the total of a value over such rows (0 if none).
    Every row is turned into the list of names it counts for, and these are counted."""
    marks = [f"{{'m': '{n}', 'v': CASE WHEN {c} THEN 1.0 END}}" for n, c in counts.items()]
    marks += [f"{{'m': '{n}', 'v': CASE WHEN {c} THEN CAST({v} AS DOUBLE) END}}" for n, (c, v) in (sums or {}).items()]
    wide = [f"CAST(COALESCE(sum(e.v) FILTER (WHERE e.m = '{n}'), 0) AS BIGINT) AS {n}" for n in counts]
    wide += [f"COALESCE(sum(e.v) FILTER (WHERE e.m = '{n}'), 0.0) AS {n}" for n in sums or {}]
    return f"SELECT {keys}, {', '.join(wide)} FROM (SELECT {keys}, unnest([{', '.join(marks)}]) AS e FROM {source}) x GROUP BY {keys}"


SQL["distinct_on"] = W("revisions") + """
SELECT leg_id, rev, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM revisions"""

SQL["current_revision"] = W("stage_times") + """
SELECT leg_id, rev, source_database, service_date, l_partkey, l_quantity FROM stage_times"""

SQL["revision_full_join"] = W("run_header") + """
SELECT COALESCE(h.leg_id, r.leg_id) AS leg_id, COALESCE(h.rev, r.rev) AS rev, h.run_number, h.service_date,
       r.l_partkey, r.l_quantity
FROM run_header h FULL OUTER JOIN revisions r ON h.leg_id = r.leg_id AND h.rev = r.rev"""

SQL["star_enrich"] = W("stage_times", "cost_centers", "source_zones") + """
SELECT st.leg_id, st.rev, p.p_type, p.p_brand, s.s_name, n.n_name AS supplier_nation, r.r_name AS supplier_region, c.c_name, cn.n_name AS customer_nation, cr.r_name AS customer_region,
       st.market, st.calltype_name, z.local_tz, v.name AS cancel_reason_name, cc.cost_center_id,
       CAST(date_diff('day', DATE '1994-12-25', st.service_date) // 14 + 1 AS INTEGER) AS pay_period_number
FROM stage_times st
LEFT JOIN part p ON st.l_partkey = p.p_partkey
LEFT JOIN supplier s ON st.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN customer c ON st.user_id = c.c_custkey LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN region cr ON cr.r_regionkey = cn.n_regionkey
LEFT JOIN source_zones z ON z.source_database = st.source_database
LEFT JOIN (VALUES (0, 'No show'), (1, 'Weather'), (2, 'Facility closed'), (3, 'Duplicate')) v(id, name) ON v.id = st.canceled_reason_id
LEFT JOIN cost_centers cc ON cc.cost_center_name = p.p_type AND cc.source_database = st.source_database"""

SQL["union_sources"] = """
SELECT c_custkey AS user_id, 'src' || CAST(c_custkey % 3 AS VARCHAR) AS source_database, c_name AS username,
       c_mktsegment AS job_title, CAST(c_custkey AS VARCHAR) || '_src' || CAST(c_custkey % 3 AS VARCHAR) AS user_id_source
FROM customer"""

SQL["window_scan"] = """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'"""

SQL["values_allowlist"] = W("shifts", "valid_cost_centers") + """
SELECT s.assignment_id, s.source_database, s.cost_center_id, s.cost_center_name, v.special_event
FROM shifts s JOIN valid_cost_centers v ON (s.cost_center_id, s.source_database) = (v.cost_center_id, v.source_database)"""

SQL["region_classify"] = W("run_header", "shifts") + f"""
SELECT 'run' AS entity, leg_id AS entity_id, source_database, market AS rule_input, {region_market_sql()} AS region,
  CASE WHEN source_database IN ('src0', 'src1') THEN source_database WHEN market = 'america' THEN source_database || '_west' WHEN market = 'europe' THEN source_database || '_east' END AS division
FROM run_header
UNION ALL
SELECT 'shift', assignment_id, source_database, cost_center_name, {region_cc_sql()}, NULL FROM shifts"""

SQL["level_from_name"] = W("shifts") + f"""
SELECT assignment_id, cost_center_name, {level_sql()} AS level_of_service FROM shifts"""

SQL["case_outcome"] = W("runs") + """
SELECT leg_id, source_database, last_status_id, lost_call_status, run_outcome, day_of_week, hour_of_day FROM runs"""

_STAGES = [
    ("call_to_assignment_minutes", "assigned_time", "call_started_time"),
    ("assignment_to_ack_minutes", "acknowledged_time", "assigned_time"),
    ("ack_to_enroute_minutes", "enroute_time", "acknowledged_time"),
    ("enroute_to_scene_minutes", "at_scene_time", "enroute_time"),
    ("scene_time_minutes", "transporting_time", "at_scene_time"),
    ("transport_time_minutes", "at_destination_time", "transporting_time"),
    ("destination_to_clear_minutes", "clear_time", "at_destination_time"),
    ("total_call_duration_minutes", "clear_time", "call_started_time"),
    ("total_unit_time_minutes", "clear_time", "assigned_time"),
    ("response_time_minutes", "at_scene_time", "acknowledged_time"),
]
SQL["stage_durations"] = W("stage_times") + "SELECT leg_id, " + ", ".join(
    f"CASE WHEN {e} IS NOT NULL AND {s} IS NOT NULL THEN {r4(mins(e, s))} END AS {n}" for n, e, s in _STAGES
) + " FROM stage_times"

_TOT = mins("clear_time", "assigned_time")
_EXCL = f"({mins('transporting_time', 'at_scene_time')} + {mins('clear_time', 'at_destination_time')})"
SQL["time_on_task"] = W("stage_times") + f"""
SELECT leg_id, {r4(_TOT)} AS time_on_task_minutes, {r4(_EXCL)} AS time_on_task_excl_transport_minutes
FROM stage_times"""

SQL["valid_runs"] = W("stage_times") + f"""
SELECT leg_id, source_database, {r4(_TOT)} AS time_on_task_minutes FROM stage_times
WHERE canceled_time IS NULL AND assigned_time IS NOT NULL AND clear_time IS NOT NULL
  AND clear_time > assigned_time AND {_TOT} > 0 AND {_TOT} < 720"""

SQL["repair_duration"] = W("runs") + """
SELECT leg_id, round(mileage, 4) AS mileage, round(raw_time_on_task_minutes, 4) AS raw_time_on_task_minutes,
       round(time_on_task_minutes, 4) AS time_on_task_minutes FROM runs"""

SQL["run_flags"] = W("runs") + """
SELECT leg_id, is_long_distance, is_transport_run, is_critical_care, is_flight_crew,
       round(pickup_variance_minutes, 4) AS pickup_variance_minutes, is_on_time FROM runs"""

_DELAY = f"CASE WHEN at_scene_time IS NOT NULL AND pickup_time IS NOT NULL THEN greatest({mins('at_scene_time', 'pickup_time')}, 0.0) END"
SQL["otp"] = W("runs") + f"""
SELECT leg_id, region, calltype_name, CAST(date_trunc('week', pickup_time) AS DATE) AS pickup_week_start,
       {r4(_DELAY)} AS pickup_delay_minutes, ({_DELAY}) = 0 AS is_on_time_strict,
       ({_DELAY}) <= 15 AS is_on_time_grace
FROM runs WHERE run_outcome = 'ran' AND calltype_name IN ('ALS', 'BLS', 'CCT')"""

_SLA_BASE = f"""
sla AS (
  SELECT *, {mins('at_scene_time', 'anchor + to_minutes(threshold)')} AS minutes_from_sla,
         {mins('at_scene_time', 'anchor')} AS response
  FROM (SELECT *,
          COALESCE(requested_time, CASE WHEN emergency THEN pickup_time ELSE pickup_time + to_minutes(15) END) AS anchor,
          CASE WHEN emergency THEN 30 ELSE 60 END AS threshold,
          CASE WHEN emergency THEN 'Emergency' ELSE 'Non-Emergency' END AS call_type
        FROM (SELECT *, CASE WHEN leg_id % 4 = 0 THEN pickup_time - to_minutes(10) END AS requested_time
              FROM runs WHERE run_outcome = 'ran') a) b)
"""
SQL["sla_on_time"] = W("runs").rstrip() + "," + _SLA_BASE + """
SELECT leg_id, call_type, anchor AS sla_anchor_time, threshold AS sla_threshold_minutes,
       round(response, 4) AS sla_response_minutes, round(minutes_from_sla, 4) AS minutes_from_sla,
       CASE WHEN at_scene_time IS NULL THEN NULL ELSE minutes_from_sla <= 0 END AS is_sla_on_time
FROM sla"""

SQL["on_time_7row_ma"] = W("runs").rstrip() + "," + _SLA_BASE + """,
daily AS (
  SELECT date_of_service, COALESCE(call_type, 'Combined') AS call_type, count(*) AS total_calls,
         CAST(sum(CASE WHEN minutes_from_sla <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_calls
  FROM sla WHERE response IS NOT NULL AND response >= 0 AND response <= 120
  GROUP BY GROUPING SETS ((date_of_service, call_type), (date_of_service))),
pct AS (SELECT *, """ + rn("100.0 * on_time_calls / total_calls", 2) + """ AS on_time_percentage FROM daily)
SELECT date_of_service, call_type, total_calls, on_time_calls, on_time_percentage,
       """ + rn("CAST(sum(CAST(on_time_percentage AS DECIMAL(28,12))) OVER w AS DOUBLE) / count(on_time_percentage) OVER w", 2) + """ AS on_time_percentage_7day_ma,
       count(*) OVER w AS days_in_window
FROM pct
WINDOW w AS (PARTITION BY call_type ORDER BY date_of_service ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

SQL["daily_demand"] = W("runs") + """
SELECT region, date_of_service, count(*) AS total_calls,
       CAST(sum(CASE WHEN run_outcome IN ('ran', 'turned') THEN 1 ELSE 0 END) AS BIGINT) AS demand_calls,
       CAST(sum(CASE WHEN run_outcome = 'ran' THEN 1 ELSE 0 END) AS BIGINT) AS ran_count,
       CAST(sum(CASE WHEN run_outcome = 'turned' THEN 1 ELSE 0 END) AS BIGINT) AS turned_count,
       CAST(sum(CASE WHEN run_outcome = 'cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_count,
       CAST(dayofweek(date_of_service) AS INTEGER) AS day_of_week_num, dayname(date_of_service) AS day_of_week_name,
       CAST(month(date_of_service) AS INTEGER) AS month, CAST(year(date_of_service) AS INTEGER) AS year,
       dayofweek(date_of_service) IN (0, 6) AS is_weekend
FROM runs WHERE date_of_service IS NOT NULL GROUP BY region, date_of_service"""

_HAS = lambda *levels: "(" + " OR ".join(f"contains(upper(calltype_name), '{x}')" for x in levels) + ")"
SQL["daily_dashboard"] = W("runs") + f""",
d AS (
  SELECT *, CASE WHEN last_status_id IS NULL THEN 'cancelled' WHEN last_status_id < 0 THEN IF(lost_call_status IS NULL, 'cancelled', 'turned')
                 WHEN last_status_id > 0 AND {_HAS('ALS', 'BLS', 'CCT', 'SCT')} THEN 'ran' ELSE 'other' END AS o
  FROM runs WHERE date_of_service IS NOT NULL),
m AS ({tally('d', 'date_of_service, region', {
    'total_calls': 'TRUE', 'cancels': "o = 'cancelled'", 'turns': "o = 'turned'", 'total_transports': "o = 'ran'",
    'transports_als': f"o = 'ran' AND {_HAS('ALS')}", 'transports_bls': f"o = 'ran' AND {_HAS('BLS')}", 'transports_sct_cct': f"o = 'ran' AND {_HAS('SCT', 'CCT')}",
    'prescheduled_runs': "created + INTERVAL 9 HOUR < CAST(date_of_service AS TIMESTAMP)",
    'runs_over_50_miles': "o = 'ran' AND mileage > 50", 'scene_time_over_45_min': "o = 'ran' AND scene_time_minutes > 45",
    'destination_time_over_45_min': "o = 'ran' AND destination_to_clear_minutes > 45"})})
SELECT *, """ + ", ".join(f"COALESCE({rn(f'100.0 * {a} / NULLIF({b}, 0)', 1)}, 0.0) AS {n}" for n, a, b in (
    ("prescheduled_pct", "prescheduled_runs", "total_calls"), ("long_distance_pct", "runs_over_50_miles", "total_transports"),
    ("turn_rate_pct", "turns", "total_calls"), ("cancel_rate_pct", "cancels", "total_calls"))) + " FROM m"

SQL["demand_heatmap"] = W("runs") + """,
grid AS (
  SELECT lpad(CAST(h AS VARCHAR), 2, '0') || '00' AS hour_of_day, d AS day_of_week, dn
  FROM range(24) t(h) CROSS JOIN (VALUES ('Sunday', 1), ('Monday', 2), ('Tuesday', 3), ('Wednesday', 4),
                                         ('Thursday', 5), ('Friday', 6), ('Saturday', 7)) dd(d, dn)),
agg AS (
  SELECT hour_of_day, day_of_week, sum(CASE WHEN run_outcome = 'ran' THEN 1 ELSE 0 END) AS ran_count,
         sum(CASE WHEN run_outcome = 'turned' THEN 1 ELSE 0 END) AS turned_count, count(*) AS call_count
  FROM runs WHERE date_of_service >= DATE '2001-08-01' - INTERVAL 35 DAY AND date_of_service < DATE '2001-08-01'
  GROUP BY ALL)
SELECT g.hour_of_day, g.day_of_week,
       COALESCE(CAST(ceil(a.ran_count / 5.0) AS INTEGER), 0) AS avg_ran_count,
       COALESCE(CAST(ceil(a.turned_count / 5.0) AS INTEGER), 0) AS avg_turned_count,
       COALESCE(CAST(ceil(a.call_count / 5.0) AS INTEGER), 0) AS avg_call_count,
       CAST(g.hour_of_day AS INTEGER) AS xsort, dn AS ysort
FROM grid g LEFT JOIN agg a ON a.hour_of_day = g.hour_of_day AND a.day_of_week = g.day_of_week"""

# A shift counts if it is assigned, in one of the four regions and of a counted kind; hours by bucket.
_OPS_SHIFTS = """(SELECT s.*, u.job_title, COALESCE(s.actual_hours_worked, 0.0) AS h FROM shift_mart s LEFT JOIN users u USING (user_id, source_database)
  WHERE s.is_assigned AND s.shift_date IS NOT NULL AND list_contains(['west', 'east', 'south', 'middle'], s.region)
    AND (s.cost_center_name = 'PROMO' OR s.is_field_shift OR s.is_special_event OR s.is_orientation))"""
_BUCKETS = {
    "fully_loaded_hours": ("h > 0 AND (is_training OR is_orientation OR is_special_event OR is_field_shift)", "h"),
    "clean_labor_hours": ("h > 0 AND is_field_shift AND NOT (is_training OR is_orientation OR cost_center_name = 'PROMO')", "h"),
    "hours_worked_911": ("cost_center_name = 'PROMO'", "h"), "special_event_hours": ("is_special_event", "h"),
    "orientation_hours": ("is_training OR is_orientation", "h"),
    "emt_special_event_hours": ("is_special_event AND list_contains(['AUTOMOBILE', 'BUILDING'], job_title)", "h"),
    "medic_special_event_hours": ("is_special_event AND job_title = 'MACHINERY'", "h")}
_LABOUR = f"""
up AS (SELECT region, shift_date, unit_name, min(hour(shift_start)) AS first_hour, max(hour(shift_start)) AS last_hour
       FROM {_OPS_SHIFTS} x WHERE unit_name IS NOT NULL GROUP BY ALL),
lab AS ({tally(_OPS_SHIFTS + ' x', 'region, shift_date', {}, _BUCKETS)}),
labour AS (SELECT lab.*, COALESCE(u.am, 0) AS ambulances_up_am, COALESCE(u.pm, 0) AS ambulances_up_pm, COALESCE(u.n, 0) AS total_ambulances
           FROM lab LEFT JOIN ({tally('up', 'region, shift_date', {'am': 'first_hour < 12', 'pm': 'last_hour >= 19', 'n': 'TRUE'})}) u USING (region, shift_date))"""
_CARRIES = "run_outcome = 'ran' AND calltype_name IS NOT NULL AND calltype_name NOT IN ('Medicar', 'Standby - BLS')"
_RUN_COUNTS = {f"{n}_transports": f"run_outcome = 'ran' AND calltype_name = '{c}'" for n, c in (("bls", "BLS"), ("als", "ALS"), ("sct", "CCT"))} | {
    "flight_transports": "run_outcome = 'ran' AND calltype_name = 'Flight'", "total_transports": _CARRIES,
    "ldt_over_50_miles": f"{_CARRIES} AND mileage > 50", "calls_911": "region IN ('west', 'east') AND level_of_service = '1-URGENT'",
    "on_time_count": "run_outcome = 'ran' AND is_on_time", "on_time_eligible_count": "run_outcome = 'ran' AND is_on_time IS NOT NULL",
    "cancelled_calls": "run_outcome = 'cancelled'", "turned_calls": "run_outcome = 'turned'"}
_DAY_LABELS = """CASE region WHEN 'west' THEN 'Western Market' WHEN 'east' THEN 'Eastern Market' WHEN 'south' THEN 'Southern Market'
         WHEN 'middle' THEN 'Central Market' ELSE region END AS market_name, d AS report_date,
  strftime(d, '%m/%d/%Y') || chr(10) || dayname(d) AS report_date_display, CAST(year(d) AS INTEGER) AS report_year,
  CAST(month(d) AS INTEGER) AS report_month, strftime(d, '%B %Y') AS report_month_name, dayname(d) AS day_of_week, CAST(dayofweek(d) AS INTEGER) AS day_of_week_num"""
SQL["daily_operations"] = W("runs", "shift_mart", "users") + f""",{_LABOUR},
trips AS ({tally("(SELECT *, service_date AS d FROM runs WHERE service_date IS NOT NULL AND region IS NOT NULL) x", 'region, d', _RUN_COUNTS,
                 {'tot': (_CARRIES + ' AND time_on_task_minutes IS NOT NULL', 'time_on_task_minutes')})}),
days AS (SELECT region, d FROM trips UNION SELECT region, shift_date FROM labour)
SELECT region, {_DAY_LABELS},
  """ + ", ".join(f"COALESCE(l.{c}, 0) AS {c}" for c in ("ambulances_up_am", "ambulances_up_pm", "total_ambulances")) + ", " + ", ".join(
    f"COALESCE(t.{c}, 0) AS {c}" for c in _RUN_COUNTS) + ", " + ", ".join(f"round(COALESCE(l.{c}, 0.0), 4) AS {c}" for c in _BUCKETS) + """,
  round(t.on_time_count / NULLIF(t.on_time_eligible_count, 0), 4) AS on_time_percentage, round(COALESCE(t.tot, 0.0), 4) AS total_time_on_task_minutes,
  round(2 * (COALESCE(t.tot, 0.0) / 60.0) / NULLIF(l.clean_labor_hours, 0), 4) AS time_on_task_percent,
  round(2 * t.total_transports / NULLIF(l.fully_loaded_hours, 0), 4) AS fully_loaded_uhu, round(2 * t.total_transports / NULLIF(l.clean_labor_hours, 0), 4) AS clean_uhu
FROM days LEFT JOIN trips t USING (region, d) LEFT JOIN (SELECT *, shift_date AS d FROM labour) l USING (region, d)"""

SQL["match_intervals"] = W("matches") + """
SELECT source_database, assignment_id, user_id, scheduled_start, scheduled_end, date_line, time_id,
       clock_in_time, clock_out_time, effective_clock_out, has_timesheet, is_clocked_in, is_clocked_out, match_type
FROM matches"""

SQL["orphan_intervals"] = W("punch_local", "match_seats", "users") + """
SELECT p.source_database, p.time_user_id AS user_id, CAST(p.clock_in_time AS DATE) AS date_line, p.time_id,
       p.clock_in_time, p.clock_out_time,
       CASE WHEN p.time_end_ts <> 0 THEN p.clock_out_time END AS effective_clock_out,
       p.time_end_ts = 0 AS is_clocked_in, 'orphan' AS match_type
FROM punch_local p
WHERE EXISTS (SELECT 1 FROM users u WHERE u.user_id = p.time_user_id AND u.source_database = p.source_database)
  AND NOT EXISTS (
  SELECT 1 FROM match_seats s WHERE s.user_id IS NOT NULL AND s.user_id = p.time_user_id AND s.source_database = p.source_database
    AND (s.assignment_id = p.shift_assignment_id
         OR abs((epoch_us(s.shift_start) // 1000000) - p.time_start_ts) < 3600
         OR (p.time_start_ts >= epoch_us(s.shift_start) // 1000000
             AND p.time_start_ts < epoch_us(s.shift_end) // 1000000)))"""

# ---------------------------------------------------------------- shift + punch, staffing, periods

SQL["dedup_punches"] = W("schedule") + """
SELECT assignment_id, source_database, time_id, min(clock_in_time) AS clock_in_time FROM schedule GROUP BY ALL"""

SQL["schedule_fact"] = W("schedule", "periods") + """,
cur AS (SELECT start_date, end_date FROM periods WHERE start_date <= DATE '2024-01-25' ORDER BY start_date DESC LIMIT 1),
nxt AS (SELECT start_date, end_date FROM periods WHERE start_date > DATE '2024-01-25' ORDER BY start_date ASC LIMIT 1)
SELECT s.assignment_id, s.time_id, s.assignment_status, s.position_slot, s.required_qualification, s.min_licensure_id, s.min_level_id, s.earning_code, s.published,
       round(s.scheduled_hours, 4) AS scheduled_hours,
       round(s.open_hours, 4) AS open_hours, round(s.hours_worked, 4) AS hours_worked, s.has_timesheet,
       s.is_clocked_in, s.timesheet_match_type, p.pay_period_number, p.start_date AS pay_period_start,
       CASE WHEN p.start_date IS NOT NULL THEN CASE WHEN date_diff('day', p.start_date, s.date_line) < 7 THEN 1 ELSE 2 END END AS period_week,
       COALESCE(s.date_line >= (SELECT start_date FROM cur) AND s.date_line <= (SELECT end_date FROM cur), FALSE) AS is_current_pay_period,
       COALESCE(s.date_line >= (SELECT start_date FROM nxt) AND s.date_line <= (SELECT end_date FROM nxt), FALSE) AS is_next_pay_period,
       CAST(dayofweek(s.date_line) AS INTEGER) AS day_of_week, dayname(s.date_line) AS day_name,
       CAST(date_trunc('week', s.date_line) AS DATE) AS week_start, CAST(date_trunc('month', s.date_line) AS DATE) AS month_start,
       s.date_line = DATE '2024-01-25' AS is_today, s.date_line > DATE '2024-01-25' AS is_future,
       s.date_line >= DATE '2024-01-25' AS is_today_or_future,
       CAST(date_diff('day', DATE '2024-01-25', s.date_line) AS INTEGER) AS days_from_today
FROM schedule s LEFT JOIN periods p ON s.date_line BETWEEN p.start_date AND p.end_date"""

SQL["attendance_flags"] = W("seats") + """
SELECT assignment_id, user_id IS NULL AS is_open,
       user_id IS NOT NULL AND clock_in_time IS NULL AND date_line < DATE '2024-01-25' AS is_no_show,
       COALESCE(user_id IS NOT NULL AND hours_worked IS NOT NULL AND hours_worked < scheduled_hours * 0.9, FALSE) AS is_partial_shift
FROM seats"""

SQL["hours_fallback"] = W("seats") + f"""
SELECT assignment_id,
       round(CASE WHEN COALESCE(scheduled_hours, 0.0) = 0 THEN COALESCE({hrs('shift_end', 'shift_start')}, 0.0) ELSE scheduled_hours END, 4) AS report_hours
FROM seats"""

SQL["hours_variance"] = W("seats") + """
SELECT assignment_id, round(hours_worked, 4) AS hours_worked, hours_variance FROM seats"""

SQL["shift_flags"] = W("seats") + """
SELECT assignment_id, is_training, is_special_event, is_orientation, is_field_shift FROM seats"""

SQL["epoch_to_local"] = W("punches", "source_zones") + """
SELECT p.time_id, p.source_database, z.local_tz,
       CAST(to_timestamp(p.time_start_ts) AT TIME ZONE z.local_tz AS TIMESTAMP) AS clock_in_time,
       CASE WHEN p.time_end_ts <> 0 THEN CAST(to_timestamp(p.time_end_ts) AT TIME ZONE z.local_tz AS TIMESTAMP) END AS clock_out_time
FROM punches p LEFT JOIN source_zones z ON z.source_database = p.source_database"""

_SLICES = W("schedule", "users") + f""",
ns AS (SELECT s.*, u.first_name, u.last_name, u.last_name || ', ' || u.first_name AS assigned_name
       FROM schedule s LEFT JOIN users u ON (u.user_id, u.source_database) = (s.user_id, s.source_database)),
pts AS (SELECT unit_name, shift_start AS ts FROM ns WHERE unit_name IS NOT NULL AND shift_start IS NOT NULL
        UNION SELECT unit_name, shift_end FROM ns WHERE unit_name IS NOT NULL AND shift_end IS NOT NULL),
cut AS (SELECT unit_name, ts AS start_time, lead(ts) OVER (PARTITION BY unit_name ORDER BY ts) AS end_time FROM pts),
met AS (SELECT ns.*, c.start_time, c.end_time, {rn(hrs('c.end_time', 'c.start_time'))} AS dur
        FROM cut c JOIN ns ON ns.unit_name = c.unit_name AND ns.shift_start <= c.start_time AND ns.shift_end > c.start_time AND ns.shift_end >= c.end_time
        WHERE c.end_time IS NOT NULL)"""

SQL["interval_flatten"] = _SLICES + f""",
g AS (SELECT unit_name, start_time, end_time, cost_center_id, cost_center_name, date_line, count(*) AS crew_count, max(dur) AS dur,
             string_agg(DISTINCT assignment_status, ', ' ORDER BY assignment_status) AS assignment_statuses,
             count(*) FILTER (assigned_name IS NULL) AS n_open,
             sum(CAST(COALESCE(hours_worked, 0) AS DECIMAL(28,6))) AS worked, sum(CAST(COALESCE(scheduled_hours, 0) AS DECIMAL(28,6))) AS sched,
             string_agg(DISTINCT source_database, ', ' ORDER BY source_database) AS source_databases
      FROM met GROUP BY ALL)
SELECT unit_name, start_time, end_time, cost_center_id, cost_center_name, date_line, crew_count, assignment_statuses,
       {rn('crew_count * dur')} AS total_scheduled_hours, {rn('n_open * dur')} AS total_open_hours,
       CAST(round(worked, 2) AS DOUBLE) AS total_worked_hours, CAST(round(sched, 2) AS DOUBLE) AS total_individual_scheduled_hours,
       CASE WHEN sched > 0 THEN {rn('worked::DOUBLE / sched::DOUBLE * 100', 1)} ELSE 0.0::DOUBLE END AS utilization_percentage, source_databases, dur AS interval_duration_hours
FROM g"""

SQL["interval_members"] = _SLICES + """
SELECT unit_name, cost_center_id, date_line, source_database, assignment_id, COALESCE(assigned_name, 'OPEN') AS crew_member_name,
       COALESCE(first_name || ' ' || last_name, assigned_name, 'OPEN') AS crew_full_name, min(start_time) AS member_from, max(end_time) AS member_to
FROM met GROUP BY unit_name, cost_center_id, date_line, source_database, assignment_id, assigned_name, first_name, last_name, time_id"""

SQL["interval_crew_report"] = _SLICES + """
SELECT unit_name, start_time, end_time, date_line, cost_center_id, count(*) AS crew_count,
       string_agg(COALESCE(assigned_name, 'OPEN'), '; ' ORDER BY COALESCE(assigned_name, 'OPEN'), COALESCE(first_name || ' ' || last_name, assigned_name, 'OPEN')) AS crew_names,
       string_agg(COALESCE(first_name || ' ' || last_name, assigned_name, 'OPEN'), '; ' ORDER BY COALESCE(assigned_name, 'OPEN'), COALESCE(first_name || ' ' || last_name, assigned_name, 'OPEN')) AS crew_full_names
FROM met WHERE date_line BETWEEN DATE '2024-01-19' AND DATE '2024-01-25' GROUP BY unit_name, start_time, end_time, date_line, cost_center_id, cost_center_name"""

SQL["shift_partners"] = W("seats") + """,
crews AS (SELECT source_database, unit_id, date_line, shift_start, list(DISTINCT {'id': assignment_id, 'name': assigned_name}) AS members
          FROM seats WHERE unit_id IS NOT NULL GROUP BY ALL),
mates AS (SELECT s.assignment_id, s.source_database, list_filter(COALESCE(c.members, []), lambda m: m.id <> s.assignment_id) AS others
          FROM seats s LEFT JOIN crews c ON (c.source_database, c.unit_id, c.date_line, c.shift_start) = (s.source_database, s.unit_id, s.date_line, s.shift_start))
SELECT assignment_id, source_database, CAST(len(others) AS BIGINT) AS partner_count,
       NULLIF(array_to_string(list_sort(list_distinct(list_filter(list_transform(others, lambda m: m.name), lambda n: n IS NOT NULL))), ', '), '') AS partner_names
FROM mates"""

SQL["staffing_status"] = W("seats") + """,
g AS (SELECT source_database, unit_id, date_line, shift_start, count(*) AS total_positions,
             count(*) FILTER (WHERE assignment_status = 'ASSIGNED') AS filled_positions
      FROM seats GROUP BY ALL)
SELECT s.assignment_id, g.total_positions, g.filled_positions, g.total_positions - g.filled_positions AS open_positions,
       CASE WHEN g.total_positions IS NULL THEN NULL WHEN g.filled_positions = 0 THEN 'COMPLETELY_OPEN'
            WHEN g.total_positions - g.filled_positions > 0 THEN 'UNDERSTAFFED' ELSE 'FULLY_STAFFED' END AS staffing_status
FROM seats s LEFT JOIN g ON g.source_database = s.source_database AND g.unit_id = s.unit_id
  AND g.date_line = s.date_line AND g.shift_start = s.shift_start"""

SQL["weekly_overtime"] = W("weekly") + """
SELECT source_database, user_id, week_start, round(weekly_scheduled_hours, 4) AS weekly_scheduled_hours,
       round(weekly_actual_hours, 4) AS weekly_actual_hours, shift_count, round(overtime_hours, 4) AS overtime_hours,
       is_overtime FROM weekly"""

SQL["period_overtime"] = W("seat_periods") + """,
wk AS (
  SELECT source_database, user_id, pay_period_start, period_week, sum(scheduled_hours) AS ws, sum(hours_worked) AS wa,
         count(*) AS wc
  FROM seat_periods
  WHERE is_field_shift AND NOT is_special_event AND NOT is_orientation AND NOT (is_open AND is_training)
    AND unit_name IS NOT NULL AND assignment_status = 'ASSIGNED' AND user_id IS NOT NULL
  GROUP BY ALL),
ot AS (SELECT *, CASE WHEN ws > 40 THEN ws - 40 ELSE 0.0 END AS wso, CASE WHEN wa > 40 THEN wa - 40 ELSE 0.0 END AS wao FROM wk)
SELECT source_database, user_id, pay_period_start, round(sum(ws), 4) AS pp_scheduled_hours,
       round(sum(wa), 4) AS pp_actual_hours, round(sum(wso), 4) AS pp_scheduled_ot, round(sum(wao), 4) AS pp_actual_ot,
       CAST(sum(wc) AS BIGINT) AS pp_shift_count, bool_or(wso > 0) AS has_overtime_week
FROM ot GROUP BY source_database, user_id, pay_period_start"""

SQL["overtime_summary"] = W("weekly") + """
SELECT source_database, count(DISTINCT user_id) AS employees,
       count(DISTINCT CASE WHEN is_overtime THEN user_id END) AS employees_with_overtime,
       CAST(count_if(is_overtime) AS BIGINT) AS overtime_weeks, round(sum(overtime_hours), 4) AS total_overtime_hours
FROM weekly GROUP BY source_database"""

SQL["cumulative_hours"] = W("seats") + """
SELECT assignment_id, user_id, week_start,
       round(CASE WHEN user_id IS NOT NULL THEN sum(scheduled_hours) OVER (
         PARTITION BY source_database, user_id, week_start ORDER BY shift_start, assignment_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END, 4) AS cumulative_hours
FROM seats"""

SQL["urgency_flags"] = W("seats") + """
SELECT assignment_id, CAST(date_diff('day', DATE '2024-01-25', date_line) AS INTEGER) AS days_until_shift,
       date_line = DATE '2024-01-25' AS is_today, date_line = DATE '2024-01-26' AS is_tomorrow,
       date_line <= DATE '2024-01-28' AS is_within_3_days
FROM seats"""

SQL["daily_open_summary"] = W("seats") + """
SELECT assignment_id, region, date_line,
       count(*) FILTER (WHERE assignment_status = 'OPEN') OVER (PARTITION BY region, date_line) AS open_shift_count,
       round(sum(CASE WHEN assignment_status = 'OPEN' THEN open_hours END) OVER (PARTITION BY region, date_line), 4) AS open_hours_day
FROM seats"""

# From shifts (unit, day, start) up to weeks; people from their own weekly totals.
_WEEKDAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
SQL["scheduling_summary"] = W("seats") + f""",
shift_ AS (SELECT source_database, CAST(date_trunc('week', date_line) AS DATE) AS week_start, unit_id, unit_name, date_line, shift_start, any_value(day_of_week) AS dow,
             count(*) AS seats_, count(user_id) AS taken, sum(scheduled_hours) AS plan_h, sum(IF(user_id IS NULL, 0.0, scheduled_hours)) AS taken_h,
             sum(open_hours) AS open_h, sum(IF(user_id IS NULL, NULL, hours_worked)) AS work_h
           FROM seats WHERE is_training IS DISTINCT FROM TRUE GROUP BY ALL),
week_ AS (SELECT source_database, week_start, CAST(sum(seats_) AS BIGINT) AS n, CAST(sum(taken) AS BIGINT) AS f, count(*) AS shifts, sum(plan_h) AS plan_h,
            sum(CASE WHEN taken > 0 THEN taken_h END) AS taken_h, sum(open_h) AS open_h, sum(work_h) AS work_h,
            {", ".join(f"CAST(COALESCE(sum(seats_) FILTER (WHERE dow = {i}), 0) AS BIGINT) AS {d}_shifts" for i, d in enumerate(_WEEKDAYS))}
          FROM shift_ GROUP BY ALL),
gaps AS ({tally('shift_', 'source_database, week_start', {'completely_open_shifts': 'taken = 0', 'understaffed_shifts': 'taken BETWEEN 1 AND seats_ - 1'},
                {'open_p': ('taken = 0', 'seats_'), 'under_p': ('taken BETWEEN 1 AND seats_ - 1', 'seats_ - taken')})}),
person AS (SELECT source_database, CAST(date_trunc('week', date_line) AS DATE) AS week_start, user_id, greatest(sum(scheduled_hours) - 40, 0) AS over_plan,
             greatest(sum(hours_worked) - 40, 0) AS over_work FROM seats WHERE user_id IS NOT NULL AND is_training IS DISTINCT FROM TRUE GROUP BY ALL),
people AS ({tally('person', 'source_database, week_start', {'unique_employees_worked': 'TRUE', 'employees_with_scheduled_overtime': 'over_plan > 0'},
                  {'ot_plan': ('over_plan > 0', 'over_plan'), 'ot_work': ('over_work > 0', 'over_work')})}),
v AS (SELECT week_.*, g.* EXCLUDE (source_database, week_start), p.* EXCLUDE (source_database, week_start), {rn('plan_h', 1)} AS total_scheduled_hours,
        {rn('taken_h', 1)} AS scheduled_hours_filled, {rn('open_h', 1)} AS scheduled_hours_open, {rn('work_h', 1)} AS actual_hours_worked
      FROM week_ LEFT JOIN gaps g USING (source_database, week_start) LEFT JOIN people p USING (source_database, week_start))
SELECT source_database, week_start, week_start + 6 AS week_end, shifts AS total_shifts_scheduled, n AS total_shift_positions_scheduled, f AS positions_filled, n - f AS positions_open,
  completely_open_shifts, CAST(open_p AS BIGINT) AS completely_open_positions, understaffed_shifts, CAST(under_p AS BIGINT) AS understaffed_positions,
  completely_open_shifts + understaffed_shifts AS total_problem_shifts, CAST(open_p + under_p AS BIGINT) AS total_problem_positions,
  COALESCE(unique_employees_worked, 0) AS unique_employees_worked, total_scheduled_hours, scheduled_hours_filled, scheduled_hours_open, actual_hours_worked,
  COALESCE(employees_with_scheduled_overtime, 0) AS employees_with_scheduled_overtime, round(COALESCE(ot_plan, 0.0), 4) AS total_overtime_hours_scheduled,
  round(COALESCE(ot_work, 0.0), 4) AS total_overtime_hours_worked, {rn('f / NULLIF(n, 0) * 100', 1)} AS coverage_pct,
  {rn('scheduled_hours_filled / NULLIF(total_scheduled_hours, 0) * 100', 1)} AS scheduled_hours_coverage_pct,
  {rn('actual_hours_worked / NULLIF(scheduled_hours_filled, 0) * 100', 1)} AS hours_worked_vs_scheduled_pct,
  {rn('scheduled_hours_filled - actual_hours_worked', 1)} AS hours_variance, {", ".join(f"{d}_shifts" for d in _WEEKDAYS)}
FROM v"""

SQL["dense_grid"] = W("seats", "valid_cost_centers") + """,
d AS (SELECT DISTINCT date_line FROM seats WHERE date_line >= DATE '2023-12-21' AND date_line <= DATE '2024-01-25'),
ah AS (SELECT date_line, cost_center_id, source_database, is_training,
              """ + rn("sum(scheduled_hours)", 2) + """ AS scheduled_hours, """ + rn("sum(open_hours)", 2) + """ AS open_hours,
              """ + rn("sum(COALESCE(hours_worked, 0.0))", 2) + """ AS worked_hours
       FROM seats WHERE cost_center_id IS NOT NULL GROUP BY ALL)
SELECT d.date_line, c.cost_center_id, c.cost_center_name, c.source_database, c.special_event, ah.is_training,
       COALESCE(ah.scheduled_hours, 0.0) AS scheduled_hours, COALESCE(ah.open_hours, 0.0) AS open_hours,
       greatest(COALESCE(ah.worked_hours, 0.0), 0.0) AS worked_hours
FROM d CROSS JOIN valid_cost_centers c
LEFT JOIN ah ON ah.date_line = d.date_line AND ah.cost_center_id = c.cost_center_id AND ah.source_database = c.source_database"""

SQL["shift_slice"] = W("seats", "periods") + f""",
p AS (SELECT start_date, end_date FROM periods WHERE start_date <= DATE '2024-01-25' AND end_date >= DATE '2024-01-25'
      ORDER BY start_date DESC LIMIT 1)
SELECT s.assignment_id, s.region, s.date_line, s.assignment_status,
       round(CASE WHEN COALESCE(s.scheduled_hours, 0.0) = 0 THEN {hrs('s.shift_end', 's.shift_start')} ELSE s.scheduled_hours END, 4) AS report_hours
FROM seats s JOIN p ON s.date_line >= p.start_date AND s.date_line <= p.end_date
WHERE s.region = 'south' AND NOT s.is_training AND NOT (s.assignment_status = 'OPEN' AND s.is_special_event)"""

SQL["assign_period"] = W("seat_periods") + """
SELECT assignment_id, date_line, pay_period_year, pay_period_number, pay_period_start, pay_period_end, period_week
FROM seat_periods"""

SQL["current_next_period"] = W("periods") + """
SELECT * FROM (SELECT 'current' AS which, pay_period_number, start_date, end_date FROM periods
               WHERE start_date <= DATE '2024-01-25' ORDER BY start_date DESC LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'next', pay_period_number, start_date, end_date FROM periods
               WHERE start_date > DATE '2024-01-25' ORDER BY start_date LIMIT 1)"""

SQL["period_for_date"] = W("periods") + """
SELECT pay_period_year, pay_period_number, start_date, end_date FROM periods
WHERE start_date <= DATE '2024-01-25' AND end_date >= DATE '2024-01-25' ORDER BY start_date DESC LIMIT 1"""

SQL["reports_due"] = W("seats", "periods") + """
SELECT r.region, d.report_type, d.due_date, d.period_start, d.period_end
FROM (SELECT DISTINCT region FROM seats) r CROSS JOIN (
  SELECT 'schedule' AS report_type, start_date - 1 AS due_date, start_date AS period_start, end_date AS period_end FROM periods
  UNION ALL
  SELECT 'comparison', end_date + 1, start_date, end_date FROM periods) d"""

SQL["employee_hours_report"] = W("report_shifts") + """,
wk AS (
  SELECT region, pay_period_start, user_id, assigned_name, calendar_week,
    sum(CASE WHEN period_week = 1 THEN report_hours ELSE 0.0 END) AS w1,
    sum(CASE WHEN period_week <> 1 THEN report_hours ELSE 0.0 END) AS w2,
    sum(CASE WHEN is_training THEN report_hours ELSE 0.0 END) AS tr,
    sum(CASE WHEN is_orientation THEN report_hours ELSE 0.0 END) AS ori,
    sum(CASE WHEN NOT is_orientation AND is_special_event THEN report_hours ELSE 0.0 END) AS se,
    sum(CASE WHEN NOT is_orientation AND NOT is_special_event AND is_field_shift THEN report_hours ELSE 0.0 END) AS fld,
    sum(report_hours) AS week_hours, sum(COALESCE(hours_worked, 0.0)) AS act
  FROM report_shifts WHERE NOT is_open GROUP BY ALL)
SELECT region, pay_period_start, user_id, assigned_name,
  round(sum(w1), 4) AS week1_hours, round(sum(w2), 4) AS week2_hours, round(sum(tr), 4) AS training_hours,
  round(sum(ori), 4) AS orientation_hours, round(sum(se), 4) AS special_event_hours, round(sum(fld), 4) AS field_hours,
  round(sum(greatest(week_hours - 40.0, 0.0)), 4) AS total_ot, round(sum(act), 4) AS actual_hours,
  round(sum(w1) + sum(w2), 4) AS total_hours, round(sum(act) - (sum(w1) + sum(w2)), 4) AS variance
FROM wk GROUP BY region, pay_period_start, user_id, assigned_name"""

SQL["open_hours_report"] = W("report_shifts") + """
SELECT region, pay_period_start, round(sum(report_hours), 4) AS open_total,
  round(sum(CASE WHEN period_week = 1 THEN report_hours ELSE 0.0 END), 4) AS open_week1,
  round(sum(CASE WHEN period_week <> 1 THEN report_hours ELSE 0.0 END), 4) AS open_week2,
  round(sum(CASE WHEN is_training THEN report_hours ELSE 0.0 END), 4) AS open_training,
  round(sum(CASE WHEN is_orientation THEN report_hours ELSE 0.0 END), 4) AS open_orientation,
  round(sum(CASE WHEN NOT is_orientation AND is_special_event THEN report_hours ELSE 0.0 END), 4) AS open_special_event,
  round(sum(CASE WHEN NOT is_orientation AND NOT is_special_event THEN report_hours ELSE 0.0 END), 4) AS open_field
FROM report_shifts WHERE is_open GROUP BY region, pay_period_start"""

SQL["report_with_totals"] = W("report_shifts") + """,
d AS (SELECT * REPLACE (IF(is_open, NULL, source_database) AS source_database), CASE WHEN is_open THEN 'OPEN' ELSE COALESCE(assigned_name, 'user ' || CAST(user_id AS VARCHAR)) END AS row_label
      FROM report_shifts)
SELECT region, pay_period_start, row_label, user_id,
       CASE WHEN row_label = 'OPEN' THEN 'open' ELSE 'employee' END AS row_kind,
       round(sum(report_hours), 4) AS scheduled_hours, count(*) AS shifts
FROM d GROUP BY region, pay_period_start, row_label, user_id, source_database
UNION ALL
SELECT region, pay_period_start, 'TOTAL', NULL, 'total', round(sum(report_hours), 4), count(*)
FROM d GROUP BY region, pay_period_start"""

SQL["daily_hours_variance"] = W("report_shifts") + """
SELECT region, pay_period_start, date_line,
  round(sum(CASE WHEN NOT is_open THEN report_hours ELSE 0.0 END), 4) AS scheduled_hours,
  round(sum(CASE WHEN is_open THEN report_hours ELSE 0.0 END), 4) AS open_hours,
  round(sum(COALESCE(hours_worked, 0.0)), 4) AS actual_hours,
  round(sum(COALESCE(hours_worked, 0.0)) - sum(CASE WHEN NOT is_open THEN report_hours ELSE 0.0 END), 4) AS variance,
  count(*) FILTER (WHERE NOT is_open) AS filled_shifts, count(*) FILTER (WHERE is_open) AS open_shifts
FROM report_shifts GROUP BY region, pay_period_start, date_line"""

# ---------------------------------------------------------------- runs x crew x shift, audit, quality
SQL["run_crew"] = W("run_crew") + """
SELECT leg_id, source_database, assignment_id, user_id, shift_date, cost_center_name, special_event,
       round(time_on_task_minutes, 4) AS time_on_task_minutes FROM run_crew"""

SQL["shift_metrics"] = W("shift_metrics") + """
SELECT assignment_id, total_runs, round(total_time_on_task_hours, 4) AS total_time_on_task_hours,
       round(avg_time_on_task_minutes, 4) AS avg_time_on_task_minutes,
       round(avg_response_time_minutes, 4) AS avg_response_time_minutes,
       round(time_on_task_pct, 4) AS time_on_task_pct, round(unit_hour_utilization, 4) AS unit_hour_utilization,
       round(active_shift_hours, 4) AS active_shift_hours, first_run_assigned_time, last_run_clear_time
FROM shift_metrics"""

SQL["crew_daily"] = W("shift_metrics") + """,
p AS (SELECT a.assignment_id, a.source_database,
             string_agg(DISTINCT b.assigned_name, ', ' ORDER BY b.assigned_name) FILTER (WHERE b.assignment_id <> a.assignment_id) AS partner_crew_members
      FROM shift_metrics a LEFT JOIN shift_metrics b ON a.unit_name = b.unit_name AND a.shift_date = b.shift_date
        AND a.source_database = b.source_database
      GROUP BY a.assignment_id, a.source_database)
SELECT m.assignment_id, m.shift_date, (SELECT count(DISTINCT o.assignment_id) FROM shift_metrics o WHERE o.unit_name = m.unit_name AND o.shift_date = m.shift_date
          AND o.source_database = m.source_database AND o.assignment_id <> m.assignment_id) AS partner_count, p.partner_crew_members,
       round(CASE WHEN active_shift_hours > 0 THEN total_time_on_task_hours / active_shift_hours * 100 END, 4) AS active_time_efficiency_pct,
       round(CASE WHEN actual_hours_worked > 0 THEN total_time_on_task_hours / actual_hours_worked * 100 END, 4) AS actual_hours_efficiency_pct,
       CAST(dayofweek(m.shift_date) AS INTEGER) AS day_of_week, dayname(m.shift_date) AS day_name,
       CAST(date_trunc('week', m.shift_date) AS DATE) AS week_start, CAST(date_trunc('month', m.shift_date) AS DATE) AS month_start
FROM shift_metrics m LEFT JOIN p ON p.assignment_id = m.assignment_id AND p.source_database = m.source_database"""

SQL["crew_efficiency_weekly"] = W("shift_metrics") + f"""
SELECT user_id, source_database, week_start, week_start + 6 AS week_end, shifts_worked, total_calls_ran,
       round(avg_destination_time_minutes, 4) AS avg_destination_time_minutes, round(avg_transport_time_minutes, 4) AS avg_transport_time_minutes,
       round(avg_time_on_task_minutes, 4) AS avg_time_on_task_minutes, round(avg_daily_uhu, 4) AS avg_daily_uhu,
       round(CASE WHEN total_scheduled_hours > 0 THEN total_calls_ran / total_scheduled_hours END, 4) AS weekly_uhu,
       round(CASE WHEN total_scheduled_hours > 0 THEN total_time_on_task_hours / total_scheduled_hours * 100 END, 4) AS time_on_task_pct,
       round(total_active_hours, 4) AS total_active_hours, cost_centers_worked
FROM (SELECT user_id, assigned_name, job_title, {sunday_week('shift_date')} AS week_start, source_database,
             CAST(sum(total_runs) AS BIGINT) AS total_calls_ran, sum(scheduled_hours) AS total_scheduled_hours,
             sum(total_time_on_task_hours) AS total_time_on_task_hours,
             sum(avg_time_on_task_minutes * total_runs) / NULLIF(sum(total_runs), 0) AS avg_time_on_task_minutes,
             sum(avg_destination_time_minutes * total_runs) / NULLIF(sum(total_runs), 0) AS avg_destination_time_minutes,
             sum(avg_transport_time_minutes * total_runs) / NULLIF(sum(total_runs), 0) AS avg_transport_time_minutes,
             avg(unit_hour_utilization) AS avg_daily_uhu, count(*) AS shifts_worked,
             sum(active_shift_hours) AS total_active_hours,
             string_agg(DISTINCT cost_center_name, ', ' ORDER BY cost_center_name) AS cost_centers_worked
      FROM shift_metrics WHERE NOT is_training GROUP BY ALL) w"""

SQL["run_metrics"] = W("run_metrics") + """
SELECT leg_id, assignment_id, region, service_date, round(time_on_task_hours, 4) AS time_on_task_hours,
       round(run_tot_pct_of_shift, 4) AS run_tot_pct_of_shift, assigned_hour, day_of_week, day_name, week_start,
       month_start FROM run_metrics"""

SQL["sequence_in_group"] = W("run_metrics") + """
SELECT assignment_id, shift_date, leg_id, assigned_time,
       CAST(row_number() OVER (PARTITION BY assignment_id, shift_date ORDER BY assigned_time, leg_id) AS INTEGER) AS run_sequence
FROM run_metrics"""

_DAY_MEASURES = [f"total_{n}_hours" for n in ("time_on_task", "time_on_task_excl_transport", "scene_time", "destination_time", "transport_time", "scheduled")] + [
    f"avg_{n}_minutes" for n in ("time_on_task", "time_on_task_excl_transport", "response_time", "scene_time", "destination_time", "transport_time")]
SQL["reconcile_daily"] = W("reconcile") + """
SELECT service_date, source_database, region, total_runs, total_shifts, """ + ", ".join(f"round({m}, 4) AS {m}" for m in _DAY_MEASURES) + " FROM reconcile"

_SHARES = {"time_on_task_pct": "total_time_on_task_hours", "time_on_task_excl_transport_pct": "total_time_on_task_excl_transport_hours", "unit_hour_utilization": "total_runs"}
_AVERAGED = [*_SHARES, "avg_scene_time_minutes", "avg_destination_time_minutes", "avg_transport_time_minutes"]
SQL["time_on_task_daily"] = W("reconcile") + """,
d AS (SELECT *, """ + ", ".join(f"COALESCE({c} / NULLIF(total_scheduled_hours, 0), 0.0) AS {n}" for n, c in _SHARES.items()) + """ FROM reconcile)
SELECT service_date, source_database, region, total_runs, total_shifts, """ + ", ".join(f"round({m}, 4) AS {m}" for m in [*_DAY_MEASURES, *_SHARES]) + ", " + ", ".join(
    f"round(CAST(sum(CAST({m} AS DECIMAL(28,12))) OVER w AS DOUBLE) / count({m}) OVER w, 4) AS {m}_35day_ma" for m in _AVERAGED) + """,
  CAST(dayofweek(service_date) AS INTEGER) AS day_of_week, dayname(service_date) AS day_name, CAST(date_trunc('week', service_date) AS DATE) AS week_start,
  CAST(date_trunc('month', service_date) AS DATE) AS month_start
FROM d WINDOW w AS (PARTITION BY source_database, region ORDER BY service_date ROWS BETWEEN 34 PRECEDING AND CURRENT ROW)"""

SQL["labour_hours"] = W("shift_mart", "users") + f""",{_LABOUR}
SELECT region, shift_date, ambulances_up_am, ambulances_up_pm, total_ambulances, """ + ", ".join(f"round({c}, 4) AS {c}" for c in _BUCKETS) + " FROM labour"

SQL["last_change_actor"] = W("runs", "history_log", "users") + """
SELECT r.leg_id, r.run_number, r.canceled_time, r.created AS time_canceled, r.cancel_reason_text, r.canceled_reason_id, v.name AS cancel_reason_name, r.lost_call_status, r.run_outcome,
       h.id AS last_change_id, h.user_id AS canceled_by_user_id, concat(u.last_name, ', ', u.first_name) AS canceled_by, r.source_database
FROM runs r
LEFT JOIN (SELECT leg_id, source_database, max(id) AS id, arg_max(user_id, id) AS user_id FROM history_log WHERE field = 'canceled_time' GROUP BY ALL) h
  ON h.leg_id = r.leg_id AND h.source_database = r.source_database
LEFT JOIN users u ON u.user_id = h.user_id AND u.source_database = h.source_database
LEFT JOIN (VALUES (0, 'No show'), (1, 'Weather'), (2, 'Facility closed'), (3, 'Duplicate')) v(id, name) ON v.id = r.canceled_reason_id
WHERE r.last_status_id < 0 AND r.deleted = 0"""

SQL["distinct_list"] = W("upload_log") + "SELECT * FROM upload_log"

SQL["compliance"] = W("runs", "crew_link", "upload_log", "final_records", "users") + """,
crew AS (SELECT DISTINCT source_database, leg_id, crew_user_id FROM crew_link),
up AS (SELECT source_database, leg_id, count(*) AS n, string_agg(DISTINCT attachment_types, '; ' ORDER BY attachment_types) AS types, min(action_timestamp) AS first_at,
              count(*) FILTER (EXISTS (SELECT 1 FROM crew c WHERE c.leg_id = a.leg_id AND c.source_database = a.source_database AND c.crew_user_id = a.user_id)) AS n_crew
       FROM upload_log a GROUP BY ALL),
leg AS (SELECT r.*, f.finalizer_id, f.finalized, COALESCE(up.n, 0) AS n, COALESCE(up.n_crew, 0) AS n_crew, up.types, up.first_at,
               COALESCE(r.reason_for_transport IN ('Dialysis', 'Doctors Appointment'), FALSE) OR COALESCE(contains(r.source_name, 'Vet Ride'), FALSE)
                 OR COALESCE(r.calltype_name NOT IN ('ALS', 'BLS', 'CCT'), FALSE) AS exempt,
               EXISTS (SELECT 1 FROM crew c WHERE c.leg_id = r.leg_id AND c.source_database = r.source_database AND c.crew_user_id = f.finalizer_id) AS own_final
        FROM runs r LEFT JOIN final_records f ON f.run_number = r.run_number::VARCHAR AND f.source_database = r.source_database
        LEFT JOIN up ON up.leg_id = r.leg_id AND up.source_database = r.source_database WHERE r.run_outcome = 'ran')
SELECT c.crew_user_id AS user_id, CASE WHEN u.user_id IS NULL THEN ', ' ELSE concat(u.last_name, ', ', u.first_name) END AS crew_member_name, l.run_number, l.leg_id, l.source_database, l.region, l.service_date,
       CAST(date_trunc('week', l.service_date) AS DATE) AS week_start, CAST(date_trunc('month', l.service_date) AS DATE) AS month_start, l.calltype_name, l.source_name,
       l.reason_for_transport, l.finalizer_id, CAST(l.finalized AS INTEGER) AS finalized, l.own_final AS finalizer_is_crew_member, COALESCE(c.crew_user_id = l.finalizer_id, FALSE) AS is_finalizer,
       l.n AS total_attachments, l.n_crew AS crew_attachments, l.types AS all_attachment_types, l.first_at AS first_attachment_time, l.n_crew > 0 AS has_crew_attachment,
       NOT l.exempt AS requires_attachment, l.exempt OR l.n_crew > 0 AS is_compliant
FROM crew c JOIN leg l USING (source_database, leg_id) LEFT JOIN users u ON u.user_id = c.crew_user_id AND u.source_database = c.source_database
WHERE c.crew_user_id = l.finalizer_id OR NOT l.own_final OR l.finalizer_id IS NULL"""

SQL["qa_recon"] = W("users", "stage_times") + """,
rec AS (SELECT doc_id, 'src' || (doc_id % 3)::VARCHAR AS src, n_chars % 2 = 0 AS fin FROM documents),
lab AS (SELECT *, 'src' || (doc_id % 3)::VARCHAR AS src FROM labels)
SELECT DISTINCT r.doc_id AS run_id, r.doc_id + 1000 AS run_num, s.service_date AS date_of_service, p.last_name || ', ' || p.first_name AS patient_name,
       CASE WHEN p.user_id IS NOT NULL THEN CAST(DATE '1940-01-01' + (p.user_id % 20000)::INTEGER AS DATE) END AS dob, s.calltype_name || ' ' || s.level_of_service AS calltype,
       IF(r.fin, 'Yes', 'No') AS finalized, CASE WHEN r.fin THEN CAST(DATE '2024-01-01' + (r.doc_id % 60)::INTEGER AS DATE) END AS finalized_date,
       CASE WHEN q.doc_id IS NOT NULL THEN 'Flagged' WHEN r.fin THEN 'Submitted' ELSE 'Not Finalized' END AS status_name,
       CASE WHEN q.doc_id IS NOT NULL THEN CAST(DATE '2024-02-01' + (q.doc_id % 30)::INTEGER AS DATE) END AS qa_date,
       rv.last_name || ', ' || rv.first_name AS reviewer_name, lc.last_name || ', ' || lc.first_name AS crew_name,
       CASE WHEN x.doc_id IS NULL THEN 'Not Exported' WHEN x.quality = 0 THEN 'Failed' ELSE 'Exported' END AS exported,
       CASE WHEN x.quality = 0 THEN 'validation failed' END AS errors, s.source_database
FROM stage_times s LEFT JOIN rec r ON r.doc_id = s.leg_id AND r.src = s.source_database
LEFT JOIN lab q ON q.doc_id = r.doc_id AND q.src = r.src AND q.toxic = 1 LEFT JOIN lab x ON x.doc_id = r.doc_id AND x.src = r.src
LEFT JOIN users rv ON rv.user_id = q.doc_id % 100 * 3 + q.doc_id % 3 AND rv.source_database = q.src
LEFT JOIN users lc ON lc.user_id = r.doc_id % 150 * 3 + r.doc_id % 3 AND lc.source_database = r.src
LEFT JOIN users p ON p.user_id = s.user_id AND p.source_database = s.source_database"""

SQL["qa_status"] = W("qa_runs") + """,
st AS (SELECT doc_id AS run_id, CAST(quality + 1 AS INTEGER) AS status_id, toxic AS removed FROM qa_runs WHERE quality IS NOT NULL),
s AS (SELECT st.*, v.status_name FROM st LEFT JOIN (VALUES (1, 'Reviewed'), (2, 'Approved')) v(status_id, status_name)
      ON v.status_id = st.status_id)
SELECT r.doc_id AS run_id, r.source, s.status_id, s.status_name
FROM qa_runs r LEFT JOIN s ON s.run_id = r.doc_id AND s.removed = 0"""

SQL["pay_list"] = W("stage_times", "crew_link", "users") + f"""
SELECT DISTINCT r.run_number, r.service_date AS leg_date, r.clear_time, r.assigned_time, round({hrs('r.clear_time', 'r.assigned_time')}, 4) AS time_on_task_hours,
  r.source_database, l.crew_user_id, CASE WHEN l.crew_user_id IS NULL THEN ' ' ELSE COALESCE(u.first_name, '') || ' ' || COALESCE(u.last_name, '') END AS crew_name,
  u.hourly_wage, round({hrs('r.clear_time', 'r.assigned_time')} * u.hourly_wage, 4) AS pay_amount
FROM stage_times r LEFT JOIN crew_link l ON l.leg_id = r.leg_id AND l.source_database = r.source_database
LEFT JOIN users u ON u.user_id = l.crew_user_id AND u.source_database = l.source_database
WHERE r.last_status_id >= -1 AND r.source_database <> 'src2'"""

SQL["active_users"] = W("users") + """
SELECT user_id, source_database, CAST(user_id AS VARCHAR) || '_' || source_database AS surrogate_key,
       CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL THEN first_name || ' ' || last_name END AS full_name,
       CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL THEN last_name || ', ' || first_name END AS display_name,
       job_title, state,
       lower(trim(CAST(disabled AS VARCHAR))) IN ('1', 'true', 't', 'yes', 'y') AS is_disabled,
       COALESCE(deactivated = 1, FALSE) AS is_deactivated,
       COALESCE((lower(trim(CAST(disabled AS VARCHAR))) IN ('0', 'false') OR disabled IS NULL) AND deactivated = 0, FALSE) AS is_active
FROM users"""

SQL["dq_invalid_durations"] = W("runs") + f"""
SELECT leg_id, run_number, source_database, service_date, round({mins('clear_time', 'enroute_time')}, 4) AS duration_minutes,
       CASE WHEN {mins('clear_time', 'enroute_time')} < 0 THEN 'negative_duration' ELSE 'exceeds_12_hours' END AS issue
FROM runs WHERE enroute_time IS NOT NULL AND clear_time IS NOT NULL
  AND ({mins('clear_time', 'enroute_time')} < 0 OR {mins('clear_time', 'enroute_time')} > 720)"""

SQL["dq_column_checks"] = W("users", "seats") + """,
u AS (SELECT user_id, CAST(user_id AS VARCHAR) || '_' || source_database AS surrogate_key FROM users),
c AS (
  SELECT 'users' AS table_name, 'user_id' AS column_name, 'not_null' AS test, count_if(user_id IS NULL) AS failures FROM u
  UNION ALL SELECT 'users', 'surrogate_key', 'not_null', count_if(surrogate_key IS NULL) FROM u
  UNION ALL SELECT 'users', 'surrogate_key', 'unique', count(surrogate_key) - count(DISTINCT surrogate_key) FROM u
  UNION ALL SELECT 'schedule', 'assignment_id', 'not_null', count_if(assignment_id IS NULL) FROM seats
  UNION ALL SELECT 'schedule', 'source_database', 'not_null', count_if(source_database IS NULL) FROM seats
  UNION ALL SELECT 'schedule', 'date_line', 'not_null', count_if(date_line IS NULL) FROM seats
  UNION ALL SELECT 'schedule', 'user_id', 'not_null', count_if(user_id IS NULL) FROM seats
  UNION ALL SELECT 'schedule', 'assignment_id', 'unique', count(assignment_id) - count(DISTINCT assignment_id) FROM seats)
SELECT table_name, column_name, test, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM c"""

SQL["null_sentinel_dates"] = """
SELECT o_orderkey AS run_id, CASE WHEN s LIKE '0000-00-00%' THEN NULL ELSE TRY_CAST(s AS TIMESTAMP) END AS finalize_date
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '0000-00-00 00:00:00' ELSE CAST(o_orderdate AS VARCHAR) END AS s
      FROM orders) x"""

# ---------------------------------------------------------------- delta / stream
_UPSERT = """
WITH t AS (SELECT event_id, ts, user_id, event_type, value, 0 AS d FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00'),
dl AS (SELECT event_id, ts, user_id, event_type, round(value + 1.0, 2) AS value, 1 AS d FROM events
       WHERE ts >= TIMESTAMP '2024-01-24 00:00:00')
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d DESC) AS rk FROM (SELECT * FROM t UNION ALL SELECT * FROM dl) u) x
WHERE rk = 1"""
SQL["upsert_merge"] = _UPSERT
SQL["stream_upsert"] = _UPSERT

SQL["upsert_composite"] = """
WITH t AS (SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day, 0 AS d FROM events
           WHERE ts < TIMESTAMP '2024-01-25 00:00:00'),
dl AS (SELECT event_id, ts, user_id, event_type, round(value + 1.0, 2) AS value, CAST(ts AS DATE) AS day, 1 AS d FROM events
       WHERE ts >= TIMESTAMP '2024-01-24 00:00:00')
SELECT user_id, event_type, day, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY d DESC, ts DESC, event_id DESC) AS rk
  FROM (SELECT * FROM t UNION ALL SELECT * FROM dl) u) x
WHERE rk = 1"""

SQL["incremental_scan"] = """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00')"""

SQL["snapshot_tag"] = W("shifts") + """
SELECT assignment_id, user_id, date_line, shift_start, DATE '2024-01-28' AS snapshot_week_start
FROM shifts WHERE date_line BETWEEN DATE '2024-01-28' AND DATE '2024-02-03'"""

SQL["snapshot_diff"] = W("seats", "cost_centers") + f""",
snap AS (
  SELECT event_id AS assignment_id, CAST(CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS BIGINT) AS planned_user_id,
         CAST(4 + event_id % 9 AS DOUBLE) AS planned_hours
  FROM events WHERE event_type = 'signup' AND event_id % 41 <> 0 AND ts < TIMESTAMP '2024-01-25 00:00:00'
    AND CAST(ts AS DATE) BETWEEN DATE '2024-01-21' AND DATE '2024-01-27'),
act AS (SELECT assignment_id, user_id AS actual_user_id, hours_worked FROM seats
        WHERE date_line BETWEEN DATE '2024-01-21' AND DATE '2024-01-27')
SELECT COALESCE(s.assignment_id, a.assignment_id) AS assignment_id, s.planned_user_id, a.actual_user_id,
       round(s.planned_hours, 4) AS planned_hours, round(a.hours_worked, 4) AS actual_hours,
       CASE WHEN s.planned_hours IS NULL THEN 'added'
            WHEN a.actual_user_id IS NULL AND s.planned_user_id IS NULL AND a.hours_worked IS NULL THEN 'unchanged'
            WHEN a.actual_user_id IS DISTINCT FROM s.planned_user_id THEN 'reassigned'
            WHEN a.hours_worked IS NULL THEN 'not_worked' ELSE 'worked' END AS change_type
FROM snap s FULL OUTER JOIN act a ON s.assignment_id = a.assignment_id"""

SQL["reconcile_weekly"] = """
SELECT o_orderkey AS leg_id, CAST(o_orderdate AS DATE) AS service_date, DATE '2001-07-22' AS range_start,
       DATE '2001-08-05' AS range_end, CAST(date_trunc('week', CAST(o_orderdate AS DATE) + 1) AS DATE) - 1 AS week_start
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-22' AND CAST(o_orderdate AS DATE) < DATE '2001-08-05'"""

SQL["week_chunks"] = """
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders),
c AS (SELECT month_start, CAST(month_start + INTERVAL 1 MONTH AS DATE) AS month_end,
             CAST(unnest(generate_series(CAST(month_start AS TIMESTAMP),
                                         CAST(CAST(month_start + INTERVAL 1 MONTH AS DATE) - 1 AS TIMESTAMP),
                                         INTERVAL 7 DAY)) AS DATE) AS chunk_start FROM m)
SELECT month_start, month_end, CAST(floor(date_diff('day', month_start, chunk_start) / 7) + 1 AS INTEGER) AS chunk_no,
       chunk_start, least(chunk_start + 7, month_end) AS chunk_end
FROM c"""

SQL["stream_dedup"] = """
SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events"""

SQL["stream_daily_counts"] = """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
       count(*) AS events, round(sum(value), 4) AS value_sum
FROM events GROUP BY ALL"""

SQL["stream_moving_windows"] = """
WITH d AS (SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events, sum(value) AS value_sum FROM events GROUP BY ALL)
SELECT window_start, event_type, events, round(value_sum, 4) AS value_sum, round(avg(events) OVER w, 4) AS events_ma, round(avg(value_sum) OVER w, 4) AS value_sum_ma
FROM d WINDOW w AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

# ---------------------------------------------------------------- composite report
SQL["shift_report"] = W("seats") + """
SELECT s.assignment_id, s.date_line, s.unit_name, s.assigned_name, p.partner_names, p.partner_count,
       st.staffing_status, round(w.weekly_scheduled_hours, 4) AS weekly_scheduled_hours, w.is_overtime,
       c.cumulative_hours, a.is_no_show, a.is_partial_shift, u.days_until_shift, o.open_shift_count
FROM seats s
JOIN (""" + SQL["shift_partners"] + """) p ON p.assignment_id = s.assignment_id
JOIN (""" + SQL["staffing_status"] + """) st ON st.assignment_id = s.assignment_id
JOIN (""" + SQL["cumulative_hours"] + """) c ON c.assignment_id = s.assignment_id
LEFT JOIN (""" + SQL["weekly_overtime"] + """) w ON w.source_database = s.source_database AND w.user_id = s.user_id
     AND w.week_start = s.week_start
JOIN (""" + SQL["attendance_flags"] + """) a ON a.assignment_id = s.assignment_id
JOIN (""" + SQL["urgency_flags"] + """) u ON u.assignment_id = s.assignment_id
JOIN (""" + SQL["daily_open_summary"] + """) o ON o.assignment_id = s.assignment_id"""

SQL["run_mart"] = W("runs") + """,
per AS (
  SELECT CAST(year(start_date) AS INTEGER) AS pay_period_year,
         CAST(floor(date_diff('day', DATE '1994-12-25', start_date) / 14) + 1 AS INTEGER) AS pay_period_number,
         start_date, start_date + 13 AS end_date
  FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-25 00:00:00',
                                           CAST((SELECT max(service_date) FROM runs) AS TIMESTAMP),
                                           INTERVAL 14 DAY)) AS DATE) AS start_date) g)
SELECT r.leg_id, r.run_number, r.source_database, r.region, r.service_date, r.calltype_name, r.run_outcome,
       r.is_long_distance, r.is_on_time, round(r.time_on_task_minutes, 4) AS time_on_task_minutes,
       p.pay_period_year, p.pay_period_number, p.start_date AS pay_period_start,
       CASE WHEN p.start_date IS NOT NULL THEN CASE WHEN date_diff('day', p.start_date, r.service_date) < 7 THEN 1 ELSE 2 END END AS period_week
FROM runs r LEFT JOIN per p ON r.service_date BETWEEN p.start_date AND p.end_date"""

SQL["schedule_sheet"] = W("report_shifts") + """
SELECT region, pay_period_start, date_line, assignment_id,
       CASE WHEN is_open THEN 'OPEN' ELSE assigned_name END AS employee_name, unit_name, cost_center_name,
       COALESCE(strftime(shift_start, '%I:%M %p'), '') AS start_text, COALESCE(strftime(shift_end, '%I:%M %p'), '') AS end_text,
       round_even(report_hours, 1) AS hours, CASE WHEN is_training THEN 'Yes' ELSE '' END AS training
FROM report_shifts"""
