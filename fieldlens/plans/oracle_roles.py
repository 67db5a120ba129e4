"""DuckDB SQL twins of the role views (``fieldlens/sources/roles.py``) for the oracle.

Each role is a named CTE with its dependencies; :func:`with_roles` emits the ``WITH``
clause a query needs. This is only text assembly for the independent oracle, not part
of the Spark execution path."""

from __future__ import annotations

# Fixed values of the fixture, written out here and not taken from the code under test.
_CALL_TYPE = {"1-URGENT": "CCT", "2-HIGH": "ALS", "3-MEDIUM": "BLS", "4-NOT SPECIFIED": "Standby - BLS", "5-LOW": "Medicar"}
_ZONE = {"src0": "America/Chicago", "src1": "America/Detroit", "src2": "America/Chicago"}
_CENTERS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_CENTERS_OF = {"src0": [0, 1, 2, 3, 4, 5], "src1": [0, 1, 2, 3, 4, 5], "src2": [1, 2, 4, 5]}


def _values(rows, names) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(names)})"


def mins(end: str, start: str) -> str:
    return f"(date_diff('microsecond', {start}, {end}) / 60000000.0)"


def hrs(end: str, start: str) -> str:
    return f"(date_diff('microsecond', {start}, {end}) / 3600000000.0)"


def rn(x: str, scale: int = 2) -> str:
    """ROUND(x::numeric, n) on the decimal value (matches round_numeric)."""
    return f"CAST(round(CAST({x} AS DECIMAL(24,8)), {scale}) AS DOUBLE)"


def sunday_week(d: str) -> str:
    return f"(CAST(date_trunc('week', CAST({d} AS DATE) + 1) AS DATE) - 1)"


def region_market_sql(market: str = "market", source: str = "source_database") -> str:
    return (f"CASE {market} WHEN 'america' THEN 'west' WHEN 'europe' THEN 'east' WHEN 'africa' THEN 'east' "
            f"WHEN 'asia' THEN 'south' ELSE {source} END")


def region_cc_sql(name: str = "cost_center_name", source: str = "source_database") -> str:
    return f"CASE left({name}, 1) WHEN 'S' THEN 'south' WHEN 'M' THEN 'middle' WHEN 'L' THEN 'west' ELSE {source} END"


def level_sql(name: str = "cost_center_name") -> str:
    return (f"CASE WHEN contains({name}, 'PROMO') THEN 'Training' ELSE CASE left({name}, 1) WHEN 'S' THEN 'BLS' "
            "WHEN 'M' THEN 'ALS' WHEN 'L' THEN 'CCT' WHEN 'E' THEN 'Orientation' ELSE 'Other' END END")


OUTCOME_SQL = ("CASE WHEN last_status_id > 0 THEN 'ran' "
               "WHEN last_status_id < 0 AND lost_call_status IS NOT NULL THEN 'turned' "
               "WHEN last_status_id < 0 AND lost_call_status IS NULL THEN 'cancelled' "
               "WHEN last_status_id IS NULL THEN 'cancelled' ELSE 'unknown' END")

ROLES: dict[str, tuple[str, tuple[str, ...]]] = {}


def role(name: str, sql: str, *deps: str) -> None:
    ROLES[name] = (sql, deps)


role("call_types", _values(list(_CALL_TYPE.items()), ["o_orderpriority", "calltype_name"]))
role("source_zones", _values(list(_ZONE.items()), ["source_database", "local_tz"]))
role("valid_cost_centers", _values([(i, _CENTERS[i], src, i == 1) for src, ids in _CENTERS_OF.items() for i in ids],
                                   ["cost_center_id", "cost_center_name", "source_database", "special_event"]))
role("revisions", """
SELECT l_orderkey AS leg_id, l_linenumber AS rev, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn
      FROM lineitem) x WHERE rn = 1""")
role("cust_region", """
SELECT c_custkey, n_name, lower(r_name) AS market
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
role("run_header", """
SELECT o.o_orderkey AS leg_id, o.o_orderkey AS run_number, o.o_custkey AS user_id,
       'src' || CAST(o.o_custkey % 3 AS VARCHAR) AS source_database,
       CAST(o.o_orderdate AS DATE) AS service_date,
       o.o_orderdate + to_hours(o.o_orderkey % 24) AS pickup_time,
       o.o_orderdate + to_hours(o.o_orderkey % 24) - to_hours(o.o_orderkey % 72) AS created,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 WHEN o.o_orderstatus = 'O' THEN -1
                 WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0 THEN 0 END AS INTEGER) AS last_status_id,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'lost' END AS lost_call_status,
       o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS emergency,
       o.o_orderpriority AS level_of_service, ct.calltype_name,
       o.o_totalprice / 900.0 AS mileage, cr.market, cr.n_name AS state, p.rev,
       CASE o.o_orderkey // 3 % 4 WHEN 0 THEN 'Dialysis' WHEN 1 THEN 'Doctors Appointment' WHEN 3 THEN 'Discharge' END AS reason_for_transport,
       IF(o.o_orderkey % 13 = 0, 'Vet Ride North', 'Facility') AS source_name, CAST(o.o_orderkey % 5 AS INTEGER) AS canceled_reason_id,
       IF(o.o_orderkey % 4 = 0, 'caller', NULL) AS cancel_reason_text, CAST(o.o_orderkey % 29 = 0 AS INTEGER) AS deleted
FROM orders o
LEFT JOIN call_types ct ON ct.o_orderpriority = o.o_orderpriority
LEFT JOIN cust_region cr ON cr.c_custkey = o.o_custkey
LEFT JOIN (SELECT leg_id, max(rev) AS rev FROM revisions GROUP BY leg_id) p ON p.leg_id = o.o_orderkey""",
     "call_types", "cust_region", "revisions")
role("stage_base", """
SELECT h.*, r.l_partkey, r.l_suppkey, r.l_quantity, r.l_extendedprice, r.l_discount, r.l_tax,
       r.l_returnflag, r.l_linestatus, r.l_shipdate,
       h.pickup_time - to_minutes(CAST(round(r.l_discount * 100) AS BIGINT)) AS assigned_time,
       h.pickup_time + to_minutes(CAST(r.l_quantity AS BIGINT) - 20) AS scene_raw,
       CAST(round(r.l_tax * 10000) AS BIGINT) AS clear_off
FROM run_header h JOIN revisions r ON h.leg_id = r.leg_id AND h.rev = r.rev""", "run_header", "revisions")
role("stage_times", """
SELECT * EXCLUDE (scene_raw, clear_off),
       created AS call_started_time,
       assigned_time + to_minutes(2) AS acknowledged_time,
       assigned_time + to_minutes(5) AS enroute_time,
       CASE WHEN rev % 5 = 0 THEN NULL ELSE scene_raw END AS at_scene_time,
       CASE WHEN rev % 7 = 0 THEN NULL ELSE scene_raw + to_minutes(10) END AS transporting_time,
       scene_raw + to_minutes(35) AS at_destination_time,
       scene_raw + to_minutes(clear_off) AS clear_time,
       CASE WHEN last_status_id IS NULL OR last_status_id < 0 THEN pickup_time - to_minutes(30) END AS canceled_time
FROM stage_base""", "stage_base")
role("runs_base", f"""
SELECT *,
  {OUTCOME_SQL} AS run_outcome,
  {region_market_sql()} AS region,
  service_date AS date_of_service,
  dayname(pickup_time) AS day_of_week,
  strftime(pickup_time, '%H') || '00' AS hour_of_day,
  COALESCE(mileage > 50, FALSE) AS is_long_distance,
  COALESCE(calltype_name IN ('ALS', 'BLS', 'CCT'), FALSE) AS is_transport_run,
  COALESCE(calltype_name = 'CCT', FALSE) AS is_critical_care,
  COALESCE(level_of_service LIKE '%Flight%', FALSE) OR COALESCE(calltype_name LIKE '%Flight%', FALSE) AS is_flight_crew,
  {rn(mins('at_scene_time', 'pickup_time'))} AS pickup_variance_minutes,
  COALESCE({mins('at_scene_time', 'pickup_time')} <= 15, FALSE) AS is_on_time,
  {mins('transporting_time', 'at_scene_time')} AS scene_time_minutes,
  {mins('clear_time', 'at_destination_time')} AS destination_to_clear_minutes
FROM stage_times""", "stage_times")
role("runs", f"""
SELECT *,
  CASE WHEN raw_time_on_task_minutes IS NULL THEN NULL
       WHEN raw_time_on_task_minutes <= 720 THEN raw_time_on_task_minutes
       WHEN COALESCE(mileage, 0) < 500 THEN 100.0
       WHEN mileage >= 500 THEN least(raw_time_on_task_minutes, 1440.0) END AS time_on_task_minutes
FROM (SELECT *, CASE WHEN clear_time > enroute_time THEN {rn(mins('clear_time', 'enroute_time'))} END AS raw_time_on_task_minutes
      FROM runs_base) x""", "runs_base")
role("cost_centers", """
SELECT CAST(row_number() OVER (PARTITION BY src ORDER BY p_type) - 1 AS INTEGER) AS cost_center_id, p_type AS cost_center_name, src AS source_database
FROM (SELECT DISTINCT p_type FROM part) t, (VALUES ('src0'), ('src1'), ('src2')) v(src)""")
role("seat_needs", """
SELECT p.src AS source_database, p.unit_id, p.slot, t.name AS required_qualification, t.licence AS min_licensure_id, t.lvl AS min_level_id
FROM (SELECT 'src' || (user_id % 3)::VARCHAR AS src, user_id // 6 AS unit_id, event_id % 2 AS slot, arg_max(event_id // 2 % 6, event_id) AS template
      FROM events WHERE event_type = 'signup' GROUP BY ALL) p
LEFT JOIN (VALUES (0, 'EMT', 1, 1), (1, 'Paramedic', 2, 2), (2, 'Third Party', NULL, NULL), (3, 'FTO Paramedic', 2, 3), (4, 'Nurse', 3, 2)) t(id, name, licence, lvl) ON t.id = p.template""")
role("shift_base", """
SELECT event_id AS assignment_id,
       CAST(CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS BIGINT) AS user_id,
       'src' || CAST(user_id % 3 AS VARCHAR) AS source_database,
       CAST(CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id // 6 END AS BIGINT) AS unit_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST(floor(hour(ts) / 6) * 6 AS BIGINT)) AS shift_start,
       CAST(event_id % 6 AS INTEGER) AS cost_center_id,
       CAST(4 + event_id % 9 AS INTEGER) AS span_hours,
       IF(event_id % 37 = 0, 'false', 'true') AS published, IF(event_id % 43 = 0, 'Swap', 'Regular') AS seat_type, CAST(event_id % 2 AS INTEGER) AS position_slot,
       CASE event_id % 4 WHEN 0 THEN 'Regular' WHEN 1 THEN 'Overtime' WHEN 2 THEN 'Holiday' END AS earning_code
FROM events WHERE event_type = 'signup' AND event_id % 41 <> 0""")
role("shifts", """
SELECT b.*, b.shift_start + to_hours(b.span_hours) AS shift_end, CAST(b.shift_start AS DATE) AS date_line,
       'Unit ' || CAST(b.unit_id AS VARCHAR) AS unit_name, cc.cost_center_name, n.required_qualification, n.min_licensure_id, n.min_level_id
FROM shift_base b LEFT JOIN cost_centers cc ON cc.cost_center_id = b.cost_center_id AND cc.source_database = b.source_database
LEFT JOIN seat_needs n ON n.source_database = b.source_database AND n.unit_id = b.unit_id AND n.slot = b.position_slot""",
     "shift_base", "cost_centers", "seat_needs")
role("match_seats", """
SELECT s.* FROM shifts s WHERE published = 'true' AND seat_type = 'Regular'
  AND EXISTS (SELECT 1 FROM users u WHERE u.user_id = s.user_id AND u.source_database = s.source_database)""", "shifts", "users")
role("punches", """
SELECT event_id AS time_id, user_id AS time_user_id, event_id + 1 AS shift_assignment_id,
       epoch_us(ts) // 1000000 AS time_start_ts,
       CASE WHEN event_id % 17 = 0 THEN CAST(0 AS BIGINT)
            ELSE epoch_us(ts) // 1000000 + CAST(round(value * 60) AS BIGINT) END AS time_end_ts,
       'src' || CAST(user_id % 3 AS VARCHAR) AS source_database, ts AS date_created
FROM events WHERE event_type IN ('click', 'view')""")
role("punch_local", """
SELECT p.*,
  CAST(to_timestamp(p.time_start_ts) AT TIME ZONE COALESCE(z.local_tz, 'UTC') AS TIMESTAMP) AS clock_in_time,
  CASE WHEN p.time_end_ts <> 0
       THEN CAST(to_timestamp(p.time_end_ts) AT TIME ZONE COALESCE(z.local_tz, 'UTC') AS TIMESTAMP) END AS clock_out_time
FROM punches p LEFT JOIN source_zones z ON z.source_database = p.source_database""", "punches", "source_zones")
role("pairs", """
SELECT s.source_database, s.assignment_id, p.time_id,
       CASE WHEN s.assignment_id = p.shift_assignment_id THEN 'direct_match' ELSE 'fuzzy_match' END AS match_type
FROM match_seats s JOIN punches p ON p.time_user_id = s.user_id AND p.source_database = s.source_database
 AND (s.assignment_id = p.shift_assignment_id
      OR abs((epoch_us(s.shift_start) // 1000000) - p.time_start_ts) < 3600
      OR (p.time_start_ts >= epoch_us(s.shift_start) // 1000000
          AND p.time_start_ts < epoch_us(s.shift_end) // 1000000))
WHERE s.user_id IS NOT NULL""", "match_seats", "punches")
role("matches", """
SELECT s.source_database, s.assignment_id, s.user_id, s.shift_start AS scheduled_start,
       s.shift_end AS scheduled_end, s.date_line, s.cost_center_id,
       p.time_id, p.time_user_id, p.clock_in_time, p.clock_out_time, p.time_start_ts, p.time_end_ts,
       CASE WHEN p.time_end_ts <> 0 THEN p.clock_out_time
            WHEN p.time_id IS NOT NULL THEN s.shift_end END AS effective_clock_out,
       p.time_id IS NOT NULL AS has_timesheet,
       p.time_id IS NOT NULL AND p.time_end_ts = 0 AS is_clocked_in,
       p.time_id IS NOT NULL AND p.time_end_ts <> 0 AS is_clocked_out,
       TRUE AS has_assignment,
       COALESCE(m.match_type, 'no_timesheet') AS match_type
FROM match_seats s
LEFT JOIN pairs m ON (m.source_database, m.assignment_id) = (s.source_database, s.assignment_id)
LEFT JOIN punch_local p ON (p.source_database, p.time_id) = (m.source_database, m.time_id)
WHERE s.user_id IS NOT NULL""", "match_seats", "pairs", "punch_local")
role("schedule", f"""
SELECT s.*, m.time_id, m.clock_in_time, m.clock_out_time, m.effective_clock_out,
       COALESCE(m.has_timesheet, FALSE) AS has_timesheet,
       COALESCE(m.is_clocked_in, FALSE) AS is_clocked_in,
       COALESCE(m.is_clocked_out, FALSE) AS is_clocked_out,
       m.match_type AS timesheet_match_type,
       CASE WHEN s.user_id IS NULL THEN 'OPEN' ELSE 'ASSIGNED' END AS assignment_status,
       CASE WHEN s.user_id IS NOT NULL THEN {hrs('s.shift_end', 's.shift_start')} ELSE 0.0 END AS scheduled_hours,
       CASE WHEN s.user_id IS NULL THEN {hrs('s.shift_end', 's.shift_start')} ELSE 0.0 END AS open_hours,
       CASE WHEN m.clock_in_time IS NOT NULL AND m.effective_clock_out IS NOT NULL
            THEN {hrs('m.effective_clock_out', 'm.clock_in_time')} END AS hours_worked
FROM shifts s LEFT JOIN matches m ON (m.source_database, m.assignment_id) = (s.source_database, s.assignment_id)""", "shifts", "matches")
role("users", """
SELECT c_custkey AS user_id, 'src' || CAST(c_custkey % 3 AS VARCHAR) AS source_database,
       c_name AS username, split_part(c_name, '#', 1) AS last_name, split_part(c_name, '#', 2) AS first_name,
       c_mktsegment AS job_title, cr.n_name AS state, cr.market,
       CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS disabled,
       CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS deactivated,
       round(abs(c_acctbal) / 100.0, 2) AS hourly_wage
FROM customer c LEFT JOIN cust_region cr USING (c_custkey)""", "cust_region")
role("shift_mart", f"""
SELECT x.*,
  COALESCE(vcc.is_allowed, FALSE) AND NOT x.is_special_event AND NOT x.is_training AS is_field_shift,
  x.user_id IS NULL AS is_open,
  x.user_id IS NOT NULL AND x.clock_in_time IS NULL AND x.date_line < DATE '2024-01-25' AS is_no_show,
  COALESCE(x.user_id IS NOT NULL AND x.hours_worked IS NOT NULL
           AND x.hours_worked < x.scheduled_hours * 0.9, FALSE) AS is_partial_shift,
  {region_cc_sql('x.cost_center_name', 'x.source_database')} AS region,
  {level_sql('x.cost_center_name')} AS level_of_service,
  x.date_line AS shift_date,
  {rn('x.scheduled_hours')} AS scheduled_hours_r,
  {rn('x.hours_worked')} AS actual_hours_worked,
  CASE WHEN x.hours_worked IS NOT NULL THEN {rn('x.hours_worked - x.scheduled_hours')} END AS hours_variance,
  x.assignment_status = 'ASSIGNED' AS is_assigned
FROM (SELECT *,
        COALESCE(cost_center_name LIKE '%PROMO%', FALSE) OR COALESCE(required_qualification IN ('Third Party', 'FTO Paramedic'), FALSE) AS is_training,
        COALESCE(cost_center_name LIKE 'LARGE%', FALSE) AS is_special_event,
        COALESCE(cost_center_name LIKE 'ECON%', FALSE) AS is_orientation
      FROM schedule) x
LEFT JOIN (SELECT DISTINCT cost_center_id, source_database, TRUE AS is_allowed FROM valid_cost_centers) vcc
  ON vcc.cost_center_id = x.cost_center_id AND vcc.source_database = x.source_database""",
     "schedule", "valid_cost_centers")

role("seat_punch", f"""
SELECT source_database, assignment_id,
       sum(CASE WHEN clock_in_time IS NOT NULL AND effective_clock_out IS NOT NULL
                THEN {hrs('effective_clock_out', 'clock_in_time')} END) AS hours_worked,
       min(clock_in_time) AS clock_in_time, count(*) AS punch_count
FROM matches WHERE time_id IS NOT NULL GROUP BY source_database, assignment_id""", "matches")
role("seats", f"""
SELECT x.*, COALESCE(v.is_allowed, FALSE) AND NOT x.is_special_event AND NOT x.is_training AS is_field_shift
FROM (
  SELECT s.*, sp.hours_worked, sp.clock_in_time, COALESCE(sp.punch_count, 0) AS punch_count,
    CASE WHEN s.user_id IS NULL THEN 'OPEN' ELSE 'ASSIGNED' END AS assignment_status,
    s.user_id IS NULL AS is_open,
    CASE WHEN s.user_id IS NOT NULL THEN {hrs('s.shift_end', 's.shift_start')} ELSE 0.0 END AS scheduled_hours,
    CASE WHEN s.user_id IS NULL THEN {hrs('s.shift_end', 's.shift_start')} ELSE 0.0 END AS open_hours,
    {sunday_week('s.date_line')} AS week_start, dayname(s.date_line) AS day_name,
    CAST(dayofweek(s.date_line) AS INTEGER) AS day_of_week,
    {region_cc_sql('s.cost_center_name', 's.source_database')} AS region,
    {level_sql('s.cost_center_name')} AS level_of_service,
    CASE WHEN sp.hours_worked IS NOT NULL THEN {rn("sp.hours_worked - CASE WHEN s.user_id IS NOT NULL THEN " + hrs('s.shift_end', 's.shift_start') + " ELSE 0.0 END")} END AS hours_variance,
    u.last_name || ', ' || u.first_name AS assigned_name, u.job_title,
    COALESCE(s.cost_center_name LIKE '%PROMO%', FALSE) OR COALESCE(s.required_qualification IN ('Third Party', 'FTO Paramedic'), FALSE) AS is_training,
    COALESCE(s.cost_center_name LIKE 'LARGE%', FALSE) AS is_special_event,
    COALESCE(s.cost_center_name LIKE 'ECON%', FALSE) AS is_orientation
  FROM shifts s
  LEFT JOIN seat_punch sp ON (sp.source_database, sp.assignment_id) = (s.source_database, s.assignment_id)
  LEFT JOIN users u ON u.user_id = s.user_id AND u.source_database = s.source_database) x
LEFT JOIN (SELECT DISTINCT cost_center_id, source_database, TRUE AS is_allowed FROM valid_cost_centers) v
  ON v.cost_center_id = x.cost_center_id AND v.source_database = x.source_database""",
     "shifts", "seat_punch", "users", "valid_cost_centers")
role("periods", """
SELECT CAST(year(start_date) AS INTEGER) AS pay_period_year,
       CAST(floor(date_diff('day', DATE '2023-12-24', start_date) / 14) + 1 AS INTEGER) AS pay_period_number,
       start_date, start_date + 13 AS end_date
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-24 00:00:00',
                                         CAST((SELECT max(date_line) FROM shifts) AS TIMESTAMP),
                                         INTERVAL 14 DAY)) AS DATE) AS start_date) g""", "shifts")
role("seat_periods", """
SELECT s.*, p.pay_period_year, p.pay_period_number, p.start_date AS pay_period_start, p.end_date AS pay_period_end,
       CASE WHEN p.start_date IS NOT NULL THEN CASE WHEN date_diff('day', p.start_date, s.date_line) < 7 THEN 1 ELSE 2 END END AS period_week
FROM seats s LEFT JOIN periods p ON s.date_line BETWEEN p.start_date AND p.end_date""", "seats", "periods")
role("report_shifts", f"""
SELECT *, CASE WHEN COALESCE(scheduled_hours, 0.0) = 0 THEN COALESCE({hrs('shift_end', 'shift_start')}, 0.0) ELSE scheduled_hours END AS report_hours,
       {sunday_week('date_line')} AS calendar_week
FROM seat_periods WHERE pay_period_start IS NOT NULL""", "seat_periods")
role("weekly", """
SELECT source_database, user_id, week_start, sum(scheduled_hours) AS weekly_scheduled_hours,
       sum(COALESCE(hours_worked, 0.0)) AS weekly_actual_hours, count(*) AS shift_count,
       greatest(sum(scheduled_hours) - 40.0, 0.0) AS overtime_hours,
       greatest(sum(COALESCE(hours_worked, 0.0)) - 40.0, 0.0) AS actual_overtime_hours,
       sum(scheduled_hours) > 40.0 AS is_overtime
FROM seats WHERE user_id IS NOT NULL GROUP BY source_database, user_id, week_start""", "seats")

role("crew_link", """
SELECT l.l_orderkey AS leg_id, l.l_suppkey * 3 + o.o_custkey % 3 AS crew_user_id, 'src' || (o.o_custkey % 3)::VARCHAR AS source_database,
       CAST(o.o_orderdate AS DATE) AS seat_day,
       l.l_suppkey * 100000 + date_diff('day', DATE '1994-12-25', CAST(o.o_orderdate AS DATE)) AS shift_assignment_id
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
role("crew_shifts", """
SELECT shift_assignment_id AS assignment_id, crew_user_id AS user_id,
       source_database, seat_day AS date_line, CAST(seat_day AS TIMESTAMP) + INTERVAL 6 HOUR AS shift_start,
       CAST(seat_day AS TIMESTAMP) + INTERVAL 18 HOUR AS shift_end,
       'Unit ' || CAST(crew_user_id // 15 AS VARCHAR) AS unit_name,
       CAST(crew_user_id // 3 % 6 AS INTEGER) AS cost_center_id
FROM (SELECT DISTINCT source_database, crew_user_id, shift_assignment_id, seat_day FROM crew_link) x""", "crew_link")
role("crew_seats", f"""
SELECT s.*, cc.cost_center_name, u.last_name || ', ' || u.first_name AS assigned_name, u.job_title, v.special_event,
       {hrs('s.shift_end', 's.shift_start')} AS scheduled_hours,
       {hrs('s.shift_end', 's.shift_start')} - (s.user_id % 3) AS actual_hours_worked,
       s.date_line AS shift_date, COALESCE(cc.cost_center_name LIKE '%PROMO%', FALSE) AS is_training
FROM crew_shifts s
LEFT JOIN cost_centers cc ON cc.cost_center_id = s.cost_center_id AND cc.source_database = s.source_database
LEFT JOIN users u ON u.user_id = s.user_id AND u.source_database = s.source_database
JOIN valid_cost_centers v ON v.cost_center_id = s.cost_center_id AND v.source_database = s.source_database""",
     "crew_shifts", "cost_centers", "users", "valid_cost_centers")
role("run_crew", f"""
SELECT r.leg_id, r.run_number, r.service_date, r.calltype_name, r.pickup_time,
       r.assigned_time, r.at_scene_time, r.clear_time,
       {mins('r.clear_time', 'r.assigned_time')} AS time_on_task_minutes,
       {mins('r.transporting_time', 'r.at_scene_time')} + {mins('r.clear_time', 'r.at_destination_time')} AS time_on_task_excl_transport_minutes,
       {mins('r.transporting_time', 'r.at_scene_time')} AS scene_time_minutes,
       {mins('r.at_destination_time', 'r.transporting_time')} AS transport_time_minutes,
       {mins('r.clear_time', 'r.at_destination_time')} AS destination_to_clear_minutes,
       {mins('r.at_scene_time', 'r.acknowledged_time')} AS response_time_minutes,
       l.shift_assignment_id, s.assignment_id, s.source_database, s.user_id, s.assigned_name, s.job_title,
       s.shift_date, s.shift_start, s.shift_end, s.scheduled_hours, s.actual_hours_worked, s.unit_name,
       s.cost_center_id, s.cost_center_name, s.is_training, s.special_event
FROM stage_times r
JOIN crew_link l ON l.leg_id = r.leg_id AND l.source_database = r.source_database
JOIN crew_seats s ON l.shift_assignment_id = s.assignment_id AND l.source_database = s.source_database
WHERE r.canceled_time IS NULL AND r.assigned_time IS NOT NULL AND r.clear_time IS NOT NULL
  AND r.clear_time > r.assigned_time AND {mins('r.clear_time', 'r.assigned_time')} > 0
  AND {mins('r.clear_time', 'r.assigned_time')} < 720""", "stage_times", "crew_link", "crew_seats")
role("shift_metrics", f"""
SELECT *,
  CASE WHEN scheduled_hours > 0 THEN total_time_on_task_hours / scheduled_hours END AS time_on_task_pct,
  CASE WHEN scheduled_hours > 0 THEN total_runs / scheduled_hours END AS unit_hour_utilization,
  {hrs('last_run_clear_time', 'first_run_assigned_time')} AS active_shift_hours
FROM (
  SELECT assignment_id, source_database, user_id, assigned_name, job_title, shift_date, shift_start, shift_end,
         scheduled_hours, actual_hours_worked, unit_name, cost_center_id, cost_center_name, is_training, special_event,
         count(DISTINCT leg_id) AS total_runs, sum(time_on_task_minutes) / 60.0 AS total_time_on_task_hours,
         avg(destination_to_clear_minutes) AS avg_destination_time_minutes, avg(transport_time_minutes) AS avg_transport_time_minutes,
         avg(time_on_task_minutes) AS avg_time_on_task_minutes, avg(scene_time_minutes) AS avg_scene_time_minutes,
         avg(response_time_minutes) AS avg_response_time_minutes,
         min(assigned_time) AS first_run_assigned_time, max(clear_time) AS last_run_clear_time
  FROM run_crew GROUP BY ALL) g""", "run_crew")
role("run_metrics", f"""
SELECT *, {region_cc_sql()} AS region, time_on_task_minutes / 60.0 AS time_on_task_hours,
       time_on_task_excl_transport_minutes / 60.0 AS time_on_task_excl_transport_hours,
       CASE WHEN scheduled_hours > 0 THEN time_on_task_minutes / 60.0 / scheduled_hours * 100 END AS run_tot_pct_of_shift,
       CAST(hour(assigned_time) AS INTEGER) AS assigned_hour, CAST(dayofweek(service_date) AS INTEGER) AS day_of_week,
       dayname(service_date) AS day_name, CAST(date_trunc('week', service_date) AS DATE) AS week_start,
       CAST(date_trunc('month', service_date) AS DATE) AS month_start
FROM (SELECT *, row_number() OVER (PARTITION BY leg_id, source_database ORDER BY shift_assignment_id) AS rk
      FROM run_crew WHERE calltype_name IN ('ALS', 'BLS', 'CCT')) x
WHERE rk = 1""", "run_crew")
_PARTS = {"scene_time": "scene_time_minutes", "destination_time": "destination_to_clear_minutes", "transport_time": "transport_time_minutes"}
_AVGS = {"time_on_task": "time_on_task_minutes", "time_on_task_excl_transport": "time_on_task_excl_transport_minutes", "response_time": "response_time_minutes"} | _PARTS
_SUMS = {"time_on_task": "time_on_task_minutes", "time_on_task_excl_transport": "time_on_task_excl_transport_minutes"} | _PARTS
role("day_keys", f"""
SELECT DISTINCT shift_date AS service_date, source_database, region FROM run_metrics
UNION SELECT shift_date, source_database, {region_cc_sql()} FROM crew_seats""", "run_metrics", "crew_seats")
role("day_hours", f"""
SELECT shift_date AS service_date, source_database, {region_cc_sql()} AS region, sum(actual_hours_worked) / 2.0 AS sched,
       count(DISTINCT CASE WHEN actual_hours_worked > 0 THEN cost_center_id END) AS centers
FROM crew_seats WHERE NOT special_event AND is_training IS DISTINCT FROM TRUE GROUP BY ALL""", "crew_seats")
role("reconcile", f"""
SELECT k.*, COALESCE(r.n, 0) AS total_runs, {", ".join(f"COALESCE(r.sum_{n}, 0.0) / 60.0 AS total_{n}_hours" for n in _SUMS)},
       {", ".join(f"r.avg_{n} AS avg_{n}_minutes" for n in _AVGS)}, COALESCE(h.sched, 0.0) AS total_scheduled_hours, COALESCE(h.centers, 0) AS total_shifts
FROM day_keys k
LEFT JOIN (SELECT shift_date AS service_date, source_database, region, count(DISTINCT leg_id) AS n, {", ".join(f"sum({c}) AS sum_{n}" for n, c in _SUMS.items())},
                  {", ".join(f"avg({c}) AS avg_{n}" for n, c in _AVGS.items())} FROM run_metrics GROUP BY ALL) r USING (service_date, source_database, region)
LEFT JOIN day_hours h USING (service_date, source_database, region)""", "day_keys", "day_hours", "run_metrics")
role("history_log", """
SELECT event_id AS id, 'src' || (user_id % 3)::VARCHAR AS source_database, CAST(json_extract_string(props, '$.k') AS BIGINT) AS leg_id, 'canceled_time' AS field, user_id,
       ts AS changed_at
FROM events WHERE event_type = 'error'""")
role("leg_lines", """
SELECT l.*, l.l_orderkey * 100000 + l.l_linenumber AS attachment_id, 'src' || (o.o_custkey % 3)::VARCHAR AS source_database, o.o_custkey % 3 AS k
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
role("upload_log", """
SELECT e.attachment_id AS log_id, e.attachment_id, e.l_suppkey * 3 + e.k AS user_id, 'create' AS action, e.l_shipdate AS action_timestamp, 'file-' || f.attachment_id || '.pdf' AS file_name,
       f.l_shipdate AS attachment_date, g.attachment_id * 2 AS leg_attachment_id, g.l_orderkey AS leg_id, e.source_database, COALESCE(t.types, 'Unspecified') AS attachment_types
FROM leg_lines e JOIN leg_lines f ON f.attachment_id = e.attachment_id AND f.l_linenumber <= 6 JOIN leg_lines g ON g.attachment_id = e.attachment_id AND g.l_quantity > 1
LEFT JOIN (SELECT attachment_id, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM leg_lines LEFT JOIN part ON p_partkey = l_partkey WHERE l_linestatus = 'F' GROUP BY 1) t
  ON t.attachment_id = g.attachment_id
WHERE e.l_returnflag = 'R'""", "leg_lines")
role("final_records", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_database, run_number ORDER BY finalized DESC NULLS LAST, id DESC) AS nth FROM (
  SELECT o_orderkey * 2 AS id, o_orderkey::VARCHAR AS run_number, 'src' || (o_custkey % 3)::VARCHAR AS source_database, o_custkey % 100 * 3 + o_custkey % 3 AS finalizer_id,
         IF(o_orderkey % 4 <> 0, 1, NULL) AS finalized FROM orders
  UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey::VARCHAR, 'src' || (o_custkey % 3)::VARCHAR, IF(o_orderkey % 5 <> 0, o_orderkey % 10 * 3 + o_custkey % 3, NULL),
         o_orderkey % 2 FROM orders WHERE o_orderkey % 3 = 0)) WHERE nth = 1""")
role("qa_runs", """
SELECT d.doc_id, d.source, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)""")


def with_roles(*names: str) -> str:
    """``WITH`` clause containing the named roles and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in ROLES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({ROLES[n][0]}\n)" for n in order) + "\n"
