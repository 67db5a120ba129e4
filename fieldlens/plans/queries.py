"""Query plans: each registered query composes library operators over the role views of
the driver tables. Every function takes ``(spark, root)`` and returns a DataFrame. Shared
models are written when a query first needs them (``plans/models.py``), streams run when
their query is built; all else runs when the result is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import scalars as S
from fieldlens.keyed import KeyedTable
from fieldlens.operators import calendar, classify, keys, marts, matching, metrics, slices, timeline
from fieldlens.session import scratch_path
from fieldlens.sources import roles, tables
from fieldlens.plans.models import table_model
from fieldlens.sources.roles import AS_OF_EVENTS, AS_OF_ORDERS

R4 = 4


def r4(c) -> F.Column:
    return S.round_half(c, R4)


# ---------------------------------------------------------------- shared role builders
# Shared intermediates are table models (written once per build, see plans/models.py),
# mirroring the reference's table materializations of its timesheet and run models.

def stage_times(spark: SparkSession, root: str) -> DataFrame:
    # the rows are stored; the columns that follow from them are derived again by each reader
    return roles.stage_columns(spark, root, table_model(spark, root, "stage_rows", lambda: roles.stage_rows(spark, root)))


def runs(spark: SparkSession, root: str) -> DataFrame:
    # a projection over the stage-times model: cheaper to recompute than to store again
    return marts.run_mart(stage_times(spark, root))


def _matchable(spark: SparkSession, root: str) -> DataFrame:
    return matching.matchable(roles.shifts(spark, root), roles.users(spark, root))


def required_shifts(spark: SparkSession, root: str) -> DataFrame:
    """Seats with the qualification they require and their earning code."""
    return matching.with_requirements(roles.shifts(spark, root), roles.seat_personnel(spark, root), roles.templates(spark), roles.earning_codes(spark))


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    return table_model(spark, root, "pairs", lambda: matching.matched_pairs(_matchable(spark, root), roles.punches(spark, root)))


def _pairs_and_matches(spark: SparkSession, root: str):
    punches = matching.of_users(roles.punches(spark, root), roles.users(spark, root))
    return _matchable(spark, root), punches, roles.source_zones(spark), _pairs(spark, root)


def matches(spark: SparkSession, root: str) -> DataFrame:
    def build():
        sh, pu, zones, pairs = _pairs_and_matches(spark, root)
        return matching.match_intervals(sh, pu, zones, pairs=pairs)
    return table_model(spark, root, "matches", build)


def schedule(spark: SparkSession, root: str) -> DataFrame:
    return matching.schedule_fact(required_shifts(spark, root), matches(spark, root))


def shift_mart(spark: SparkSession, root: str) -> DataFrame:
    return marts.shift_mart(schedule(spark, root), roles.valid_cost_centers(spark), AS_OF_EVENTS)


# ---------------------------------------------------------------- orders / lineitem keys

def q_distinct_on(spark, root):
    return roles.revisions(spark, root).select("leg_id", "rev", "l_partkey", "l_suppkey", "l_shipdate",
                                               "l_extendedprice")


def q_current_revision(spark, root):
    return stage_times(spark, root).select("leg_id", "rev", "source_database", "service_date",
                                                 "l_partkey", "l_quantity")


def q_revision_full_join(spark, root):
    li = tables.load_table(spark, root, "lineitem",
                           ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                            "l_shipdate"])
    li = li.withColumnsRenamed({"l_orderkey": "leg_id", "l_linenumber": "rev"})
    hdr, revs = keys.pointed_revisions(roles.header_base(spark, root).select("leg_id", "run_number", "service_date"), li, "leg_id", "rev", roles.REVISION_ORDER)
    j = keys.revision_full_join_pointed(hdr, revs, "leg_id")
    return j.select("leg_id", "rev", "run_number", "service_date", "l_partkey", "l_quantity")


def q_star_enrich(spark, root):
    """Runs with twelve lookups. Nations, regions and the fixed lists are of known size and broadcast; the others are left to the optimizer."""
    st = stage_times(spark, root).select("leg_id", "rev", "user_id", "l_partkey", "l_suppkey", "market", "source_database", "canceled_reason_id", "service_date",
                                         F.col("level_of_service").alias("o_orderpriority"))
    part = tables.load_table(spark, root, "part", ["p_partkey", "p_type", "p_brand"])
    supp = tables.load_table(spark, root, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    cust = tables.load_table(spark, root, "customer", ["c_custkey", "c_name", "c_nationkey"])
    nat = tables.load_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    reg = tables.load_table(spark, root, "region", ["r_regionkey", "r_name"])

    def places(prefix: str, key: str) -> tuple[list[DataFrame], list[str]]:
        n = nat.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(f"{prefix}_nation"), F.col("n_regionkey").alias(f"{prefix}_regionkey"))
        r = reg.select(F.col("r_regionkey").alias(f"{prefix}_regionkey"), F.col("r_name").alias(f"{prefix}_region"))
        return [F.broadcast(n), F.broadcast(r)], [key, f"{prefix}_regionkey"]

    j = (st.join(part, st.l_partkey == part.p_partkey, "left").join(supp, st.l_suppkey == supp.s_suppkey, "left").join(cust, st.user_id == cust.c_custkey, "left"))
    for prefix, key in (("supplier", "s_nationkey"), ("customer", "c_nationkey")):
        for frame, on in zip(*places(prefix, key)):
            j = j.join(frame, on, "left")
    centers = roles.cost_centers(spark, root).select("cost_center_id", "source_database", F.col("cost_center_name").alias("p_type"))
    per = roles.periods(spark, st, "service_date", roles.PERIOD_ANCHOR_ORDERS)
    j = (j.join(F.broadcast(roles.call_types(spark)), "o_orderpriority", "left").join(F.broadcast(roles.source_zones(spark)), "source_database", "left")
         .join(F.broadcast(roles.cancel_reasons(spark)), ["canceled_reason_id", "source_database"], "left").join(centers, ["p_type", "source_database"], "left"))
    j = calendar.assign_period(j, per, "service_date")
    return j.select("leg_id", "rev", "p_type", "p_brand", "s_name", "supplier_nation", "supplier_region", "c_name", "customer_nation", "customer_region", "market",
                    "calltype_name", "local_tz", "cancel_reason_name", "cost_center_id", "pay_period_number")


def q_union_sources(spark, root):
    c = tables.load_table(spark, root, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    per_source = {f"src{i}": c.where(F.col("c_custkey") % 3 == i) for i in range(3)}
    u = tables.union_sources(per_source)
    return u.select(F.col("c_custkey").alias("user_id"), "source_database",
                    F.col("c_name").alias("username"), F.col("c_mktsegment").alias("job_title"),
                    F.concat(F.col("c_custkey").cast("string"), F.lit("_"), F.col("source_database"))
                    .alias("user_id_source"))


def q_window_scan(spark, root):
    e = tables.load_table(spark, root, "events", ["event_id", "ts", "user_id", "event_type"])
    w = tables.window_scan_policy(e, "modified", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 17),
                                  {"modified": "ts"})
    return w


def q_values_allowlist(spark, root):
    sh = roles.shifts(spark, root)
    allow = roles.valid_cost_centers(spark)
    j = sh.join(allow.select("cost_center_id", "source_database", "special_event"),
                ["cost_center_id", "source_database"], "inner")
    return j.select("assignment_id", "source_database", "cost_center_id", "cost_center_name", "special_event")


def q_region_classify(spark, root):
    r = roles.run_header(spark, root).select(
        F.lit("run").alias("entity"), F.col("leg_id").alias("entity_id"), "source_database",
        F.col("market").alias("rule_input"), classify.region_from_market().alias("region"), classify.division_from_market().alias("division"))
    s = roles.shifts(spark, root).select(
        F.lit("shift").alias("entity"), F.col("assignment_id").alias("entity_id"), "source_database",
        F.col("cost_center_name").alias("rule_input"), classify.region_from_cost_center().alias("region"), F.lit(None).cast("string").alias("division"))
    return r.unionByName(s)


def q_level_from_name(spark, root):
    return roles.shifts(spark, root).select("assignment_id", "cost_center_name",
                                            classify.level_from_name().alias("level_of_service"))


# ---------------------------------------------------------------- run timeline

def q_case_outcome(spark, root):
    return runs(spark, root).select("leg_id", "source_database", "last_status_id", "lost_call_status",
                                    "run_outcome", "day_of_week", "hour_of_day")


def q_stage_durations(spark, root):
    df = timeline.stage_durations(stage_times(spark, root))
    return df.select("leg_id", *[r4(n).alias(n) for n, _, _ in timeline.DEFAULT_STAGES])


def q_time_on_task(spark, root):
    df = timeline.time_on_task(stage_times(spark, root))
    return df.select("leg_id", r4("time_on_task_minutes").alias("time_on_task_minutes"),
                     r4("time_on_task_excl_transport_minutes").alias("time_on_task_excl_transport_minutes"))


def q_valid_runs(spark, root):
    df = timeline.valid_runs(timeline.time_on_task(stage_times(spark, root)))
    return df.select("leg_id", "source_database", r4("time_on_task_minutes").alias("time_on_task_minutes"))


def q_repair_duration(spark, root):
    df = runs(spark, root)
    return df.select("leg_id", r4("mileage").alias("mileage"),
                     r4("raw_time_on_task_minutes").alias("raw_time_on_task_minutes"),
                     r4("time_on_task_minutes").alias("time_on_task_minutes"))


def q_run_flags(spark, root):
    df = runs(spark, root)
    return df.select("leg_id", "is_long_distance", "is_transport_run", "is_critical_care", "is_flight_crew",
                     r4("pickup_variance_minutes").alias("pickup_variance_minutes"), "is_on_time")


def q_otp(spark, root):
    df = timeline.otp(runs(spark, root).where(F.col("run_outcome") == "ran"))
    return df.select("leg_id", "region", "calltype_name", "pickup_week_start",
                     r4("pickup_delay_minutes").alias("pickup_delay_minutes"), "is_on_time_strict", "is_on_time_grace")


def _sla_runs(spark, root):
    df = runs(spark, root).where(F.col("run_outcome") == "ran")
    df = df.withColumn("requested_time", F.when(F.col("leg_id") % 4 == 0,
                                                S.add_minutes("pickup_time", F.lit(-10))))
    df = timeline.sla_on_time(df)
    return df.withColumn("call_type", F.when(F.col("emergency"), "Emergency").otherwise("Non-Emergency"))


def q_sla_on_time(spark, root):
    df = _sla_runs(spark, root)
    return df.select("leg_id", "call_type", "sla_anchor_time", "sla_threshold_minutes",
                     r4("sla_response_minutes").alias("sla_response_minutes"),
                     r4("minutes_from_sla").alias("minutes_from_sla"), "is_sla_on_time")


def q_on_time_7row_ma(spark, root):
    df = metrics.on_time_ma(_sla_runs(spark, root))
    return df.select("date_of_service", "call_type", "total_calls", "on_time_calls", "on_time_percentage",
                     "on_time_percentage_7day_ma", "days_in_window")


def q_daily_demand(spark, root):
    return metrics.daily_demand(runs(spark, root))


def q_daily_dashboard(spark, root):
    return metrics.daily_dashboard(runs(spark, root))


def q_demand_heatmap(spark, root):
    return metrics.demand_heatmap(spark, runs(spark, root), AS_OF_ORDERS)


def q_daily_operations(spark, root):
    return metrics.daily_operations(runs(spark, root), shift_mart(spark, root), roles.users(spark, root))


# ---------------------------------------------------------------- shift + punch

def q_match_intervals(spark, root):
    m = matches(spark, root)
    return m.select("source_database", "assignment_id", "user_id", "scheduled_start", "scheduled_end",
                    "date_line", "time_id", "clock_in_time", "clock_out_time", "effective_clock_out",
                    "has_timesheet", "is_clocked_in", "is_clocked_out", "match_type")


def q_orphan_intervals(spark, root):
    sh, pu, zones, pairs = _pairs_and_matches(spark, root)
    o = matching.orphan_intervals(sh, pu, zones, pairs=pairs)
    return o.select("source_database", "user_id", "date_line", "time_id", "clock_in_time", "clock_out_time",
                    "effective_clock_out", "is_clocked_in", "match_type")


QUERIES = {
    "distinct_on": q_distinct_on,
    "current_revision": q_current_revision,
    "revision_full_join": q_revision_full_join,
    "star_enrich": q_star_enrich,
    "union_sources": q_union_sources,
    "window_scan": q_window_scan,
    "values_allowlist": q_values_allowlist,
    "region_classify": q_region_classify,
    "level_from_name": q_level_from_name,
    "case_outcome": q_case_outcome,
    "stage_durations": q_stage_durations,
    "time_on_task": q_time_on_task,
    "valid_runs": q_valid_runs,
    "repair_duration": q_repair_duration,
    "run_flags": q_run_flags,
    "otp": q_otp,
    "sla_on_time": q_sla_on_time,
    "on_time_7row_ma": q_on_time_7row_ma,
    "daily_demand": q_daily_demand,
    "daily_dashboard": q_daily_dashboard,
    "demand_heatmap": q_demand_heatmap,
    "daily_operations": q_daily_operations,
    "match_intervals": q_match_intervals,
    "orphan_intervals": q_orphan_intervals,
}


# ---------------------------------------------------------------- seats, staffing, periods
from fieldlens.operators import reports, staffing  # noqa: E402


def seats(spark, root) -> DataFrame:
    return table_model(spark, root, "seats", lambda: staffing.seat_fact(
        required_shifts(spark, root), matches(spark, root), roles.users(spark, root), roles.valid_cost_centers(spark)))


def event_periods(spark, root) -> DataFrame:
    return roles.periods(spark, roles.shifts(spark, root), "date_line")


def q_dedup_punches(spark, root):
    sc = schedule(spark, root)
    d = keys.distinct_on(sc.withColumn("_tid", F.coalesce("time_id", F.lit(-1))),
                         ["assignment_id", "source_database", "_tid"], [("clock_in_time", "asc_nulls_last")])
    return d.select("assignment_id", "source_database", "time_id", "clock_in_time")


def q_schedule_fact(spark, root):
    sc = matching.schedule_fact(required_shifts(spark, root), matches(spark, root), as_of=AS_OF_EVENTS)
    per = event_periods(spark, root)
    sc = calendar.assign_period(sc, per, "date_line")
    sc = calendar.flag_current_next(sc, per, AS_OF_EVENTS)
    return sc.select("assignment_id", "time_id", "assignment_status", "position_slot", "required_qualification", "min_licensure_id", "min_level_id", "earning_code", "published",
                     r4("scheduled_hours").alias("scheduled_hours"),
                     r4("open_hours").alias("open_hours"), r4("hours_worked").alias("hours_worked"),
                     "has_timesheet", "is_clocked_in", "timesheet_match_type", "pay_period_number",
                     "pay_period_start", "period_week", "is_current_pay_period", "is_next_pay_period",
                     "day_of_week", "day_name", "week_start", "month_start", "is_today", "is_future",
                     "is_today_or_future", "days_from_today")


def q_attendance_flags(spark, root):
    s = classify.attendance_flags(seats(spark, root), AS_OF_EVENTS)
    return s.select("assignment_id", "is_open", "is_no_show", "is_partial_shift")


def q_hours_fallback(spark, root):
    s = seats(spark, root)
    return s.select("assignment_id", r4(classify.hours_fallback()).alias("report_hours"))


def q_hours_variance(spark, root):
    s = seats(spark, root)
    return s.select("assignment_id", r4("hours_worked").alias("hours_worked"), "hours_variance")


def q_shift_flags(spark, root):
    s = seats(spark, root)
    return s.select("assignment_id", "is_training", "is_special_event", "is_orientation", "is_field_shift")


def q_epoch_to_local(spark, root):
    p = roles.punches(spark, root).join(roles.source_zones(spark), "source_database", "left")
    return p.select("time_id", "source_database", "local_tz",
                    S.epoch_to_local("time_start_ts", "local_tz").alias("clock_in_time"),
                    F.when(F.col("time_end_ts") != 0, S.epoch_to_local("time_end_ts", "local_tz"))
                    .alias("clock_out_time"))


def _named_schedule(spark, root) -> DataFrame:
    """The schedule fact with the names of its users."""
    u = roles.users(spark, root).select("user_id", "source_database", "first_name", "last_name", S.last_first("last_name", "first_name").alias("assigned_name"))
    return schedule(spark, root).join(u, ["user_id", "source_database"], "left")


def q_interval_flatten(spark, root):
    return slices.slice_facts(_named_schedule(spark, root))


def q_interval_members(spark, root):
    m = slices.slice_members(_named_schedule(spark, root))
    return m.select("unit_name", "cost_center_id", "date_line", "source_database", "assignment_id", "crew_member_name", "crew_full_name", "member_from", "member_to")


def q_interval_crew_report(spark, root):
    """The slices of a week with their crews' names."""
    week = F.col("date_line").between(F.lit(AS_OF_EVENTS - dt.timedelta(days=6)), F.lit(AS_OF_EVENTS))
    seats = _named_schedule(spark, root)
    out = slices.crew_names(slices.slice_facts(seats).where(week), slices.slice_members(seats).where(week))
    return out.select("unit_name", "start_time", "end_time", "date_line", "cost_center_id", "crew_count", "crew_names", "crew_full_names")


def q_shift_partners(spark, root):
    p = staffing.shift_partners(seats(spark, root))
    return p.select("assignment_id", "source_database", "partner_count", "partner_names")


def q_staffing_status(spark, root):
    p = staffing.staffing(seats(spark, root))
    return p.select("assignment_id", "total_positions", "filled_positions", "open_positions", "staffing_status")


def _weekly(spark, root):
    return staffing.weekly_hours(seats(spark, root))


def q_weekly_overtime(spark, root):
    w = _weekly(spark, root)
    return w.select("source_database", "user_id", "week_start",
                    r4("weekly_scheduled_hours").alias("weekly_scheduled_hours"),
                    r4("weekly_actual_hours").alias("weekly_actual_hours"), "shift_count",
                    r4("overtime_hours").alias("overtime_hours"), "is_overtime")


def q_period_overtime(spark, root):
    rs = calendar.assign_period(seats(spark, root), event_periods(spark, root), "date_line")
    p = staffing.period_overtime(rs)
    return p.select("source_database", "user_id", "pay_period_start",
                    *[r4(c).alias(c) for c in ("pp_scheduled_hours", "pp_actual_hours", "pp_scheduled_ot",
                                               "pp_actual_ot")], "pp_shift_count", "has_overtime_week")


def q_overtime_summary(spark, root):
    o = staffing.overtime_summary(_weekly(spark, root))
    return o.select("source_database", "employees", "employees_with_overtime", "overtime_weeks",
                    r4("total_overtime_hours").alias("total_overtime_hours"))


def q_cumulative_hours(spark, root):
    c = staffing.cumulative_hours(seats(spark, root))
    return c.select("assignment_id", "user_id", "week_start", r4("cumulative_hours").alias("cumulative_hours"))


def q_urgency_flags(spark, root):
    u = classify.urgency_flags(seats(spark, root), AS_OF_EVENTS)
    return u.select("assignment_id", "days_until_shift", "is_today", "is_tomorrow", "is_within_3_days")


def q_daily_open_summary(spark, root):
    d = staffing.daily_open_summary(seats(spark, root))
    return d.select("assignment_id", "region", "date_line", "open_shift_count",
                    r4("open_hours_day").alias("open_hours_day"))


def q_scheduling_summary(spark, root):
    s = staffing.scheduling_summary(seats(spark, root))
    ot = ("total_overtime_hours_scheduled", "total_overtime_hours_worked")
    return s.select(*[r4(c).alias(c) if c in ot else F.col(c) for c in s.columns])


def q_dense_grid(spark, root):
    return staffing.hours_grid(spark, seats(spark, root), roles.valid_cost_centers(spark),
                               AS_OF_EVENTS - dt.timedelta(days=35), AS_OF_EVENTS)


def q_shift_slice(spark, root):
    per = calendar.period_for(event_periods(spark, root), AS_OF_EVENTS)
    lo, hi = per.select(F.max("start_date")).scalar(), per.select(F.max("end_date")).scalar()
    s = seats(spark, root).where((F.col("date_line") >= lo) & (F.col("date_line") <= hi))
    s = s.where((F.col("region") == "south") & ~F.col("is_training")
                & ~((F.col("assignment_status") == "OPEN") & F.col("is_special_event")))  # NOT (a AND b), FLT-10
    return s.select("assignment_id", "region", "date_line", "assignment_status",
                    r4(classify.hours_fallback()).alias("report_hours"))


def q_assign_period(spark, root):
    s = calendar.assign_period(seats(spark, root), event_periods(spark, root), "date_line")
    return s.select("assignment_id", "date_line", "pay_period_year", "pay_period_number", "pay_period_start",
                    "pay_period_end", "period_week")


def q_current_next_period(spark, root):
    c = calendar.current_next_period(event_periods(spark, root), AS_OF_EVENTS)
    return c.select("which", "pay_period_number", "start_date", "end_date")


def q_period_for_date(spark, root):
    p = calendar.period_for(event_periods(spark, root), AS_OF_EVENTS)
    return p.select("pay_period_year", "pay_period_number", "start_date", "end_date")


def _report_shifts(spark, root):
    return reports.report_shifts(seats(spark, root), event_periods(spark, root))


def q_reports_due(spark, root):
    d = reports.reports_due(event_periods(spark, root), seats(spark, root))
    return d.select("region", "report_type", "due_date", "period_start", "period_end")


def q_employee_hours_report(spark, root):
    e = reports.employee_hours(_report_shifts(spark, root))
    hcols = ["week1_hours", "week2_hours", "training_hours", "orientation_hours", "special_event_hours",
             "field_hours", "total_ot", "actual_hours", "total_hours", "variance"]
    return e.select("region", "pay_period_start", "user_id", "assigned_name", *[r4(c).alias(c) for c in hcols])


def q_open_hours_report(spark, root):
    o = reports.open_hours(_report_shifts(spark, root))
    return o.select("region", "pay_period_start", *[r4(c).alias(c) for c in o.columns
                                                   if c.startswith("open_")])


def q_report_with_totals(spark, root):
    t = reports.report_with_totals(_report_shifts(spark, root))
    return t.select("region", "pay_period_start", "row_label", "user_id", "row_kind",
                    r4("scheduled_hours").alias("scheduled_hours"), "shifts")


def q_daily_hours_variance(spark, root):
    d = reports.daily_hours_variance(_report_shifts(spark, root))
    return d.select("region", "pay_period_start", "date_line", *[r4(c).alias(c) for c in
                    ("scheduled_hours", "open_hours", "actual_hours", "variance")], "filled_shifts", "open_shifts")


def q_shift_report(spark, root):
    r = reports.shift_report(seats(spark, root), AS_OF_EVENTS)
    return r.select("assignment_id", "date_line", "unit_name", "assigned_name", "partner_names", "partner_count",
                    "staffing_status", r4("weekly_scheduled_hours").alias("weekly_scheduled_hours"), "is_overtime",
                    r4("cumulative_hours").alias("cumulative_hours"), "is_no_show", "is_partial_shift",
                    "days_until_shift", "open_shift_count")


def q_run_mart(spark, root):
    """The run mart (one row per run): outcome, region, flags, repaired time on task and
    the global pay period of the service day (range join as calendar explode, JN-10)."""
    r = runs(spark, root)
    per = roles.periods(spark, r, "service_date", roles.PERIOD_ANCHOR_ORDERS)
    r = calendar.assign_period(r, per, "service_date")
    return r.select("leg_id", "run_number", "source_database", "region", "service_date", "calltype_name",
                    "run_outcome", "is_long_distance", "is_on_time", r4("time_on_task_minutes").alias("time_on_task_minutes"),
                    "pay_period_year", "pay_period_number", "pay_period_start", "period_week")


def q_schedule_sheet(spark, root):
    sh = reports.schedule_sheet(_report_shifts(spark, root))
    return sh.select("region", "pay_period_start", "date_line", "assignment_id", "employee_name", "unit_name",
                     "cost_center_name", "start_text", "end_text", "hours", "training")


QUERIES.update({
    "schedule_sheet": q_schedule_sheet,
    "run_mart": q_run_mart,
    "shift_report": q_shift_report,
    "dedup_punches": q_dedup_punches,
    "schedule_fact": q_schedule_fact,
    "attendance_flags": q_attendance_flags,
    "hours_fallback": q_hours_fallback,
    "hours_variance": q_hours_variance,
    "shift_flags": q_shift_flags,
    "epoch_to_local": q_epoch_to_local,
    "interval_flatten": q_interval_flatten,
    "interval_members": q_interval_members,
    "interval_crew_report": q_interval_crew_report,
    "shift_partners": q_shift_partners,
    "staffing_status": q_staffing_status,
    "weekly_overtime": q_weekly_overtime,
    "period_overtime": q_period_overtime,
    "overtime_summary": q_overtime_summary,
    "cumulative_hours": q_cumulative_hours,
    "urgency_flags": q_urgency_flags,
    "daily_open_summary": q_daily_open_summary,
    "scheduling_summary": q_scheduling_summary,
    "dense_grid": q_dense_grid,
    "shift_slice": q_shift_slice,
    "assign_period": q_assign_period,
    "current_next_period": q_current_next_period,
    "period_for_date": q_period_for_date,
    "reports_due": q_reports_due,
    "employee_hours_report": q_employee_hours_report,
    "open_hours_report": q_open_hours_report,
    "report_with_totals": q_report_with_totals,
    "daily_hours_variance": q_daily_hours_variance,
})


# ---------------------------------------------------------------- runs x crew x shift, audit, quality
from fieldlens.operators import audit, crew, quality  # noqa: E402


def crew_link(spark, root) -> DataFrame:
    return roles.crew_link_columns(table_model(spark, root, "crew_link_rows", lambda: roles.crew_link_rows(spark, root)))


def crew_seats(spark, root) -> DataFrame:
    return table_model(spark, root, "crew_seats", lambda: crew.crew_seats(
        roles.crew_shifts(spark, root, crew_link(spark, root)), roles.cost_centers(spark, root),
        roles.users(spark, root), roles.valid_cost_centers(spark)))


def run_crew(spark, root) -> DataFrame:
    return table_model(spark, root, "run_crew", lambda: crew.run_crew(
        stage_times(spark, root), crew_link(spark, root), crew_seats(spark, root)))


def _shift_metrics(spark, root):
    return crew.shift_metrics(run_crew(spark, root))


def q_run_crew(spark, root):
    rc = run_crew(spark, root)
    return rc.select("leg_id", "source_database", "assignment_id", "user_id", "shift_date", "cost_center_name", "special_event",
                     r4("time_on_task_minutes").alias("time_on_task_minutes"))


def q_shift_metrics(spark, root):
    sm = _shift_metrics(spark, root)
    return sm.select("assignment_id", "total_runs", *[r4(c).alias(c) for c in (
        "total_time_on_task_hours", "avg_time_on_task_minutes", "avg_response_time_minutes", "time_on_task_pct",
        "unit_hour_utilization", "active_shift_hours")], "first_run_assigned_time", "last_run_clear_time")


def q_crew_daily(spark, root):
    sm = _shift_metrics(spark, root)
    cd = crew.crew_daily_report(crew.crew_daily(sm), sm)
    return cd.select("assignment_id", "shift_date", "partner_count", "partner_crew_members",
                     r4("active_time_efficiency_pct").alias("active_time_efficiency_pct"),
                     r4("actual_hours_efficiency_pct").alias("actual_hours_efficiency_pct"),
                     "day_of_week", "day_name", "week_start", "month_start")


def q_crew_efficiency_weekly(spark, root):
    w = crew.crew_weekly(_shift_metrics(spark, root))
    return w.select("user_id", "source_database", "week_start", "week_end", "shifts_worked", "total_calls_ran",
                    *[r4(c).alias(c) for c in ("avg_time_on_task_minutes", "avg_destination_time_minutes",
                                               "avg_transport_time_minutes", "avg_daily_uhu", "weekly_uhu",
                                               "time_on_task_pct", "total_active_hours")], "cost_centers_worked")


def _run_metrics(spark, root):
    return crew.run_metrics(run_crew(spark, root), weeks=None)


def q_run_metrics(spark, root):
    rm = _run_metrics(spark, root)
    return rm.select("leg_id", "assignment_id", "region", "service_date",
                     r4("time_on_task_hours").alias("time_on_task_hours"),
                     r4("run_tot_pct_of_shift").alias("run_tot_pct_of_shift"), "assigned_hour", "day_of_week",
                     "day_name", "week_start", "month_start")


def q_sequence_in_group(spark, root):
    s = crew.run_sequence(_run_metrics(spark, root))
    return s.select("assignment_id", "shift_date", "leg_id", "assigned_time", "run_sequence")


def _reconcile(spark, root):
    return crew.daily_reconcile(_run_metrics(spark, root), crew_seats(spark, root))


def q_reconcile_daily(spark, root):
    r = _reconcile(spark, root)
    return r.select("service_date", "source_database", "region", "total_runs",
                    *[r4(c).alias(c) for c in r.columns if c.endswith(("_hours", "_minutes"))], "total_shifts")


def q_time_on_task_daily(spark, root):
    t = crew.tot_daily(_reconcile(spark, root))
    return t.select("service_date", "source_database", "region", "total_runs", "total_shifts",
                    *[r4(c).alias(c) for c in t.columns if c.endswith(("_hours", "_minutes", "_pct", "_utilization", "_ma"))],
                    "day_of_week", "day_name", "week_start", "month_start")


def q_labour_hours(spark, root):
    lh = metrics.labour_hours(shift_mart(spark, root), roles.users(spark, root))
    return lh.select(*[r4(c).alias(c) if "hours" in c else F.col(c) for c in lh.columns])


def q_last_change_actor(spark, root):
    a = audit.cancel_audit(runs(spark, root), roles.history_log(spark, root), roles.users(spark, root), roles.cancel_reasons(spark))
    return a.select("leg_id", "run_number", "canceled_time", F.col("created").alias("time_canceled"), "cancel_reason_text", "canceled_reason_id", "cancel_reason_name",
                    "lost_call_status", "run_outcome", "last_change_id", "canceled_by_user_id", "canceled_by", "source_database")


def attachment_log(spark, root) -> DataFrame:
    return audit.attachment_log(roles.attachment_events(spark, root), roles.attachments(spark, root), roles.leg_attachments(spark, root), roles.attachment_types(spark, root))


def q_distinct_list(spark, root):
    return attachment_log(spark, root).select("log_id", "attachment_id", F.col("uploader_id").alias("user_id"), "action", F.col("uploaded_at").alias("action_timestamp"), "file_name",
                                              "attachment_date", "leg_attachment_id", "leg_id", "source_database", "attachment_types")


def q_compliance(spark, root):
    return audit.compliance(runs(spark, root), crew_link(spark, root), attachment_log(spark, root), roles.finalizations(spark, root), roles.users(spark, root))


def q_qa_recon(spark, root):
    legs = stage_times(spark, root).select("leg_id", "source_database", "service_date", F.col("user_id").alias("patient_id"), "calltype_name", "level_of_service")
    return audit.qa_recon(legs, roles.record_legs(spark, root), roles.care_records(spark, root), roles.export_log(spark, root),
                          roles.qa_statuses(spark, root), roles.users(spark, root), roles.patients(spark, root))


def q_qa_status(spark, root):
    st = tables.values_relation(spark, audit.QA_STATUS_NAMES, "status_id int, status_name string")
    return audit.qa_status(roles.qa_runs(spark, root), st)


def q_pay_list(spark, root):
    p = audit.pay_list(stage_times(spark, root), crew_link(spark, root), roles.users(spark, root))
    return p.select("run_number", "leg_date", "clear_time", "assigned_time", r4("time_on_task_hours").alias("time_on_task_hours"),
                    "source_database", "crew_user_id", "crew_name", "hourly_wage", r4("pay_amount").alias("pay_amount"))


def q_active_users(spark, root):
    return audit.user_dim(roles.users(spark, root))


def q_dq_invalid_durations(spark, root):
    d = quality.dq_invalid_durations(runs(spark, root))
    return d.select("leg_id", "run_number", "source_database", "service_date",
                    r4("duration_minutes").alias("duration_minutes"), "issue")


def q_dq_column_checks(spark, root):
    u = audit.user_dim(roles.users(spark, root))
    a = quality.dq_column_checks(u, "users", not_null=["user_id", "surrogate_key"], unique=["surrogate_key"])
    s = quality.dq_column_checks(seats(spark, root), "schedule",
                                 not_null=["assignment_id", "source_database", "date_line", "user_id"],
                                 unique=["assignment_id"])
    return a.unionByName(s)


def q_null_sentinel_dates(spark, root):
    o = tables.load_table(spark, root, "orders", ["o_orderkey", "o_orderdate"])
    raw = o.select(F.col("o_orderkey").alias("run_id"),
                   F.when(F.col("o_orderkey") % 4 == 0, F.lit("0000-00-00 00:00:00"))
                   .otherwise(F.col("o_orderdate").cast("string")).alias("finalize_date"))
    return tables.null_zero_dates(raw, ["finalize_date"])


QUERIES.update({
    "run_crew": q_run_crew,
    "shift_metrics": q_shift_metrics,
    "crew_daily": q_crew_daily,
    "crew_efficiency_weekly": q_crew_efficiency_weekly,
    "run_metrics": q_run_metrics,
    "sequence_in_group": q_sequence_in_group,
    "reconcile_daily": q_reconcile_daily,
    "time_on_task_daily": q_time_on_task_daily,
    "labour_hours": q_labour_hours,
    "last_change_actor": q_last_change_actor,
    "distinct_list": q_distinct_list,
    "compliance": q_compliance,
    "qa_recon": q_qa_recon,
    "qa_status": q_qa_status,
    "pay_list": q_pay_list,
    "active_users": q_active_users,
    "dq_invalid_durations": q_dq_invalid_durations,
    "dq_column_checks": q_dq_column_checks,
    "null_sentinel_dates": q_null_sentinel_dates,
})


# ---------------------------------------------------------------- delta / stream
from fieldlens import sinks  # noqa: E402
from fieldlens.streaming import jobs  # noqa: E402

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
DELTA_START = dt.datetime(2024, 1, 24)


def _delta_transform(df: DataFrame) -> DataFrame:
    return df.where(F.col("ts") >= S.ntz_lit(DELTA_START)).select(*EVENT_COLS) \
        .withColumn("value", F.round(F.col("value") + 1.0, 2))


def _merged(spark, name: str, base: DataFrame, delta: DataFrame, keys: list[str], order=()) -> DataFrame:
    """``base`` written as a keyed table, and ``delta`` merged into the cells that hold its keys."""
    table = KeyedTable(spark, scratch_path(spark, name), base.schema, keys, "ts").create(base, order=order)
    table.merge(1, delta, order)
    return table.read()


def q_upsert_merge(spark, root):
    return _merged(spark, "upsert-merge", *[roles.event_delta(spark, root, b).select(*EVENT_COLS) for b in (True, False)], ["event_id"])


def q_upsert_composite(spark, root):
    day = F.col("ts").cast("date").alias("day")
    base, delta = [roles.event_delta(spark, root, b).select("user_id", "event_type", day, "event_id", "ts", "value") for b in (True, False)]
    return _merged(spark, "upsert-composite", base, delta, ["user_id", "event_type", "day"], [("ts", "desc"), ("event_id", "desc")])


def q_incremental_scan(spark, root):
    base = roles.event_delta(spark, root, True)
    hwm = base.agg(F.max("ts")).scalar()  # scalar subquery: the stored high-water mark
    e = tables.load_table(spark, root, "events", ["event_id", "ts", "user_id", "event_type"])
    return tables.incremental_scan(e, "ts", hwm)


def _next_week(as_of: dt.date) -> tuple[dt.date, dt.date]:
    start = as_of + dt.timedelta(days=(6 - as_of.weekday()) % 7 or 7)
    return start, start + dt.timedelta(days=6)


def q_snapshot_tag(spark, root):
    start, end = _next_week(AS_OF_EVENTS)
    s = roles.shifts(spark, root).where(F.col("date_line").between(F.lit(start), F.lit(end)))
    s = sinks.tag_snapshot(s, "snapshot_week_start", start)
    return s.select("assignment_id", "user_id", "date_line", "shift_start", "snapshot_week_start")


def q_snapshot_diff(spark, root):
    week_start = AS_OF_EVENTS - dt.timedelta(days=(AS_OF_EVENTS.weekday() + 1) % 7)
    week_end = week_start + dt.timedelta(days=6)
    ev = tables.load_table(spark, root, "events")
    snap = roles.shifts(spark, root, ev.where(F.col("ts") < S.ntz_lit(dt.datetime.combine(AS_OF_EVENTS, dt.time()))))
    snap = snap.where(F.col("date_line").between(F.lit(week_start), F.lit(week_end))).select(
        "assignment_id", F.col("user_id").alias("planned_user_id"),
        S.hours_between("shift_end", "shift_start").alias("planned_hours"))
    act = seats(spark, root).where(F.col("date_line").between(F.lit(week_start), F.lit(week_end))).select(
        "assignment_id", F.col("user_id").alias("actual_user_id"), "hours_worked")
    j = snap.join(act, "assignment_id", "full_outer")
    change = (F.when(F.col("planned_hours").isNull(), "added")
               .when(F.col("actual_user_id").isNull() & F.col("planned_user_id").isNull()
                     & F.col("hours_worked").isNull(), "unchanged")
               .when(~F.col("actual_user_id").eqNullSafe(F.col("planned_user_id")), "reassigned")
               .when(F.col("hours_worked").isNull(), "not_worked")
               .otherwise("worked"))
    return j.select("assignment_id", "planned_user_id", "actual_user_id", r4("planned_hours").alias("planned_hours"),
                    r4("hours_worked").alias("actual_hours"), change.alias("change_type"))


def q_reconcile_weekly(spark, root):
    o = tables.load_table(spark, root, "orders", ["o_orderkey", "o_orderdate"])
    h = o.select(F.col("o_orderkey").alias("leg_id"), F.col("o_orderdate").cast("date").alias("service_date"))
    return calendar.reconcile_weeks(h, "service_date", AS_OF_ORDERS, extra_days=7)


def q_week_chunks(spark, root):
    o = tables.load_table(spark, root, "orders", ["o_orderdate"])
    h = o.select(S.month_start(F.col("o_orderdate").cast("date")).alias("month_start"))
    return calendar.week_chunks(h).select("month_start", "month_end", "chunk_no", "chunk_start", "chunk_end")


def q_stream_upsert(spark, root):
    out = jobs.stream_upsert(spark, tables.table_path(root, "events"),
                             roles.event_delta(spark, root, True).select(*EVENT_COLS), ["event_id"],
                             transform=_delta_transform)
    return out.select(*EVENT_COLS)


def q_stream_dedup(spark, root):
    out = jobs.stream_dedup(spark, tables.table_path(root, "events"), ["event_id"])
    return out.select(*EVENT_COLS)


def q_stream_daily_counts(spark, root):
    out = jobs.stream_window_counts(spark, tables.table_path(root, "events"), by=["event_type"])
    return out.select("window_start", "window_end", "event_type", "events", r4("value_sum").alias("value_sum"))


def q_stream_moving_windows(spark, root):
    """ST-10 over ST-9: seven-day means of the streamed daily counts."""
    out = jobs.stream_moving_windows(spark, tables.table_path(root, "events"), by=["event_type"], rows=7)
    return out.select("window_start", "event_type", "events", *[r4(c).alias(c) for c in ("value_sum", "events_ma", "value_sum_ma")])


QUERIES.update({
    "upsert_merge": q_upsert_merge,
    "upsert_composite": q_upsert_composite,
    "incremental_scan": q_incremental_scan,
    "snapshot_tag": q_snapshot_tag,
    "snapshot_diff": q_snapshot_diff,
    "reconcile_weekly": q_reconcile_weekly,
    "week_chunks": q_week_chunks,
    "stream_upsert": q_stream_upsert,
    "stream_dedup": q_stream_dedup,
    "stream_daily_counts": q_stream_daily_counts,
    "stream_moving_windows": q_stream_moving_windows,
})
