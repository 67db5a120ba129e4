"""Crew operators: run-crew link, shift metrics, crew daily/weekly efficiency, run metrics,
run sequence and daily time on task by region (BO-10..16, AG-12, WN-3, WN-8, JN-5).

Per-seat metrics are aggregated with partial (map-side) aggregation before the shuffle;
a run can have several legs, so legs and runs are counted distinct."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import (day_name, dow0, exact_window_avg, hours_between, last_first, month_start,
                                         week_start_monday, week_start_sunday)
from fieldlens.operators.classify import any_like, region_from_cost_center, TRAINING_PATTERNS
from fieldlens.operators.keys import distinct_on
from fieldlens.operators.staffing import co_members, partner_counts, partner_names
from fieldlens.operators.timeline import stage_durations, time_on_task, valid_runs

SEAT_ATTRS = ["assignment_id", "source_database", "user_id", "assigned_name", "job_title", "shift_date",
              "shift_start", "shift_end", "scheduled_hours", "actual_hours_worked", "unit_name",
              "cost_center_id", "cost_center_name", "is_training", "special_event"]

#: Components of time on task: measure of a run, its name.
COMPONENTS = [("scene_time_minutes", "scene_time"), ("destination_to_clear_minutes", "destination_time"),
              ("transport_time_minutes", "transport_time")]


def crew_seats(crew_shifts: DataFrame, centers: DataFrame, users: DataFrame, allow: DataFrame) -> DataFrame:
    """Crew schedule seats with names, cost center, training flag and the allow-list's
    special-event flag (inner join: only allow-listed cost centers, as the reference)."""
    u = users.select("user_id", "source_database", last_first("last_name", "first_name").alias("assigned_name"), "job_title")
    s = crew_shifts.join(F.broadcast(centers), ["cost_center_id", "source_database"], "left").join(u, ["user_id", "source_database"], "left")
    a = F.broadcast(allow.select("cost_center_id", "source_database", "special_event"))
    s = s.join(a, ["cost_center_id", "source_database"], "inner")
    span = hours_between("shift_end", "shift_start")
    return s.select("*", span.alias("scheduled_hours"),
                    (span - (F.col("user_id") % 3)).alias("actual_hours_worked"),
                    F.col("date_line").alias("shift_date"),
                    any_like("cost_center_name", TRAINING_PATTERNS).alias("is_training"))


def run_crew(stage_times: DataFrame, link: DataFrame, seats: DataFrame) -> DataFrame:
    """Runs x timestamps x leg-seat link x crew seat (allow-listed), valid runs only (BO-10,
    BO-7, BO-9). The seat's allow-list join is inner, which makes the outer joins before
    it inner too (Q-12); Catalyst simplifies them the same way. Leg and seat ids repeat across sources, so leg, link and seat
    meet on source and id."""
    r = valid_runs(time_on_task(stage_durations(stage_times)))
    r = r.select("leg_id", "run_number", "source_database", "service_date",
                 "calltype_name", "pickup_time", "assigned_time", "at_scene_time", "clear_time",
                 "time_on_task_minutes", "time_on_task_excl_transport_minutes", "scene_time_minutes",
                 "transport_time_minutes", "destination_to_clear_minutes", "response_time_minutes")
    lk = link.select("leg_id", "source_database", "shift_assignment_id").repartition("leg_id", "source_database").distinct()  # one exchange for distinct and join
    s = seats.select(*SEAT_ATTRS, F.col("assignment_id").alias("shift_assignment_id"))
    return r.join(lk, ["leg_id", "source_database"]).join(s, ["shift_assignment_id", "source_database"])


def shift_metrics(rc: DataFrame) -> DataFrame:
    """Per-seat metrics (BO-11): runs, time-on-task hours and averages, first/last run,
    share of scheduled hours, unit-hour utilization, active hours. Rows are dealt by seat once, which serves the distinct counts and the totals."""
    g = rc.repartition("assignment_id", "source_database").groupBy(*SEAT_ATTRS).agg(
        F.countDistinct("leg_id").alias("total_runs"),
        F.countDistinct("run_number").alias("total_run_numbers"),
        (F.sum("time_on_task_minutes") / 60.0).alias("total_time_on_task_hours"),
        (F.sum("time_on_task_excl_transport_minutes") / 60.0).alias("total_time_on_task_excl_transport_hours"),
        (F.sum("scene_time_minutes") / 60.0).alias("total_scene_time_hours"),
        (F.sum("destination_to_clear_minutes") / 60.0).alias("total_destination_time_hours"),
        (F.sum("transport_time_minutes") / 60.0).alias("total_transport_time_hours"),
        F.avg("time_on_task_minutes").alias("avg_time_on_task_minutes"),
        F.avg("time_on_task_excl_transport_minutes").alias("avg_time_on_task_excl_transport_minutes"),
        F.avg("scene_time_minutes").alias("avg_scene_time_minutes"),
        F.avg("destination_to_clear_minutes").alias("avg_destination_time_minutes"),
        F.avg("transport_time_minutes").alias("avg_transport_time_minutes"),
        F.avg("response_time_minutes").alias("avg_response_time_minutes"),
        F.min("assigned_time").alias("first_run_assigned_time"),
        F.max("clear_time").alias("last_run_clear_time"))
    pos = F.col("scheduled_hours") > 0
    return g.withColumns({
        "time_on_task_pct": F.when(pos, F.col("total_time_on_task_hours") / F.col("scheduled_hours")),
        "time_on_task_excl_transport_pct": F.when(
            pos, F.col("total_time_on_task_excl_transport_hours") / F.col("scheduled_hours")),
        "unit_hour_utilization": F.when(pos, F.col("total_runs") / F.col("scheduled_hours")),
        "active_shift_hours": hours_between("last_run_clear_time", "first_run_assigned_time"),
    })


#: Who works together in a day: the key of the groups that ``crew_daily`` rows belong to.
DAY_GROUP = ["source_database", "unit_name", "shift_date"]


def crew_daily(sm: DataFrame) -> DataFrame:
    """Crew daily efficiency (BO-12): shift metrics + number of partners on the same unit and day +
    efficiency percentages + calendar columns. Names are added to a report's rows by :func:`crew_daily_report`."""
    counts, _ = co_members(sm, DAY_GROUP)
    return partner_counts(sm, counts, DAY_GROUP).withColumns({
        "active_time_efficiency_pct": F.when(F.col("active_shift_hours") > 0,
                                             F.col("total_time_on_task_hours") / F.col("active_shift_hours") * 100),
        "actual_hours_efficiency_pct": F.when(F.col("actual_hours_worked") > 0,
                                              F.col("total_time_on_task_hours") / F.col("actual_hours_worked") * 100),
        "day_of_week": dow0("shift_date"),
        "day_name": day_name("shift_date"),
        "week_start": week_start_monday("shift_date"),
        "month_start": month_start("shift_date"),
    })


def crew_daily_report(daily: DataFrame, sm: DataFrame) -> DataFrame:
    """Rows of ``crew_daily`` with their partners' names."""
    _, names = co_members(sm, DAY_GROUP)
    return partner_names(daily, names, DAY_GROUP).withColumnRenamed("partner_names", "partner_crew_members")


def crew_weekly(sm: DataFrame) -> DataFrame:
    """Crew weekly efficiency (BO-13): Sunday weeks, run-weighted averages (AG-12), the
    sorted distinct list of cost centers worked (AG-8); training seats excluded."""
    s = sm.where(~F.col("is_training")).withColumn("week_start", week_start_sunday("shift_date"))
    runs = F.col("total_runs")

    def wavg(c):
        return F.try_divide(F.sum(F.col(c) * runs), F.nullif(F.sum(runs), F.lit(0)).cast("double"))

    g = s.groupBy("user_id", "assigned_name", "job_title", "week_start", "source_database").agg(
        F.sum("total_runs").alias("total_calls_ran"),
        F.sum("scheduled_hours").alias("total_scheduled_hours"),
        F.sum("actual_hours_worked").alias("total_actual_hours_worked"),
        F.sum("total_time_on_task_hours").alias("total_time_on_task_hours"),
        wavg("avg_time_on_task_minutes").alias("avg_time_on_task_minutes"),
        wavg("avg_scene_time_minutes").alias("avg_scene_time_minutes"),
        wavg("avg_destination_time_minutes").alias("avg_destination_time_minutes"),
        wavg("avg_transport_time_minutes").alias("avg_transport_time_minutes"),
        wavg("avg_response_time_minutes").alias("avg_response_time_minutes"),
        F.avg("unit_hour_utilization").alias("avg_daily_uhu"),
        F.count(F.lit(1)).alias("shifts_worked"),
        F.sum("active_shift_hours").alias("total_active_hours"),
        F.array_join(F.array_sort(F.collect_set("cost_center_name")), ", ").alias("cost_centers_worked"))
    pos = F.col("total_scheduled_hours") > 0
    return g.withColumns({
        "week_end": F.date_add("week_start", 6),
        "weekly_uhu": F.when(pos, F.col("total_calls_ran") / F.col("total_scheduled_hours")),
        "time_on_task_pct": F.when(pos, F.col("total_time_on_task_hours") / F.col("total_scheduled_hours") * 100),
    })


def run_metrics(rc: DataFrame, as_of: dt.date | None = None, weeks: int | None = 5,
                levels: Sequence[str] | None = ("ALS", "BLS", "CCT")) -> DataFrame:
    """One row per leg (BO-15): the leg's first seat by seat id (DISTINCT ON leg), the
    region of that seat, hours, share of the shift, calendar columns; transport call
    types only; optionally the last ``weeks`` weeks before ``as_of`` (None: all)."""
    df = rc
    if levels is not None:
        df = df.where(F.col("calltype_name").isin(*levels))
    if as_of is not None and weeks is not None:
        df = df.where((F.col("service_date") >= F.lit(as_of - dt.timedelta(days=7 * weeks)))
                      & (F.col("service_date") <= F.lit(as_of)))
    one = distinct_on(df, ["leg_id", "source_database"], ["shift_assignment_id"])
    return one.withColumns({
        "region": region_from_cost_center(),
        "time_on_task_hours": F.col("time_on_task_minutes") / 60.0,
        "time_on_task_excl_transport_hours": F.col("time_on_task_excl_transport_minutes") / 60.0,
        "run_tot_pct_of_shift": F.when(F.col("scheduled_hours") > 0,
                                       F.col("time_on_task_minutes") / 60.0 / F.col("scheduled_hours") * 100),
        "assigned_hour": F.hour("assigned_time"),
        "day_of_week": dow0("service_date"),
        "day_name": day_name("service_date"),
        "week_start": week_start_monday("service_date"),
        "month_start": month_start("service_date"),
    })


def run_sequence(rm: DataFrame) -> DataFrame:
    """Shift drill-down (BO-16, WN-3): each run's sequence within its seat and shift day
    by assigned time (leg id breaks ties)."""
    w = Window.partitionBy("assignment_id", "shift_date").orderBy("assigned_time", "leg_id")
    return rm.withColumn("run_sequence", F.row_number().over(w))


def daily_reconcile(rm: DataFrame, seats: DataFrame) -> DataFrame:
    """Run side FULL OUTER JOIN hours side per shift day, source and region, with COALESCEd
    keys and zero-filled measures (JN-5). Crew hours are halved (two per unit); training
    and special events do not count; ``total_shifts`` counts cost centers with hours."""
    # minutes are whole numbers, so their sums are exact in any order; divide once
    runs = rm.groupBy(F.col("shift_date").alias("d"), "source_database", "region").agg(
        F.countDistinct("leg_id").alias("total_runs"),
        *[F.sum(c).alias(f"sum_{c}") for c in ("time_on_task_minutes", "time_on_task_excl_transport_minutes",
                                               *[m for m, _ in COMPONENTS])],
        *[F.avg(m).alias(f"avg_{n}_minutes") for m, n in (("time_on_task_minutes", "time_on_task"),
                                                          ("time_on_task_excl_transport_minutes", "time_on_task_excl_transport"),
                                                          ("response_time_minutes", "response_time"), *COMPONENTS)])
    keep = ~F.col("special_event") & ~F.coalesce(F.col("is_training"), F.lit(False))
    hours = seats.withColumn("region", region_from_cost_center()).groupBy(
        F.col("shift_date").alias("d"), "source_database", "region").agg(
        (F.sum(F.when(keep, F.col("actual_hours_worked")).otherwise(0.0)) / 2.0).alias("total_scheduled_hours"),
        F.countDistinct(F.when(keep & (F.col("actual_hours_worked") > 0), F.col("cost_center_id"))).alias("total_shifts"))
    k = ["d", "source_database", "region"]
    j = runs.alias("r").join(hours.alias("h"), [F.col(f"r.{c}") == F.col(f"h.{c}") for c in k], "full_outer")

    def total(c):
        return F.coalesce(F.col(f"r.sum_{c}"), F.lit(0.0))

    return j.select(
        F.coalesce("r.d", "h.d").alias("service_date"),
        F.coalesce("r.source_database", "h.source_database").alias("source_database"),
        F.coalesce("r.region", "h.region").alias("region"),
        F.coalesce("r.total_runs", F.lit(0)).alias("total_runs"),
        (total("time_on_task_minutes") / 60.0).alias("total_time_on_task_hours"),
        (total("time_on_task_excl_transport_minutes") / 60.0).alias("total_time_on_task_excl_transport_hours"),
        *[(total(m) / 60.0).alias(f"total_{n}_hours") for m, n in COMPONENTS],
        *[F.col(f"r.avg_{n}_minutes") for n in ("time_on_task", "time_on_task_excl_transport", "response_time",
                                                *[n for _, n in COMPONENTS])],
        F.coalesce("h.total_scheduled_hours", F.lit(0.0)).alias("total_scheduled_hours"),
        F.coalesce("h.total_shifts", F.lit(0)).alias("total_shifts"))


def tot_daily(rec: DataFrame, rows: int = 35, keys: Sequence[str] = ("source_database", "region")) -> DataFrame:
    """Daily time on task by region (BO-14, WN-8): shares of the scheduled hours (0 on days
    without any) and ``rows``-row trailing averages of six measures over one window spec:
    both shares, unit-hour utilization, scene, destination and transport time. The window
    holds one region's days, a calendar-bounded set."""
    scheduled = F.col("total_scheduled_hours")

    def share(c):
        return F.when(scheduled > 0, F.col(c) / scheduled).otherwise(F.lit(0.0))

    d = rec.withColumns({
        "time_on_task_pct": share("total_time_on_task_hours"),
        "time_on_task_excl_transport_pct": share("total_time_on_task_excl_transport_hours"),
        "unit_hour_utilization": share("total_runs"),
    })
    w = Window.partitionBy(*keys).orderBy("service_date").rowsBetween(-(rows - 1), 0)
    measures = ["time_on_task_pct", "time_on_task_excl_transport_pct", "unit_hour_utilization",
                *[f"avg_{n}_minutes" for _, n in COMPONENTS]]
    return d.withColumns({f"{m}_{rows}day_ma": exact_window_avg(m, w) for m in measures} | {
        "day_of_week": dow0("service_date"), "day_name": day_name("service_date"),
        "week_start": week_start_monday("service_date"), "month_start": month_start("service_date")})
