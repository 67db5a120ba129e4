"""Staffing operators: seat fact, partners, staffing status, overtime, cumulative hours,
open-shift summaries, scheduling summary and the dense hours grid (BO-21..26, BO-31,
BO-32).

Group-wise metrics are partial aggregations joined back on the group key (no self-join,
and a hot group is reduced map-side instead of being gathered into one task)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import day_name, dow0, hours_between, last_first, round_numeric, week_start
from fieldlens.operators.classify import (hours_variance, level_from_name, region_from_cost_center,
                                          shift_flags)

SEAT_GROUP = ["source_database", "unit_id", "date_line", "shift_start"]


def seat_fact(shifts: DataFrame, matches: DataFrame, users: DataFrame | None = None,
              allow: DataFrame | None = None, first_day: str = "sun") -> DataFrame:
    """One row per seat: punches are pre-aggregated per seat (partial aggregation before
    the shuffle) and joined back, so a seat with many punches does not fan out."""
    punch = matches.where(F.col("time_id").isNotNull()).withColumn(
        "_h", F.when(F.col("clock_in_time").isNotNull() & F.col("effective_clock_out").isNotNull(),
                     hours_between("effective_clock_out", "clock_in_time")))
    per_seat = punch.groupBy("source_database", "assignment_id").agg(
        F.sum("_h").alias("hours_worked"), F.min("clock_in_time").alias("clock_in_time"),
        F.count(F.lit(1)).alias("punch_count"))
    span = hours_between("shift_end", "shift_start")
    s = shifts.join(per_seat, ["source_database", "assignment_id"], "left").withColumns({
        "assignment_status": F.when(F.col("user_id").isNull(), "OPEN").otherwise("ASSIGNED"),
        "is_open": F.col("user_id").isNull(),
        "scheduled_hours": F.when(F.col("user_id").isNotNull(), span).otherwise(F.lit(0.0)),
        "open_hours": F.when(F.col("user_id").isNull(), span).otherwise(F.lit(0.0)),
        "punch_count": F.coalesce("punch_count", F.lit(0)),
        "week_start": week_start("date_line", first_day),
        "day_name": day_name("date_line"),
        "day_of_week": dow0("date_line"),
        "region": region_from_cost_center(),
        "level_of_service": level_from_name(),
    })
    s = s.withColumn("hours_variance", hours_variance())
    if users is not None:
        u = users.select("user_id", "source_database",
                         last_first("last_name", "first_name").alias("assigned_name"), "job_title")
        s = s.join(u, ["user_id", "source_database"], "left")
    return shift_flags(s, allow)


def co_members(df: DataFrame, group: Sequence[str] = SEAT_GROUP, id_col: str = "assignment_id",
               name_col: str = "assigned_name") -> tuple[DataFrame, DataFrame]:
    """Groups of rows that share a unit, day and start (BO-22, JN-14): one row per group with its number of
    members, and one row per group and name with how many members bear it. Neither grows faster than the rows, and no row holds a list.
    Rows with a NULL in the group key are in no group (equality never matches NULL). Assumes one row per ``id_col``."""
    members = df.where(_in_group(group))
    counts = members.groupBy(*group).agg(F.countDistinct(id_col).alias("members"))
    names = members.where(F.col(name_col).isNotNull()).groupBy(*group, F.col(name_col).alias("member_name")).agg(F.countDistinct(id_col).alias("bearers"))
    return counts, names


def _in_group(group: Sequence[str]) -> F.Column:
    ok = F.lit(True)
    for g in group:
        ok = ok & F.col(g).isNotNull()
    return ok


def partner_counts(df: DataFrame, counts: DataFrame, group: Sequence[str] = SEAT_GROUP) -> DataFrame:
    """``df`` with the number of other members of a row's group; the group's key stays on the row, so names can be had later."""
    out = df.join(counts, list(group), "left")
    return out.withColumn("partner_count", F.coalesce(F.col("members") - 1, F.lit(0)).cast("bigint")).drop("members")


def partner_names(rows: DataFrame, names: DataFrame, group: Sequence[str] = SEAT_GROUP, name_col: str = "assigned_name") -> DataFrame:
    """The rows of a report with the names of the other members of their group, in order: the place where lists are made, for the
    groups of ``rows`` only. A row's own name is left out unless another member bears it too; open seats give no name."""
    asked = rows.where(_in_group(group)).select(*group).distinct()
    lists = names.join(asked, list(group), "left_semi").groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(F.col("member_name").alias("n"), F.col("bearers").alias("c")))).alias("_names"))
    out = rows.join(lists, list(group), "left")
    mine = F.col(name_col)
    others = F.transform(F.filter(F.coalesce(F.col("_names"), F.array()), lambda x: mine.isNull() | (x["n"] != mine) | (x["c"] > 1)), lambda x: x["n"])
    return out.withColumn("partner_names", F.when(F.size(others) > 0, F.array_join(others, ", "))).drop("_names")


def shift_partners(df: DataFrame, group: Sequence[str] = SEAT_GROUP, id_col: str = "assignment_id",
                   name_col: str = "assigned_name") -> DataFrame:
    """``df`` as a report with the number and names of each row's partners."""
    counts, names = co_members(df, group, id_col, name_col)
    return partner_names(partner_counts(df, counts, group), names, group, name_col)


def staffing(df: DataFrame, group: Sequence[str] = SEAT_GROUP) -> DataFrame:
    """Positions per shift (BO-23): total / filled / open over the group, and the
    status COMPLETELY_OPEN, UNDERSTAFFED or FULLY_STAFFED. A NULL group key gives NULL
    counts, like the reference's equality join.

    Counted with a grouped aggregation (partial counts before the shuffle) joined back
    on the group key, so a hot group is reduced map-side instead of sorted in one task."""
    keys_ok = F.lit(True)
    for g in group:
        keys_ok = keys_ok & F.col(g).isNotNull()
    agg = df.where(keys_ok).groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.count(F.when(F.col("assignment_status") == "ASSIGNED", 1)).alias("filled_positions"))
    out = df.join(agg, list(group), "left") \
        .withColumn("open_positions", F.col("total_positions") - F.col("filled_positions"))
    return out.withColumn(
        "staffing_status",
        F.when(F.col("total_positions").isNull(), F.lit(None).cast("string"))
         .when(F.col("filled_positions") == 0, "COMPLETELY_OPEN")
         .when(F.col("open_positions") > 0, "UNDERSTAFFED")
         .otherwise("FULLY_STAFFED"))


def weekly_hours(df: DataFrame, threshold: float = 40.0,
                 keys: Sequence[str] = ("source_database", "user_id", "week_start")) -> DataFrame:
    """Employee-week hours with overtime above ``threshold`` (BO-24)."""
    g = df.where(F.col("user_id").isNotNull()).groupBy(*keys).agg(
        F.sum("scheduled_hours").alias("weekly_scheduled_hours"),
        F.sum(F.coalesce("hours_worked", F.lit(0.0))).alias("weekly_actual_hours"),
        F.count(F.lit(1)).alias("shift_count"))
    return g.withColumns({
        "overtime_hours": F.greatest(F.col("weekly_scheduled_hours") - threshold, F.lit(0.0)),
        "actual_overtime_hours": F.greatest(F.col("weekly_actual_hours") - threshold, F.lit(0.0)),
        "is_overtime": F.col("weekly_scheduled_hours") > threshold,
    })


def crew_field_shifts(df: DataFrame) -> DataFrame:
    """Field crew seats only: no special events, no orientation, no open training seats,
    a unit is set (the pay-period crew report's population)."""
    return df.where(F.col("is_field_shift") & ~F.col("is_special_event") & ~F.col("is_orientation")
                    & ~(F.col("is_open") & F.col("is_training")) & F.col("unit_name").isNotNull())


def period_overtime(rs: DataFrame, threshold: float = 40.0) -> DataFrame:
    """Pay-period overtime per employee (BO-25, Q-26): hours per pay-period week, the
    excess over ``threshold`` per week, summed over the period; keyed on the period start
    (Q-5 corrected). ``rs`` is seats with their pay period (``assign_period``)."""
    a = crew_field_shifts(rs).where((F.col("assignment_status") == "ASSIGNED") & F.col("user_id").isNotNull())
    k = ["source_database", "user_id", "pay_period_start"]
    wk = a.groupBy(*k, "period_week").agg(
        F.sum("scheduled_hours").alias("week_scheduled_hours"),
        F.sum("hours_worked").alias("week_actual_hours"),
        F.count(F.lit(1)).alias("week_shift_count"))
    wk = wk.withColumns({
        "week_scheduled_ot": F.when(F.col("week_scheduled_hours") > threshold,
                                    F.col("week_scheduled_hours") - threshold).otherwise(F.lit(0.0)),
        "week_actual_ot": F.when(F.col("week_actual_hours") > threshold,
                                 F.col("week_actual_hours") - threshold).otherwise(F.lit(0.0)),
    })
    return wk.groupBy(*k).agg(
        F.sum("week_scheduled_hours").alias("pp_scheduled_hours"),
        F.sum("week_actual_hours").alias("pp_actual_hours"),
        F.sum("week_scheduled_ot").alias("pp_scheduled_ot"),
        F.sum("week_actual_ot").alias("pp_actual_ot"),
        F.sum("week_shift_count").alias("pp_shift_count"),
        F.bool_or(F.col("week_scheduled_ot") > 0).alias("has_overtime_week"))


def overtime_summary(weekly: DataFrame) -> DataFrame:
    """Two-level aggregation (AG-16): employee-week first, then per source."""
    return weekly.groupBy("source_database").agg(
        F.countDistinct("user_id").alias("employees"),
        F.countDistinct(F.when(F.col("is_overtime"), F.col("user_id"))).alias("employees_with_overtime"),
        F.count_if(F.col("is_overtime")).alias("overtime_weeks"),
        F.sum("overtime_hours").alias("total_overtime_hours"))


def cumulative_hours(df: DataFrame, hours: str = "scheduled_hours") -> DataFrame:
    """Running scheduled hours within the employee-week in shift order (BO-26, WN-5),
    with the seat id as tie-breaker (Q-22); open seats (NULL user) get NULL and take no part
    in the windows.

    Computed in two exact parts so a busy employee-week is not one sequential task: a
    running sum within each (employee, week, day), plus the total of the earlier days of
    that week (a running sum over at most seven day totals). Shifts of a later day start
    later, so the order is the same as one running sum over the week."""
    k = ["source_database", "user_id", "week_start"]
    d = df.where(F.col("user_id").isNotNull()).withColumn("_day", F.col("shift_start").cast("date"))
    in_day = Window.partitionBy(*k, "_day").orderBy("shift_start", "assignment_id") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = d.groupBy(*k, "_day").agg(F.sum(hours).alias("_day_total"))
    before = Window.partitionBy(*k).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_before", F.coalesce(F.sum("_day_total").over(before), F.lit(0.0))).drop("_day_total")
    out = d.withColumn("_run", F.sum(hours).over(in_day)).join(days, [*k, "_day"], "left")
    out = out.withColumn("cumulative_hours", F.col("_run") + F.col("_before")).select(*df.columns, "cumulative_hours")
    return out.unionByName(df.where(F.col("user_id").isNull()).withColumn("cumulative_hours", F.lit(None).cast("double")))


def daily_open_summary(df: DataFrame, keys: Sequence[str] = ("region", "date_line")) -> DataFrame:
    """Open seats and open hours per day and region, attached to every detail row
    (BO-31); uses ``open_hours`` (Q-7 corrected). Aggregated per key (partial sums before
    the shuffle) and joined back null-safely, like a window over the key would."""
    is_open = F.col("assignment_status") == "OPEN"
    agg = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.count(F.when(is_open, 1)).alias("open_shift_count"),
        F.sum(F.when(is_open, F.col("open_hours"))).alias("open_hours_day"))
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(agg, cond, "left").drop(*[f"_k_{k}" for k in keys])


def scheduling_summary(seats: DataFrame, threshold: float = 40.0, first_day: str = "mon") -> DataFrame:
    """Weekly scheduling summary per source (BO-32, AG-16, AG-6/7): positions filled and
    open, completely open and understaffed shifts, employees, scheduled/filled/open/worked
    hours, scheduled and worked overtime over ``threshold`` per employee-week, coverage
    percentages and per-weekday seat counts. Training seats are excluded. Weeks start on
    Monday as the reference's ``date_trunc('week')`` does (Q-6; ``first_day`` changes it).
    Every level is a grouped aggregation; the four results are joined on (source, week)."""
    s = seats.where(~F.coalesce(F.col("is_training"), F.lit(False))) \
        .withColumn("week_start", week_start("date_line", first_day))
    k = ["source_database", "week_start"]
    assigned = F.col("assignment_status") == "ASSIGNED"

    emp = s.where(assigned & F.col("user_id").isNotNull()).groupBy(*k, "user_id").agg(
        F.sum("scheduled_hours").alias("sh"), F.sum("hours_worked").alias("wh"))
    ot = emp.groupBy(*k).agg(
        F.count(F.lit(1)).alias("unique_employees_worked"),
        F.count_if(F.col("sh") > threshold).alias("employees_with_scheduled_overtime"),
        F.sum(F.when(F.col("sh") > threshold, F.col("sh") - threshold)).alias("total_overtime_hours_scheduled"),
        F.sum(F.when(F.col("wh") > threshold, F.col("wh") - threshold)).alias("total_overtime_hours_worked"))

    shifts = s.groupBy(*k, "unit_id", "unit_name", "date_line", "shift_start").agg(
        F.count(F.lit(1)).alias("tp"), F.count_if(assigned).alias("fp"))
    prob = shifts.groupBy(*k).agg(
        F.count(F.lit(1)).alias("total_shifts_scheduled"),
        F.count_if((F.col("tp") - F.col("fp") > 0) & (F.col("fp") > 0)).alias("understaffed_shifts"),
        F.sum(F.when((F.col("tp") - F.col("fp") > 0) & (F.col("fp") > 0), F.col("tp") - F.col("fp")))
         .alias("understaffed_positions"),
        F.count_if(F.col("fp") == 0).alias("completely_open_shifts"),
        F.sum(F.when(F.col("fp") == 0, F.col("tp"))).alias("completely_open_positions"))

    # seats are unique by id, shifts and employees come from the roll-ups: no distinct counts
    aggs = [
        F.count(F.lit(1)).alias("total_shift_positions_scheduled"),
        F.count_if(assigned).alias("positions_filled"),
        F.count_if(F.col("assignment_status") == "OPEN").alias("positions_open"),
        round_numeric(F.sum("scheduled_hours"), 1).alias("total_scheduled_hours"),
        round_numeric(F.sum(F.when(assigned, F.col("scheduled_hours"))), 1).alias("scheduled_hours_filled"),
        round_numeric(F.sum("open_hours"), 1).alias("scheduled_hours_open"),
        round_numeric(F.sum(F.when(assigned, F.col("hours_worked"))), 1).alias("actual_hours_worked"),
        F.max(F.date_add("week_start", 6)).alias("week_end"),
    ]
    for i, d in enumerate(["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]):
        aggs.append(F.count_if(F.col("day_of_week") == i).alias(f"{d}_shifts"))
    rs = s.groupBy(*k).agg(*aggs)

    out = rs.join(ot, k, "left").join(prob, k, "left")
    z = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("completely_open_shifts", "completely_open_positions",
                                                    "understaffed_shifts", "understaffed_positions",
                                                    "employees_with_scheduled_overtime", "unique_employees_worked")}
    z.update({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("total_overtime_hours_scheduled",
                                                            "total_overtime_hours_worked")})
    out = out.withColumns(z)

    def pct(a, b):
        return round_numeric(F.try_divide(F.col(a).cast("double"), F.nullif(F.col(b).cast("double"), F.lit(0.0)))
                             * 100, 1)

    return out.withColumns({
        "total_problem_shifts": F.col("completely_open_shifts") + F.col("understaffed_shifts"),
        "total_problem_positions": F.col("completely_open_positions") + F.col("understaffed_positions"),
        "coverage_pct": pct("positions_filled", "total_shift_positions_scheduled"),
        "scheduled_hours_coverage_pct": pct("scheduled_hours_filled", "total_scheduled_hours"),
        "hours_worked_vs_scheduled_pct": pct("actual_hours_worked", "scheduled_hours_filled"),
        "hours_variance": round_numeric(F.col("scheduled_hours_filled") - F.col("actual_hours_worked"), 1),
    })


def hours_grid(spark, seats: DataFrame, centers: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Hours grid (BO-21, JN-7): every schedule date in ``[start, end]`` x every
    allow-listed cost center of each source, with scheduled / open / worked hours
    (rounded like numerics, worked hours floored at 0) per training flag, zero-filled.

    The date domain is limited first: the distinct dates form a bounded list (a scalar
    subquery), and the grid is generated from the fixed-size center list by exploding
    it, so no join builds the grid; the aggregated hours are then left-joined."""
    in_range = (F.col("date_line") >= F.lit(start)) & (F.col("date_line") <= F.lit(end))
    dates = seats.where(in_range).select(F.array_sort(F.collect_set("date_line"))).scalar()
    grid = centers.select("cost_center_id", "cost_center_name", "source_database", "special_event",
                          F.explode(dates).alias("date_line"))
    agg = seats.where(in_range & F.col("cost_center_id").isNotNull()) \
        .groupBy("date_line", "cost_center_id", "source_database", "is_training").agg(
            round_numeric(F.sum("scheduled_hours"), 2).alias("scheduled_hours"),
            round_numeric(F.sum("open_hours"), 2).alias("open_hours"),
            round_numeric(F.sum(F.coalesce("hours_worked", F.lit(0.0))), 2).alias("worked_hours"))
    j = grid.join(agg, ["date_line", "cost_center_id", "source_database"], "left")
    return j.select("date_line", "cost_center_id", "cost_center_name", "source_database", "special_event",
                    "is_training",
                    F.coalesce("scheduled_hours", F.lit(0.0)).alias("scheduled_hours"),
                    F.coalesce("open_hours", F.lit(0.0)).alias("open_hours"),
                    F.greatest(F.coalesce("worked_hours", F.lit(0.0)), F.lit(0.0)).alias("worked_hours"))
