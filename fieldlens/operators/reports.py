"""Pay-period report data (BO-49..51, AG-19..22, SL-6). The reference builds these in one
Python process per region and period; here each is one distributed aggregation for all
regions and periods at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import week_start_sunday
from fieldlens.operators.calendar import assign_period
from fieldlens.operators.classify import hours_fallback

REPORT_KEYS = ["region", "pay_period_start"]


def report_shifts(seats: DataFrame, periods: DataFrame) -> DataFrame:
    """Seats with their period, period week and the scheduled-hours fallback (BO-54):
    open seats carry their span as hours, like the report reader does."""
    s = assign_period(seats, periods, "date_line").where(F.col("pay_period_start").isNotNull())
    return s.withColumn("report_hours", hours_fallback("scheduled_hours")) \
        .withColumn("calendar_week", week_start_sunday("date_line"))


def employee_hours(rs: DataFrame, threshold: float = 40.0) -> DataFrame:
    """Per-employee roll-up (AG-19): weeks 1/2, category hours (orientation, else special
    event, else field; training independently), overtime per calendar week above the
    threshold, actual hours and variance. Calendar weeks are taken inside the period
    (Q-4 corrected); the report key is the period start (Q-5 corrected)."""
    a = rs.where(~F.col("is_open"))
    h = F.col("report_hours")
    wk = a.groupBy(*REPORT_KEYS, "user_id", "assigned_name", "calendar_week").agg(
        F.sum(F.when(F.col("period_week") == 1, h).otherwise(0.0)).alias("w1"),
        F.sum(F.when(F.col("period_week") != 1, h).otherwise(0.0)).alias("w2"),
        F.sum(F.when(F.col("is_training"), h).otherwise(0.0)).alias("tr"),
        F.sum(F.when(F.col("is_orientation"), h).otherwise(0.0)).alias("ori"),
        F.sum(F.when(~F.col("is_orientation") & F.col("is_special_event"), h).otherwise(0.0)).alias("se"),
        F.sum(F.when(~F.col("is_orientation") & ~F.col("is_special_event") & F.col("is_field_shift"), h)
              .otherwise(0.0)).alias("fld"),
        F.sum(h).alias("week_hours"),
        F.sum(F.coalesce("hours_worked", F.lit(0.0))).alias("act"))
    emp = wk.groupBy(*REPORT_KEYS, "user_id", "assigned_name").agg(
        F.sum("w1").alias("week1_hours"), F.sum("w2").alias("week2_hours"),
        F.sum("tr").alias("training_hours"), F.sum("ori").alias("orientation_hours"),
        F.sum("se").alias("special_event_hours"), F.sum("fld").alias("field_hours"),
        F.sum(F.greatest(F.col("week_hours") - threshold, F.lit(0.0))).alias("total_ot"),
        F.sum("act").alias("actual_hours"))
    emp = emp.withColumn("total_hours", F.col("week1_hours") + F.col("week2_hours"))
    return emp.withColumn("variance", F.col("actual_hours") - F.col("total_hours"))


def open_hours(rs: DataFrame) -> DataFrame:
    """Open-hours roll-up by category (AG-20)."""
    o = rs.where(F.col("is_open"))
    h = F.col("report_hours")
    return o.groupBy(*REPORT_KEYS).agg(
        F.sum(h).alias("open_total"),
        F.sum(F.when(F.col("period_week") == 1, h).otherwise(0.0)).alias("open_week1"),
        F.sum(F.when(F.col("period_week") != 1, h).otherwise(0.0)).alias("open_week2"),
        F.sum(F.when(F.col("is_training"), h).otherwise(0.0)).alias("open_training"),
        F.sum(F.when(F.col("is_orientation"), h).otherwise(0.0)).alias("open_orientation"),
        F.sum(F.when(~F.col("is_orientation") & F.col("is_special_event"), h).otherwise(0.0))
         .alias("open_special_event"),
        F.sum(F.when(~F.col("is_orientation") & ~F.col("is_special_event"), h).otherwise(0.0))
         .alias("open_field"))


def report_with_totals(rs: DataFrame) -> DataFrame:
    """Detail rows per employee, one OPEN row and one TOTAL row per report (AG-21):
    ROLLUP over (report, row label) with ``grouping()`` naming the total."""
    label = F.when(F.col("is_open"), F.lit("OPEN")).otherwise(
        F.coalesce(F.col("assigned_name"), F.concat(F.lit("user "), F.col("user_id").cast("string"))))
    # one row per employee, also if two share a name; all open seats share one row
    ids = [c for c in ("source_database", "user_id") if c in rs.columns]
    d = rs.withColumn("row_label", label).withColumn("row_user", F.when(~F.col("is_open"), F.struct(*ids)))
    d = d.withColumn("row", F.struct("row_label", "row_user"))
    g = d.rollup(*REPORT_KEYS, "row").agg(
        F.sum("report_hours").alias("scheduled_hours"),
        F.count(F.lit(1)).alias("shifts"),
        F.grouping("row").alias("_gl"), F.grouping("pay_period_start").alias("_gp"))
    g = g.where(F.col("_gp") == 0).select(*REPORT_KEYS, F.col("row.row_label").alias("row_label"),
                                          F.col("row.row_user.user_id").alias("user_id"), "scheduled_hours", "shifts", "_gl", "_gp")
    return g.withColumn("row_label", F.when(F.col("_gl") == 1, F.lit("TOTAL")).otherwise(F.col("row_label"))) \
        .withColumn("row_kind", F.when(F.col("_gl") == 1, "total")
                    .when(F.col("row_label") == "OPEN", "open").otherwise("employee")) \
        .drop("_gl", "_gp")


def daily_hours_variance(rs: DataFrame) -> DataFrame:
    """Per-day totals (AG-22): scheduled (filled), open, actual and variance."""
    h = F.col("report_hours")
    g = rs.groupBy(*REPORT_KEYS, "date_line").agg(
        F.sum(F.when(~F.col("is_open"), h).otherwise(0.0)).alias("scheduled_hours"),
        F.sum(F.when(F.col("is_open"), h).otherwise(0.0)).alias("open_hours"),
        F.sum(F.coalesce("hours_worked", F.lit(0.0))).alias("actual_hours"),
        F.count_if(~F.col("is_open")).alias("filled_shifts"),
        F.count_if(F.col("is_open")).alias("open_shifts"))
    return g.withColumn("variance", F.col("actual_hours") - F.col("scheduled_hours"))


def reports_due(periods: DataFrame, regions: DataFrame) -> DataFrame:
    """Period-boundary trigger (BO-51): the upcoming-schedule report is due the day before
    a period starts, the comparison report the day after it ends; one row per region,
    report and due date. ``due_on(as_of)`` is a filter on this frame."""
    p = periods.select("start_date", "end_date")
    sched = p.select(F.lit("schedule").alias("report_type"), F.date_sub("start_date", 1).alias("due_date"),
                     F.col("start_date").alias("period_start"), F.col("end_date").alias("period_end"))
    comp = p.select(F.lit("comparison").alias("report_type"), F.date_add("end_date", 1).alias("due_date"),
                    F.col("start_date").alias("period_start"), F.col("end_date").alias("period_end"))
    # the distinct region list is a scalar subquery (bounded domain); each due-date row is
    # expanded over it by a generator, so no join is planned
    region_list = regions.select(F.array_sort(F.collect_set("region"))).scalar()
    return sched.unionByName(comp).select(F.explode(region_list).alias("region"), "*")


def due_on(due: DataFrame, as_of: dt.date) -> DataFrame:
    return due.where(F.col("due_date") == F.lit(as_of))


def report_order(df: DataFrame) -> DataFrame:
    """Report row order (SL-6, Q-18 as written): sort key ``not is_open`` puts open seats
    first, then shift start and name."""
    return df.orderBy((~F.col("is_open")).asc(), F.col("shift_start").asc_nulls_last(),
                      F.col("assigned_name").asc_nulls_last())


def shift_report(seats: DataFrame, as_of: dt.date) -> DataFrame:
    """Shift detail report (the weekly / upcoming shift report models): every seat with
    its partners, staffing status, employee-week hours and overtime, cumulative hours,
    attendance and urgency flags, and the day's open-shift summary. Each part is one of
    the library operators; group metrics are aggregated and joined back on their keys."""
    from fieldlens.operators.classify import attendance_flags, urgency_flags
    from fieldlens.operators.staffing import (cumulative_hours, daily_open_summary, shift_partners, staffing,
                                              weekly_hours)
    s = shift_partners(seats)
    s = staffing(s)
    s = cumulative_hours(s)
    wk = weekly_hours(seats).select("source_database", "user_id", "week_start", "weekly_scheduled_hours",
                                    "overtime_hours", "is_overtime")
    s = s.join(wk, ["source_database", "user_id", "week_start"], "left")
    s = attendance_flags(s, as_of)
    s = urgency_flags(s, as_of)
    return daily_open_summary(s)


def schedule_sheet(rs: DataFrame) -> DataFrame:
    """Per-day schedule sheet rows (BO-49 detail, SC-27, Q-21): the employee or OPEN, unit,
    cost center, 12-hour start/end text, hours rounded half-to-even like the report code,
    and the training mark. ``report_order`` gives the sheet's row order."""
    from fieldlens.functions.scalars import clock_12h
    return rs.select(
        *REPORT_KEYS, "date_line", "assignment_id", "is_open", "shift_start",
        F.when(F.col("is_open"), F.lit("OPEN")).otherwise(F.col("assigned_name")).alias("employee_name"),
        "unit_name", "cost_center_name",
        F.coalesce(clock_12h("shift_start"), F.lit("")).alias("start_text"),
        F.coalesce(clock_12h("shift_end"), F.lit("")).alias("end_text"),
        F.bround(F.col("report_hours"), 1).alias("hours"),
        F.when(F.col("is_training"), F.lit("Yes")).otherwise(F.lit("")).alias("training"))
