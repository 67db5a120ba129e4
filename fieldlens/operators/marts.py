"""Wide run and shift marts the reporting operators read (the run mart: BO-3, BO-5,
BO-8, BO-53; the shift mart: BO-5, BO-6, BO-22, BO-27, BO-52, BO-55)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import day_name, dow0, hour_bucket, minutes_between, round_numeric
from fieldlens.operators.classify import (attendance_flags, division_from_market, hours_variance, level_from_name,
                                          region_from_cost_center, region_from_market, run_outcome,
                                          shift_flags)
from fieldlens.operators.timeline import repair_duration, run_flags, stage_durations


def run_mart(stage_times: DataFrame) -> DataFrame:
    """One row per run (current revision) with outcome, region, flags, durations and the
    repaired enroute-to-clear time on task."""
    df = stage_durations(stage_times)
    df = run_flags(df)
    raw_tot = F.when(F.col("clear_time") > F.col("enroute_time"),
                     round_numeric(minutes_between("clear_time", "enroute_time"), 2))
    return df.withColumns({
        "run_outcome": run_outcome(),
        "region": region_from_market(),
        "division": division_from_market(),
        "date_of_service": F.col("service_date"),
        "day_of_week": day_name("pickup_time"),
        "hour_of_day": hour_bucket("pickup_time"),
        "pickup_hour": F.hour("pickup_time"),
        "pickup_dow": dow0("pickup_time"),
        "raw_time_on_task_minutes": raw_tot,
        "time_on_task_minutes": repair_duration(raw_tot, "mileage"),
    })


def shift_mart(schedule: DataFrame, allow: DataFrame, as_of: dt.date) -> DataFrame:
    """Shift mart: region by cost-center prefix, level, type flags, attendance, rounded
    hours and variance."""
    df = shift_flags(schedule, allow)
    df = attendance_flags(df, as_of)
    return df.withColumns({
        "region": region_from_cost_center(),
        "level_of_service": level_from_name(),
        "shift_date": F.col("date_line"),
        "scheduled_hours_r": round_numeric("scheduled_hours", 2),
        "actual_hours_worked": round_numeric("hours_worked", 2),
        "hours_variance": hours_variance(),
        "is_assigned": F.col("assignment_status") == "ASSIGNED",
    })
