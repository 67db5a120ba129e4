"""Interval matching: clock punches to scheduled shift seats (BO-17, BO-18) and the schedule
fact built on it (BO-19).

Scale design. The reference joins on the user plus an OR of three predicates. Joined on
the user alone, one busy user (or the NULL/open user) would put all of its shifts x
punches into one task. Here the fuzzy predicate is bounded in time: a punch can only
match a shift if it starts inside ``(start - tol, max(start + tol, end))``. Each shift
is therefore exploded to the few fixed-width time buckets that window touches, each
punch falls into exactly one bucket, and the equi-key becomes ``(user, bucket)``. Every
(shift, punch) pair meets in exactly one bucket, so no de-duplication is needed. Direct
matches (punch names the seat) are a separate equi-join on the seat id, and the fuzzy
join excludes them, so the two sets are disjoint and are simply unioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import (day_name, dow0, epoch_seconds, epoch_to_local, hours_between, month_start,
                                         week_start_monday)
from fieldlens.operators.keys import distinct_on


def live_seats(seats: DataFrame) -> DataFrame:
    """Seats that are not deleted (flag ``'0'``): what every model of the schedule reads."""
    return seats.where(F.col("deleted") == "0")


def matchable(seats: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Seats that punches may match: not deleted, published, regular, and assigned to a user that is there."""
    s = live_seats(seats).where((F.col("published") == "true") & (F.col("seat_type") == "Regular") & F.col("user_id").isNotNull())
    return s if users is None else s.join(users.select("user_id", "source_database"), ["user_id", "source_database"], "left_semi")


def of_users(punches: DataFrame, users: DataFrame) -> DataFrame:
    """Punches of users that are there."""
    u = users.select(F.col("user_id").alias("time_user_id"), "source_database")
    return punches.join(u, ["time_user_id", "source_database"], "left_semi")


def with_requirements(seats: DataFrame, personnel: DataFrame, templates: DataFrame, codes: DataFrame) -> DataFrame:
    """Seats with what they require (BO-19): of the notes for a source, unit and slot the one with the highest id names a certification template; and with
    the description of their earning code. The latest note is a top-1 per key, cut in each task before it is shuffled."""
    latest = distinct_on(personnel, ["source_database", "unit_id", "slot"], [("id", "desc")]).select(
        "source_database", "unit_id", F.col("slot").alias("position_slot"), "template_id")
    named = latest.join(templates, ["template_id", "source_database"], "left").select(
        "source_database", "unit_id", "position_slot", F.col("template_name").alias("required_qualification"), "min_licensure_id", "min_level_id")
    return (seats.join(named, ["source_database", "unit_id", "position_slot"], "left")
            .join(codes, ["earning_code_id", "source_database"], "left"))


def _prepare_shifts(shifts: DataFrame) -> DataFrame:
    return shifts.where(F.col("user_id").isNotNull()).withColumns({
        "_s_start": epoch_seconds("shift_start"),
        "_s_end": epoch_seconds("shift_end"),
    })


def _fuzzy(s_start, s_end, p_start, tol: int):
    return (F.abs(s_start - p_start) < tol) | ((p_start >= s_start) & (p_start < s_end))


def matched_pairs(shifts: DataFrame, punches: DataFrame, tol: int = 3600,
                  bucket_seconds: int = 21600) -> DataFrame:
    """All (source_database, assignment_id, time_id, match_type) pairs: direct or fuzzy, same
    user. Ids repeat across source databases, so the source is part of every key."""
    s = _prepare_shifts(shifts).select("source_database", "assignment_id", "user_id", "_s_start", "_s_end")
    p = punches.select(F.col("source_database").alias("_p_source"), "time_id", "time_user_id", "shift_assignment_id",
                       "time_start_ts")

    direct = (s.join(p, (s.source_database == p._p_source) & (s.assignment_id == p.shift_assignment_id)
                     & (s.user_id == p.time_user_id))
                .select("source_database", "assignment_id", "time_id", F.lit("direct_match").alias("match_type")))

    lo = F.floor((F.col("_s_start") - tol) / bucket_seconds)
    hi = F.floor(F.greatest(F.col("_s_start") + tol, F.col("_s_end")) / bucket_seconds)
    sb = s.withColumn("_bucket", F.explode(F.sequence(lo, hi)))
    pb = p.withColumn("_bucket", F.floor(F.col("time_start_ts") / bucket_seconds))
    cond = ((sb.source_database == pb._p_source) & (sb.user_id == pb.time_user_id) & (sb._bucket == pb._bucket)
            & _fuzzy(sb._s_start, sb._s_end, pb.time_start_ts, tol)
            & ~F.coalesce(sb.assignment_id == pb.shift_assignment_id, F.lit(False)))
    fuzzy = sb.join(pb, cond).select("source_database", "assignment_id", "time_id",
                                     F.lit("fuzzy_match").alias("match_type"))
    return direct.unionByName(fuzzy)


def _punch_times(punches: DataFrame, zones: DataFrame | None) -> DataFrame:
    p = punches
    if zones is not None:
        p = p.join(F.broadcast(zones), "source_database", "left")
        tz = F.coalesce(F.col("local_tz"), F.lit("UTC"))
    else:
        tz = F.lit("UTC")
    return p.withColumns({
        "clock_in_time": epoch_to_local("time_start_ts", tz),
        "clock_out_time": F.when(F.col("time_end_ts") != 0, epoch_to_local("time_end_ts", tz)),
    })


def match_intervals(shifts: DataFrame, punches: DataFrame, zones: DataFrame | None = None,
                    tol: int = 3600, bucket_seconds: int = 21600,
                    pairs: DataFrame | None = None) -> DataFrame:
    """Assigned seats LEFT JOIN punches by the direct-or-fuzzy predicate (BO-17): one row
    per (seat, matching punch), and one row with NULL punch columns for seats without
    any. The effective clock-out falls back to the scheduled end while still clocked in."""
    pairs = pairs if pairs is not None else matched_pairs(shifts, punches, tol, bucket_seconds)
    s = shifts.where(F.col("user_id").isNotNull()).select(
        "source_database", "assignment_id", "user_id",
        F.col("shift_start").alias("scheduled_start"), F.col("shift_end").alias("scheduled_end"),
        "date_line", "cost_center_id")
    p = _punch_times(punches, zones).select(
        "source_database", "time_id", "time_user_id", "clock_in_time", "clock_out_time", "time_start_ts", "time_end_ts")
    seat, punch = ["source_database", "assignment_id"], ["source_database", "time_id"]
    matched = s.join(pairs, seat).join(p, punch)
    unmatched = s.join(pairs.select(*seat), seat, "left_anti") \
        .withColumn("match_type", F.lit("no_timesheet"))
    rows = matched.unionByName(unmatched, allowMissingColumns=True)
    has_ts = F.col("time_id").isNotNull()
    return rows.withColumns({
        "effective_clock_out": F.when(F.col("time_end_ts") != 0, F.col("clock_out_time"))
                                .when(has_ts, F.col("scheduled_end")),
        "has_timesheet": has_ts,
        "is_clocked_in": has_ts & (F.col("time_end_ts") == 0),
        "is_clocked_out": has_ts & (F.col("time_end_ts") != 0),
        "has_assignment": F.lit(True),
    })


def orphan_intervals(shifts: DataFrame, punches: DataFrame, zones: DataFrame | None = None,
                     tol: int = 3600, bucket_seconds: int = 21600,
                     pairs: DataFrame | None = None) -> DataFrame:
    """Punches that match no assigned seat of their user (BO-18): a left anti-join by the
    same predicate, carried out on the punch id of the matched pairs."""
    pairs = pairs if pairs is not None else matched_pairs(shifts, punches, tol, bucket_seconds)
    p = _punch_times(punches, zones)
    orphans = p.join(pairs.select("source_database", "time_id"), ["source_database", "time_id"], "left_anti")
    return orphans.select(
        "source_database", F.lit(None).cast("bigint").alias("assignment_id"),
        F.col("time_user_id").alias("user_id"),
        F.col("clock_in_time").cast("date").alias("date_line"),
        "time_id", "time_user_id", "clock_in_time", "clock_out_time", "time_start_ts", "time_end_ts",
        F.when(F.col("time_end_ts") != 0, F.col("clock_out_time")).alias("effective_clock_out"),
        F.lit(True).alias("has_timesheet"),
        (F.col("time_end_ts") == 0).alias("is_clocked_in"),
        (F.col("time_end_ts") != 0).alias("is_clocked_out"),
        F.lit(False).alias("has_assignment"),
        F.lit("orphan").alias("match_type"))


def schedule_fact(shifts: DataFrame, matches: DataFrame, periods: DataFrame | None = None,
                  as_of=None, lookback_days: int | None = None) -> DataFrame:
    """Schedule fact at punch grain (BO-19, Q-10): every seat (open ones too) with its
    matched punches, assignment status, scheduled/open/worked hours and calendar flags.
    ``lookback_days`` restricts to recent seats (the time-bounded twin), ``None`` keeps
    the full history."""
    span = hours_between("shift_end", "shift_start")
    s = shifts
    if lookback_days is not None and as_of is not None:
        s = s.where(F.col("date_line") >= F.date_sub(F.lit(as_of), lookback_days))
    m = matches.select("source_database", "assignment_id", "time_id", "clock_in_time", "clock_out_time",
                       "effective_clock_out", "has_timesheet", "is_clocked_in", "is_clocked_out",
                       F.col("match_type").alias("timesheet_match_type"))
    out = s.join(m, ["source_database", "assignment_id"], "left").withColumns({
        "assignment_status": F.when(F.col("user_id").isNull(), "OPEN").otherwise("ASSIGNED"),
        "scheduled_hours": F.when(F.col("user_id").isNotNull(), span).otherwise(F.lit(0.0)),
        "open_hours": F.when(F.col("user_id").isNull(), span).otherwise(F.lit(0.0)),
        "hours_worked": F.when(F.col("clock_in_time").isNotNull() & F.col("effective_clock_out").isNotNull(),
                               hours_between("effective_clock_out", "clock_in_time")),
        "has_timesheet": F.coalesce("has_timesheet", F.lit(False)),
        "is_clocked_in": F.coalesce("is_clocked_in", F.lit(False)),
        "is_clocked_out": F.coalesce("is_clocked_out", F.lit(False)),
    })
    out = out.withColumns({
        "day_of_week": dow0("date_line"),
        "day_name": day_name("date_line"),
        "week_start": week_start_monday("date_line"),
        "month_start": month_start("date_line"),
    })
    if as_of is not None:
        out = out.withColumns({
            "is_today": F.col("date_line") == F.lit(as_of),
            "is_future": F.col("date_line") > F.lit(as_of),
            "is_today_or_future": F.col("date_line") >= F.lit(as_of),
            "days_from_today": F.datediff("date_line", F.lit(as_of)),
        })
    if periods is not None:
        from fieldlens.operators.calendar import assign_period
        out = assign_period(out, periods, "date_line")
    return out
