"""Calendar operators: period assignment, current/next period, period lookup, the
reconciliation range and weekly chunks (JN-9, JN-10, BO-28, BO-29, SRC-12, ST-4, ST-5).

Range joins of a date into ``[start, end]`` are rewritten as equi-joins: the periods
are exploded into one row per day (the calendar grows with the time span, about 365
rows a year, not with the data) and joined on the date. Spark then plans a hash join
(broadcast when AQE sees the calendar is small) instead of a nested-loop join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import week_start_sunday


def period_days(periods: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per day of every period."""
    return periods.withColumn("_day", F.explode(F.sequence(F.col(start), F.col(end))))


def assign_period(df: DataFrame, periods: DataFrame, date_col: str, keys: list[str] | None = None,
                  start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Attach the pay period containing ``date_col`` (left join) plus its week 1/2 (BO-28).

    ``keys`` adds equi-keys (e.g. per-source periods)."""
    keys = keys or []
    days = period_days(periods, start, end).select(
        *keys, "_day", F.col("pay_period_year"), F.col("pay_period_number"),
        F.col(start).alias("pay_period_start"), F.col(end).alias("pay_period_end"))
    out = df.join(days, [df[date_col] == days["_day"]] + [df[k] == days[k] for k in keys], "left")
    for k in keys:
        out = out.drop(days[k])
    out = out.drop("_day")
    return out.withColumn(
        "period_week",
        F.when(F.col("pay_period_start").isNotNull(),
               F.when(F.datediff(F.col(date_col), F.col("pay_period_start")) < 7, 1).otherwise(2)))


def current_next_period(periods: DataFrame, as_of: dt.date, start: str = "start_date") -> DataFrame:
    """Current period (latest start <= as_of) and next period (earliest start > as_of)
    (BO-29). Both are top-1 picks over the period list, planned as TakeOrderedAndProject."""
    cur = periods.where(F.col(start) <= F.lit(as_of)).orderBy(F.col(start).desc()).limit(1) \
        .withColumn("which", F.lit("current"))
    nxt = periods.where(F.col(start) > F.lit(as_of)).orderBy(F.col(start).asc()).limit(1) \
        .withColumn("which", F.lit("next"))
    return cur.unionByName(nxt)


def flag_current_next(df: DataFrame, periods: DataFrame, as_of: dt.date, date_col: str = "date_line",
                      start: str = "start_date", end: str = "end_date") -> DataFrame:
    """is_current_pay_period / is_next_pay_period flags. The two period bounds are
    uncorrelated scalar subqueries over the top-1 periods (JN-20), so the detail rows are
    filtered against constants and no join is planned."""
    cn = current_next_period(periods, as_of, start)

    def bound(which: str, c: str):
        return cn.where(F.col("which") == which).select(F.max(c)).scalar()

    d = F.col(date_col)
    return df.withColumns({
        "is_current_pay_period": F.coalesce((d >= bound("current", start)) & (d <= bound("current", end)),
                                            F.lit(False)),
        "is_next_pay_period": F.coalesce((d >= bound("next", start)) & (d <= bound("next", end)), F.lit(False)),
    })


def period_for(periods: DataFrame, day: dt.date, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The one period containing ``day`` (SRC-12): filter + ordered limit 1."""
    return periods.where((F.col(start) <= F.lit(day)) & (F.col(end) >= F.lit(day))) \
        .orderBy(F.col(start).desc()).limit(1)


def reconcile_range(as_of: dt.date, tier: str = "weekly", extra_days: int = 7) -> tuple[dt.date, dt.date]:
    """Weekly reconciliation window (ST-4): the last full Sunday-Saturday week before
    ``as_of``, extended by ``extra_days`` forward (7 for runs, 14 for schedules)."""
    # days since the most recent Sunday (Python weekday: Monday = 0)
    since_sunday = (as_of.weekday() + 1) % 7
    this_sunday = as_of - dt.timedelta(days=since_sunday)
    start = this_sunday - dt.timedelta(days=7)
    end = this_sunday + dt.timedelta(days=extra_days)
    return start, end


def reconcile_weeks(df: DataFrame, date_col: str, as_of: dt.date, extra_days: int = 7) -> DataFrame:
    """Rows of ``df`` inside the weekly reconciliation range, tagged with its Sunday week."""
    start, end = reconcile_range(as_of, extra_days=extra_days)
    d = F.col(date_col).cast("date")
    return df.where((d >= F.lit(start)) & (d < F.lit(end))).withColumns({
        "range_start": F.lit(start), "range_end": F.lit(end), "week_start": week_start_sunday(d)})


def week_chunks(df: DataFrame, month_col: str = "month_start") -> DataFrame:
    """Monthly sweep split into 7-day chunks clipped at the month end (ST-5): for each
    month in ``df`` one row per chunk ``[chunk_start, chunk_end)``; one distributed job
    over all months instead of a driver loop."""
    m = F.col(month_col).cast("date")
    month_end = F.add_months(m, 1)
    starts = F.sequence(m, F.date_sub(month_end, 1), F.expr("INTERVAL 7 DAYS"))
    out = df.select(m.alias("month_start"), month_end.alias("month_end")).distinct() \
        .withColumn("chunk_start", F.explode(starts))
    return out.withColumns({
        "chunk_end": F.least(F.date_add("chunk_start", 7), F.col("month_end")),
        "chunk_no": (F.floor(F.datediff("chunk_start", "month_start") / 7) + 1).cast("int"),
    })


def backfill_chunks(spark, start: dt.date, end: dt.date, chunk_days: int = 7) -> DataFrame:
    """Manual backfill over any range (ST-6): the half-open range ``[start, end)`` cut
    into ``chunk_days`` chunks, as rows (one job processes all chunks, no driver loop)."""
    s = F.lit(start)
    last = F.date_sub(F.lit(end), 1)
    out = spark.range(1).select(F.explode(F.sequence(s, last, F.expr(f"INTERVAL {chunk_days} DAYS"))).alias("chunk_start"))
    return out.withColumn("chunk_end", F.least(F.date_add("chunk_start", chunk_days), F.lit(end)))




__all__ = ["period_days", "assign_period", "current_next_period", "flag_current_next", "period_for",
           "reconcile_range", "reconcile_weeks", "week_chunks", "Window"]
