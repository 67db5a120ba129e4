"""Daily metrics and scorecards (BO-35..39, BO-56). All are grouped aggregations with
conditional sums/counts (partial aggregation before the shuffle), FULL OUTER joins of
already-aggregated sides, and guarded ratios."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import (day_name, dow0, exact_window_avg, hour_bucket, month_label, round_half,
                                         round_numeric, safe_ratio, us_date)
from fieldlens.operators.classify import TRANSPORT_LEVEL_PATTERNS, run_outcome

# ---------------------------------------------------------------------------
# Fixed values of the fixture (call types, levels and titles of the driver tables).
NON_TRANSPORT_CALL_TYPES = ["Medicar", "Standby - BLS"]
FLIGHT_CALL_TYPES = ["Flight"]
EMERGENCY_LEVELS = ["1-URGENT"]
EMERGENCY_COST_CENTERS = ["PROMO"]
EMERGENCY_REGIONS = ["west", "east"]
OPERATIONS_REGIONS = ["west", "east", "south", "middle"]
EMT_TITLES = ["AUTOMOBILE", "BUILDING"]
MEDIC_TITLES = ["MACHINERY"]
MARKET_NAMES = [
    ("west", "Western Market"),
    ("east", "Eastern Market"),
    ("south", "Southern Market"),
    ("middle", "Central Market"),
]
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# ---------------------------------------------------------------------------


def _cnt(cond) -> F.Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _sum_if(cond, x) -> F.Column:
    return F.sum(F.when(cond, x).otherwise(F.lit(0.0)))


def daily_transports(runs: DataFrame) -> DataFrame:
    """Run side of the scorecard: transports by level, long distance, 911, on time,
    time on task, cancelled and turned, per region and service day."""
    ran = F.col("run_outcome") == "ran"
    ct = F.col("calltype_name")
    transport = ran & ~ct.isin(*NON_TRANSPORT_CALL_TYPES)
    return runs.where(F.col("service_date").isNotNull() & F.col("region").isNotNull()) \
        .groupBy("region", "service_date").agg(
            _cnt((ct == "BLS") & ran).alias("bls_transports"),
            _cnt((ct == "ALS") & ran).alias("als_transports"),
            _cnt((ct == "CCT") & ran).alias("sct_transports"),
            _cnt(ct.isin(*FLIGHT_CALL_TYPES) & ran).alias("flight_transports"),
            _cnt(transport).alias("total_transports"),
            _cnt(transport & (F.col("mileage") > 50)).alias("ldt_over_50_miles"),
            _cnt(F.col("level_of_service").isin(*EMERGENCY_LEVELS)).alias("_calls_911"),
            _cnt(ran & (F.col("is_on_time") == F.lit(True))).alias("on_time_count"),
            _cnt(ran & F.col("is_on_time").isNotNull()).alias("on_time_eligible_count"),
            _sum_if(transport, F.col("time_on_task_minutes")).alias("total_time_on_task_minutes"),
            _cnt(F.col("run_outcome") == "cancelled").alias("cancelled_calls"),
            _cnt(F.col("run_outcome") == "turned").alias("turned_calls")) \
        .withColumn("calls_911", F.when(F.col("region").isin(*EMERGENCY_REGIONS), F.col("_calls_911"))
                    .otherwise(F.lit(0).cast("bigint"))).drop("_calls_911")  # CASE on the group key (AG-15)


def labour_hours(shifts: DataFrame, users: DataFrame, regions: Sequence[str] = OPERATIONS_REGIONS) -> DataFrame:
    """Labour-hour buckets per region-day (BO-56): units up AM/PM, clean / 911 / fully
    loaded / special-event / orientation hours, special-event hours by certification."""
    u = users.select("user_id", "source_database", "job_title")
    s = shifts.where(F.col("shift_date").isNotNull() & F.col("region").isNotNull()
                     & F.col("is_assigned") & F.col("region").isin(*regions)
                     & (F.col("is_field_shift") | F.col("is_special_event") | F.col("is_orientation")
                        | F.col("cost_center_name").isin(*EMERGENCY_COST_CENTERS)))
    j = s.join(u, ["user_id", "source_database"], "left")
    hrs = F.col("actual_hours_worked")
    worked = F.coalesce(hrs > 0, F.lit(False))
    some = F.coalesce(hrs, F.lit(0.0))
    se = F.col("is_special_event")
    emergency = F.col("cost_center_name").isin(*EMERGENCY_COST_CENTERS)

    def title(names):
        return F.coalesce(F.col("job_title").isin(*names), F.lit(False))

    buckets = {
        "clean_labor_hours": (F.col("is_field_shift") & ~F.col("is_training") & ~F.col("is_orientation") & worked & ~emergency, hrs),
        "hours_worked_911": (emergency, some),
        "fully_loaded_hours": ((F.col("is_field_shift") | se | F.col("is_orientation") | F.col("is_training")) & worked, hrs),
        "special_event_hours": (se, some),
        "orientation_hours": (F.col("is_orientation") | F.col("is_training"), some),
        "emt_special_event_hours": (se & title(EMT_TITLES), some),
        "medic_special_event_hours": (se & title(MEDIC_TITLES), some),
    }
    # first per unit, so that counting units is a plain count
    units = j.groupBy("region", "shift_date", "unit_name").agg(
        F.bool_or(F.hour("shift_start") < 12).alias("_am"), F.bool_or(F.hour("shift_start") >= 19).alias("_pm"),
        *[_sum_if(cond, value).alias(n) for n, (cond, value) in buckets.items()])
    named = F.col("unit_name").isNotNull()
    return units.groupBy("region", "shift_date").agg(
        F.count_if(named & F.col("_am")).alias("ambulances_up_am"), F.count_if(named & F.col("_pm")).alias("ambulances_up_pm"),
        F.count_if(named).alias("total_ambulances"), *[F.sum(n).alias(n) for n in buckets])


def daily_operations(runs: DataFrame, shifts: DataFrame, users: DataFrame) -> DataFrame:
    """Daily operations scorecard (BO-39): run side FULL OUTER JOIN hours side on
    (region, day); zero-filled counts and hours, guarded ratios."""
    t = daily_transports(runs).alias("t")
    s = labour_hours(shifts, users).alias("s")
    j = t.join(s, (F.col("t.region") == F.col("s.region")) & (F.col("t.service_date") == F.col("s.shift_date")),
               "full_outer")
    region = F.coalesce(F.col("t.region"), F.col("s.region"))
    day = F.coalesce(F.col("t.service_date"), F.col("s.shift_date"))
    z = lambda c, side: F.coalesce(F.col(f"{side}.{c}"), F.lit(0))
    zd = lambda c, side: round_half(F.coalesce(F.col(f"{side}.{c}"), F.lit(0.0)), 4)
    tot_hours = F.coalesce(F.col("t.total_time_on_task_minutes") / 60.0, F.lit(0.0))
    return j.select(
        region.alias("region"),
        # simple CASE region WHEN ... ELSE region (PRJ-4) as a literal map lookup
        F.coalesce(F.create_map(*[F.lit(x) for kv in MARKET_NAMES for x in kv])[region], region)
         .alias("market_name"),
        day.alias("report_date"),
        F.concat(us_date(day), F.lit("\n"), day_name(day)).alias("report_date_display"),
        F.year(day).alias("report_year"), F.month(day).alias("report_month"),
        month_label(day).alias("report_month_name"), day_name(day).alias("day_of_week"),
        dow0(day).alias("day_of_week_num"),
        *[z(c, "s").alias(c) for c in ("ambulances_up_am", "ambulances_up_pm", "total_ambulances")],
        *[z(c, "t").alias(c) for c in ("bls_transports", "als_transports", "sct_transports",
                                       "flight_transports", "total_transports", "ldt_over_50_miles",
                                       "calls_911")],
        *[zd(c, "s").alias(c) for c in ("fully_loaded_hours", "special_event_hours", "orientation_hours",
                                        "clean_labor_hours", "emt_special_event_hours",
                                        "medic_special_event_hours", "hours_worked_911")],
        z("on_time_count", "t").alias("on_time_count"),
        z("on_time_eligible_count", "t").alias("on_time_eligible_count"),
        safe_ratio("t.on_time_count", "t.on_time_eligible_count", 4).alias("on_time_percentage"),
        zd("total_time_on_task_minutes", "t").alias("total_time_on_task_minutes"),
        round_half(safe_ratio(tot_hours, "s.clean_labor_hours") * 2, 4).alias("time_on_task_percent"),
        round_half(safe_ratio("t.total_transports", "s.fully_loaded_hours") * 2, 4).alias("fully_loaded_uhu"),
        round_half(safe_ratio("t.total_transports", "s.clean_labor_hours") * 2, 4).alias("clean_uhu"),
        z("cancelled_calls", "t").alias("cancelled_calls"),
        z("turned_calls", "t").alias("turned_calls"),
    )


def daily_demand(runs: DataFrame) -> DataFrame:
    """Daily demand history per region with calendar features (BO-37)."""
    o = F.col("run_outcome")
    d = F.col("date_of_service")
    agg = runs.where(d.isNotNull()).groupBy("region", "date_of_service").agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.sum(F.when(o.isin("ran", "turned"), 1).otherwise(0)).cast("bigint").alias("demand_calls"),
        F.sum(F.when(o == "ran", 1).otherwise(0)).cast("bigint").alias("ran_count"),
        F.sum(F.when(o == "turned", 1).otherwise(0)).cast("bigint").alias("turned_count"),
        F.sum(F.when(o == "cancelled", 1).otherwise(0)).cast("bigint").alias("cancelled_count"))
    return agg.withColumns({
        "day_of_week_num": dow0(d), "day_of_week_name": day_name(d),
        "month": F.month(d), "year": F.year(d), "is_weekend": dow0(d).isin(0, 6)})


def demand_heatmap(spark: SparkSession, runs: DataFrame, as_of: dt.date, weeks: int = 5) -> DataFrame:
    """Hour x weekday demand heatmap over the last ``weeks`` weeks (BO-36, UD-1):
    ceil(count / weeks), zero-filled over the dense 24 x 7 grid (JN-7: a cross join of
    two fixed-size relations, 168 rows)."""
    hours = spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hh"))
    # the dense 24 x 7 grid is generated, not joined: one exploded weekday array per hour
    grid = hours.select(F.concat("hh", F.lit("00")).alias("hour_of_day"),
                        F.explode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("day_of_week"))
    start = dt.date.fromordinal(as_of.toordinal() - 7 * weeks)
    o = F.col("run_outcome")
    agg = runs.where((F.col("date_of_service") >= F.lit(start)) & (F.col("date_of_service") < F.lit(as_of))) \
        .groupBy("hour_of_day", "day_of_week").agg(
            F.sum(F.when(o == "ran", 1).otherwise(0)).alias("ran_count"),
            F.sum(F.when(o == "turned", 1).otherwise(0)).alias("turned_count"),
            F.count(F.lit(1)).alias("call_count"))
    j = F.broadcast(grid).join(agg, ["hour_of_day", "day_of_week"], "left")
    ceil_avg = lambda c: F.coalesce(F.ceil(F.col(c) / float(weeks)).cast("int"), F.lit(0))
    ysort = F.lit(8)
    for i, d in reversed(list(enumerate(WEEKDAYS, start=1))):
        ysort = F.when(F.lower("day_of_week") == d.lower(), i).otherwise(ysort)
    return j.select("hour_of_day", "day_of_week",
                    ceil_avg("ran_count").alias("avg_ran_count"),
                    ceil_avg("turned_count").alias("avg_turned_count"),
                    ceil_avg("call_count").alias("avg_call_count"),
                    F.col("hour_of_day").cast("int").alias("xsort"),
                    ysort.alias("ysort"))


def daily_dashboard(runs: DataFrame, cutoff_hour: int = 15) -> DataFrame:
    """Daily dashboard (BO-38, BO-4) per service day and region. A run counts as 'ran'
    only when its call type is a transport level (ILIKE rules); pre-scheduled means
    created before ``cutoff_hour`` on the day before service. Percentages are rounded
    like PostgreSQL numerics and are 0 when the base is 0."""
    ct = F.col("calltype_name")
    lvl = F.lit(False)
    for p in TRANSPORT_LEVEL_PATTERNS:
        lvl = lvl | F.coalesce(ct.ilike(p), F.lit(False))
    o = run_outcome(require=lvl, other="other")
    cutoff = F.timestamp_add("HOUR", F.lit(cutoff_hour - 24), F.col("date_of_service").cast("timestamp_ntz"))
    df = runs.where(F.col("date_of_service").isNotNull()).select(
        "date_of_service", "region", "leg_id", "mileage", "scene_time_minutes", "destination_to_clear_minutes", ct,
        o.alias("o"), F.coalesce(F.col("created") < cutoff, F.lit(False)).alias("pre"))
    ran = F.col("o") == "ran"

    def cnt(cond):
        return F.count(F.when(cond, F.col("leg_id")))

    g = df.groupBy("date_of_service", "region").agg(
        cnt(ran).alias("total_transports"),
        cnt(ran & ct.ilike("%ALS%")).alias("transports_als"),
        cnt(ran & ct.ilike("%BLS%")).alias("transports_bls"),
        cnt(ran & (ct.ilike("%SCT%") | ct.ilike("%CCT%"))).alias("transports_sct_cct"),
        cnt(F.col("pre")).alias("prescheduled_runs"),
        cnt(ran & (F.col("mileage") > 50)).alias("runs_over_50_miles"),
        cnt(ran & (F.col("scene_time_minutes") > 45)).alias("scene_time_over_45_min"),
        cnt(ran & (F.col("destination_to_clear_minutes") > 45)).alias("destination_time_over_45_min"),
        cnt(F.col("o") == "turned").alias("turns"),
        cnt(F.col("o") == "cancelled").alias("cancels"),
        F.count("leg_id").alias("total_calls"))

    def pct(num, den):
        return F.when(F.col(den) > 0, round_numeric(F.lit(100.0) * F.col(num) / F.col(den), 1)).otherwise(F.lit(0.0))

    return g.withColumns({
        "prescheduled_pct": pct("prescheduled_runs", "total_calls"),
        "long_distance_pct": pct("runs_over_50_miles", "total_transports"),
        "turn_rate_pct": pct("turns", "total_calls"),
        "cancel_rate_pct": pct("cancels", "total_calls"),
    })


def on_time_ma(sla_runs: DataFrame, rows: int = 7, type_col: str = "call_type",
               combined_label: str = "Combined", max_response: float = 120.0) -> DataFrame:
    """Daily on-time % by call type and combined, with a trailing ``rows``-row moving
    average and the window fill count (BO-35, WN-6/7, SET-3). Runs with a response time
    outside ``[0, max_response]`` minutes are left out. One GROUPING SETS aggregation gives
    both grains; the window is partitioned by the type label and holds one label's days
    (calendar-bounded). The frame counts rows, not calendar days (missing days widen it),
    as in the reference. Percentages round like PostgreSQL numerics."""
    r = F.col("sla_response_minutes")
    base = sla_runs.where(r.isNotNull() & (r >= 0) & (r <= max_response))
    g = base.groupingSets([["date_of_service", type_col], ["date_of_service"]], "date_of_service", type_col).agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.sum(F.when(F.col("is_sla_on_time"), 1).otherwise(0)).cast("bigint").alias("on_time_calls"),
        F.grouping(type_col).alias("_g"))
    g = g.withColumn(type_col, F.when(F.col("_g") == 1, F.lit(combined_label)).otherwise(F.col(type_col))) \
        .drop("_g")
    g = g.withColumn("on_time_percentage",
                     round_numeric(F.lit(100.0) * F.col("on_time_calls") / F.col("total_calls"), 2))
    w = Window.partitionBy(type_col).orderBy("date_of_service").rowsBetween(-(rows - 1), 0)
    return g.withColumns({
        f"on_time_percentage_{rows}day_ma": round_numeric(exact_window_avg("on_time_percentage", w), 2),
        "days_in_window": F.count(F.lit(1)).over(w),
    })
