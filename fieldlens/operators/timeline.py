"""Run timeline operators: stage durations, time on task, outlier repair, validity,
on-time metrics (BO-2, BO-7, BO-8, BO-9, BO-33, BO-34, BO-53)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import add_minutes, col, minutes_between, round_numeric

# (output column, end stage, start stage): consecutive status times and totals.
DEFAULT_STAGES: tuple[tuple[str, str, str], ...] = (
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
)


def stage_durations(df: DataFrame, stages: Sequence[tuple[str, str, str]] = DEFAULT_STAGES) -> DataFrame:
    """Minutes between consecutive status times; NULL unless both are present (BO-2)."""
    return df.withColumns({name: minutes_between(end, start) for name, end, start in stages})


def time_on_task(df: DataFrame, start: str = "assigned_time", end: str = "clear_time") -> DataFrame:
    """Time on task = end - start in minutes, and the same excluding transport
    (scene time + destination-to-clear) (BO-7). ``start`` is a parameter because the
    crew metrics use assigned time and the run mart uses enroute time (Q-25)."""
    scene = minutes_between("transporting_time", "at_scene_time")
    dest = minutes_between("clear_time", "at_destination_time")
    return df.withColumns({
        "time_on_task_minutes": minutes_between(end, start),
        "time_on_task_excl_transport_minutes": scene + dest,
    })


def repair_duration(x, miles, limit: float = 720.0, short_value: float = 100.0,
                    long_miles: float = 500.0, cap: float = 1440.0) -> F.Column:
    """Outlier repair (BO-8): keep <= limit; above it, short trips become ``short_value``
    and long trips (miles >= long_miles) are capped at ``cap``."""
    x, miles = col(x), col(miles)
    return (F.when(x.isNull(), F.lit(None).cast("double"))
             .when(x <= limit, x)
             .when(F.coalesce(miles, F.lit(0.0)) < long_miles, F.lit(short_value))
             .when(miles >= long_miles, F.least(x, F.lit(cap))))


def valid_runs(df: DataFrame, tot: str = "time_on_task_minutes", max_minutes: float = 720.0) -> DataFrame:
    """Invalid-run exclusion (BO-9): not cancelled, assigned and clear present, clear after
    assigned, 0 < time on task < ``max_minutes``."""
    return df.where(
        F.col("canceled_time").isNull() & F.col("assigned_time").isNotNull()
        & F.col("clear_time").isNotNull() & (F.col("clear_time") > F.col("assigned_time"))
        & (F.col(tot) > 0) & (F.col(tot) < max_minutes))


def otp(df: DataFrame, scheduled: str = "pickup_time", arrival: str = "at_scene_time",
        grace_minutes: float = 15.0, levels: Sequence[str] | None = ("ALS", "BLS", "CCT"),
        as_of=None, weeks: int | None = None) -> DataFrame:
    """Pickup on-time (BO-33): delay = max(arrival - scheduled, 0); strict on time when
    the delay is 0, on time within grace when it is <= ``grace_minutes``. A missing
    arrival or schedule leaves all three NULL (``GREATEST`` would otherwise turn a NULL
    delay into 0). ``levels`` keeps transport call types; ``as_of``/``weeks`` optionally
    keep the recent weeks before ``as_of`` (the reference's 5-week view)."""
    if levels is not None:
        df = df.where(F.col("calltype_name").isin(*levels))
    if as_of is not None and weeks is not None:
        import datetime as _dt
        df = df.where((F.col(scheduled) >= F.lit(as_of - _dt.timedelta(weeks=weeks)))
                      & (F.col(scheduled) < F.lit(as_of)))
    known = col(arrival).isNotNull() & col(scheduled).isNotNull()
    delay = F.when(known, F.greatest(minutes_between(arrival, scheduled), F.lit(0.0)))
    return df.withColumns({
        "pickup_delay_minutes": delay,
        "is_on_time_strict": delay == 0,
        "is_on_time_grace": delay <= grace_minutes,
        "pickup_week_start": F.trunc(col(scheduled).cast("date"), "week"),
    })


def sla_on_time(df: DataFrame, requested: str = "requested_time", scheduled: str = "pickup_time",
                arrival: str = "at_scene_time", emergent: str = "emergency",
                non_emergent_offset: int = 15, emergent_sla: int = 30,
                non_emergent_sla: int = 60) -> DataFrame:
    """SLA on-time (BO-34): the anchor is the requested time, else the scheduled pickup
    (plus ``non_emergent_offset`` minutes when not emergent); threshold 30 minutes for
    emergent, 60 otherwise; reports minutes from the SLA deadline."""
    anchor = F.coalesce(
        col(requested),
        F.when(col(emergent), col(scheduled)).otherwise(add_minutes(scheduled, F.lit(non_emergent_offset))))
    threshold = F.when(col(emergent), F.lit(emergent_sla)).otherwise(F.lit(non_emergent_sla))
    deadline = F.timestamp_add("MINUTE", threshold, anchor)
    minutes_from = minutes_between(arrival, deadline)
    return df.withColumns({
        "sla_anchor_time": anchor,
        "sla_threshold_minutes": threshold,
        "sla_response_minutes": minutes_between(arrival, anchor),
        "minutes_from_sla": minutes_from,
        "is_sla_on_time": F.when(col(arrival).isNull(), F.lit(None).cast("boolean"))
                           .otherwise(minutes_from <= 0),
    })


def run_flags(df: DataFrame, miles: str = "mileage", long_miles: float = 50.0,
              grace_minutes: float = 15.0, transport_types: Sequence[str] = ("ALS", "BLS", "CCT")) -> DataFrame:
    """Run flags (BO-53): long distance, transport run (transport call type), critical
    care, flight crew (level or call type), pickup variance, on time within grace (never
    NULL, Q-8)."""
    variance = minutes_between("at_scene_time", "pickup_time")
    ct = F.col("calltype_name")
    flight = F.coalesce(F.col("level_of_service").like("%Flight%"), F.lit(False)) | \
        F.coalesce(ct.like("%Flight%"), F.lit(False))
    return df.withColumns({
        "is_long_distance": F.coalesce(F.col(miles) > long_miles, F.lit(False)),
        "is_transport_run": F.coalesce(ct.isin(*transport_types), F.lit(False)),
        "is_critical_care": F.coalesce(ct == "CCT", F.lit(False)),
        "is_flight_crew": flight,
        "pickup_variance_minutes": round_numeric(variance, 2),
        "is_on_time": F.coalesce(variance <= grace_minutes, F.lit(False)),
    })
