"""Staffing by time slice (BO-20, JN-13, AG-10) as a sweep line, without a range join of seats.

A unit's starts and ends cut its time into slices. A seat is active in the slices between its start and its end, so it adds one at its start and takes
one away at its end: seats become boundary events with signed counts and hours, which are added up per (unit, group, source, time) before anything is shuffled by
unit. A running sum over the events of a group gives what is active from each boundary on. A busy unit is split by its groups (which hold the date)
and a group by hours, whose totals are carried, so no task gets a unit's timeline. Hours are summed as decimals, so what was added is taken away exactly.

Who is active is not listed per slice: a seat is a member of its group's slices between its start and end (``slice_members``). Lists of names are made for
the slices of a report (``crew_names``)."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import hours_between, round_numeric

#: What a slice's rows have in common besides the unit and the times.
GROUP = ["cost_center_id", "cost_center_name", "date_line"]
_SUMS = ["n", "n_open", "n_assigned", "n_unassigned", "worked", "scheduled"]


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return functools.reduce(operator.and_, [left[k].eqNullSafe(right[k]) for k in keys])


def running_sums(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, sums: Sequence[str]) -> DataFrame:
    """``df`` with each of ``sums`` replaced by its running sum within ``keys`` in ``order``. Rows are dealt by key and ``bucket`` (a range of the order); the totals
    of a key's earlier buckets are carried, so a key of many rows is not one task's."""
    keys = list(keys)
    dealt = df.withColumn("_bucket", bucket)
    local = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = dealt.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    carried = carried.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_at"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in sums])
    own = dealt.withColumns({c: F.sum(c).over(local) for c in sums})
    cond = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]) & (F.col("_bucket") == F.col("_at"))
    return own.join(carried, cond).select(*[(F.col(c) + F.col(f"_{c}")).alias(c) if c in sums else F.col(c) for c in df.columns])


def unit_slices(seats: DataFrame, unit: str = "unit_name") -> DataFrame:
    """``(unit, start_time, end_time)``: neighbouring starts and ends of a unit's seats. The next boundary is found within a day; the last one of a day takes the first of
    the unit's next day that has one, from a row per unit and day."""
    s = seats.where(F.col(unit).isNotNull())
    ends = [s.select(unit, F.col(c).alias("start_time")).where("start_time is not null") for c in ("shift_start", "shift_end")]
    points = ends[0].unionByName(ends[1]).distinct().withColumn("_day", F.col("start_time").cast("date"))
    within = points.withColumn("_next", F.lead("start_time").over(Window.partitionBy(unit, "_day").orderBy("start_time")))
    days = points.groupBy(unit, "_day").agg(F.min("start_time").alias("_first"))
    days = days.withColumn("_later", F.lead("_first").over(Window.partitionBy(unit).orderBy("_day"))).drop("_first")
    return within.join(days, [unit, "_day"]).select(unit, "start_time", F.coalesce("_next", "_later").alias("end_time")).where("end_time is not null")


def _status(n_assigned: str, n_unassigned: str) -> Column:
    return F.concat_ws(", ", F.when(F.col(n_assigned) > 0, "ASSIGNED"), F.when(F.col(n_unassigned) > 0, "OPEN"))


def slice_facts(seats: DataFrame, unit: str = "unit_name", group: Sequence[str] = GROUP) -> DataFrame:
    """A row for each slice of a unit and group with a seat in it: count, statuses, scheduled, open and worked hours, utilization, sources.
    ``seats`` has one row per seat, or per seat and punch: every row counts, as in a schedule fact. A seat without a name is open; one without a unit, start or
    end, or that ends no later than it starts, is in no slice (its times still cut the unit's)."""
    group = list(group)
    key = [unit, *group, "source_database"]
    live = seats.where(F.col(unit).isNotNull() & (F.col("shift_end") > F.col("shift_start")))
    hours = [F.coalesce(c, F.lit(0.0)).cast("decimal(28,6)") for c in ("hours_worked", "scheduled_hours")]
    flags = [F.lit(1), F.col("assigned_name").isNull().cast("int"), F.coalesce((F.col("assignment_status") == "ASSIGNED").cast("int"), F.lit(0)),
             F.coalesce((F.col("assignment_status") == "OPEN").cast("int"), F.lit(0))]
    both = F.array(*[F.struct(F.col(c).alias("ts"), F.lit(s).alias("sign")) for c, s in (("shift_start", 1), ("shift_end", -1))])
    measured = live.select(*key, *[c.cast("long").alias(n) for c, n in zip(flags, _SUMS)], *[c.alias(n) for c, n in zip(hours, _SUMS[4:])], F.explode(both).alias("e"))
    changes = measured.groupBy(*key, F.col("e.ts").alias("start_time")).agg(*[F.sum(F.col(c) * F.col("e.sign")).cast("decimal(28,6)").alias(c) for c in _SUMS])
    spans = changes.groupBy(*key).agg(F.min("start_time").alias("_from"), F.max("start_time").alias("_to"))
    # a group's boundaries are the unit's between its first and last: met by unit and day, a boundary has one day
    days = spans.withColumn("_day", F.explode(F.sequence(F.col("_from").cast("date"), F.col("_to").cast("date")))).alias("g")
    cuts = unit_slices(seats, unit).withColumn("_day", F.col("start_time").cast("date")).alias("c")
    on = (F.col(f"g.{unit}") == F.col(f"c.{unit}")) & (F.col("g._day") == F.col("c._day")) & (F.col("c.start_time") >= F.col("_from")) & (F.col("c.start_time") < F.col("_to"))
    zero = [F.lit(0).cast("decimal(28,6)").alias(c) for c in _SUMS]
    met = days.join(cuts, on).select(*[F.col(f"g.{k}") for k in key], F.col("c.start_time"), F.col("c.end_time"), *zero)
    rows = met.unionByName(changes.withColumn("end_time", F.lit(None).cast("timestamp_ntz")))
    rows = rows.groupBy(*key, "start_time").agg(F.max("end_time").alias("end_time"), *[F.sum(c).cast("decimal(28,6)").alias(c) for c in _SUMS])
    active = running_sums(rows, key, "start_time", F.date_trunc("hour", "start_time"), _SUMS).where("n > 0")
    # sources are few; everything else is a sum
    whole = active.groupBy(unit, *group, "start_time", "end_time").agg(*[F.sum(c).alias(c) for c in _SUMS], F.array_join(F.array_sort(F.collect_set("source_database")), ", ").alias("source_databases"))
    length = round_numeric(hours_between("end_time", "start_time"), 2)
    out = whole.withColumn("interval_duration_hours", length)
    used = F.when(F.col("scheduled") > 0, round_numeric(F.col("worked").cast("double") / F.col("scheduled").cast("double") * 100, 1)).otherwise(F.lit(0.0))
    return out.select(
        unit, "start_time", "end_time", *group, F.col("n").cast("long").alias("crew_count"), _status("n_assigned", "n_unassigned").alias("assignment_statuses"),
        round_numeric(F.col("n") * F.col("interval_duration_hours"), 2).alias("total_scheduled_hours"),
        round_numeric(F.col("n_open") * F.col("interval_duration_hours"), 2).alias("total_open_hours"),
        F.round("worked", 2).cast("double").alias("total_worked_hours"), F.round("scheduled", 2).cast("double").alias("total_individual_scheduled_hours"),
        used.alias("utilization_percentage"), "source_databases", "interval_duration_hours")


def slice_members(seats: DataFrame, unit: str = "unit_name", group: Sequence[str] = GROUP) -> DataFrame:
    """A row for each seat that is in a slice: its unit and group, its name ('OPEN' without one), and the times between which it is in the slices. As many rows as seats."""
    full = F.when(F.col("first_name").isNotNull() & F.col("last_name").isNotNull(), F.concat_ws(" ", "first_name", "last_name"))
    name = F.coalesce("assigned_name", F.lit("OPEN"))
    return (seats.where(F.col(unit).isNotNull() & (F.col("shift_end") > F.col("shift_start")))
            .select(unit, *group, "source_database", "assignment_id", name.alias("crew_member_name"), F.coalesce(full, name).alias("crew_full_name"),
                    F.col("shift_start").alias("member_from"), F.col("shift_end").alias("member_to")))


def crew_names(slices: DataFrame, members: DataFrame, unit: str = "unit_name", group: Sequence[str] = GROUP) -> DataFrame:
    """``slices`` of a report with the names of who is in them, in order: the one place where lists are made. Members are met by unit, group and day."""
    group = list(group)
    key = [unit, *group]
    at = slices.withColumn("_day", F.col("start_time").cast("date")).alias("s")
    m = members.withColumn("_day", F.explode(F.sequence(F.col("member_from").cast("date"), F.col("member_to").cast("date")))).alias("m")
    on = functools.reduce(operator.and_, [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in [*key, "_day"]])
    met = at.join(m, on & (F.col("member_from") <= F.col("s.start_time")) & (F.col("member_to") >= F.col("s.end_time")))
    listed = F.array_sort(F.collect_list(F.struct("crew_member_name", "crew_full_name")))
    names = met.groupBy(*[F.col(f"s.{k}").alias(k) for k in key], F.col("s.start_time").alias("start_time")).agg(listed.alias("_listed"))
    return slices.join(names, same(slices, names, [*key, "start_time"])).select(
        *[slices[c] for c in slices.columns], F.array_join(F.col("_listed.crew_member_name"), "; ").alias("crew_names"), F.array_join(F.col("_listed.crew_full_name"), "; ").alias("crew_full_names"))
