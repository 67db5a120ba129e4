"""Row classifiers: run outcome, region, level, shift flags, attendance, urgency,
hours fallbacks (BO-3..6, BO-27, BO-30, BO-52, BO-54, BO-55). Each rule list is an
ordered searched CASE built from built-in predicates, so it stays in codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import col, hours_between, round_numeric

# ---------------------------------------------------------------------------
# Fixed values of the fixture rules (names of the driver tables' markets and types).
# Market list -> region; unlisted markets fall back to the source tag.
MARKET_REGIONS = [
    ("america", "west"),
    ("europe", "east"),
    ("africa", "east"),
    ("asia", "south"),
]
# Divisions: sources that are one division, and the markets of the others; other markets have none.
WHOLE_DIVISIONS = ["src0", "src1"]
DIVISION_MARKETS = [("america", "west"), ("europe", "east")]
# Cost-center name prefix -> region (LIKE patterns, first match wins).
COST_CENTER_REGIONS = [
    ("S%", "south"),
    ("M%", "middle"),
    ("L%", "west"),
]
# Cost-center name -> level of service (LIKE patterns, first match wins).
LEVEL_RULES = [
    ("%PROMO%", "Training"),
    ("S%", "BLS"),
    ("M%", "ALS"),
    ("L%", "CCT"),
    ("E%", "Orientation"),
]
# Shift-type rules.
TRAINING_PATTERNS = ["%PROMO%"]
TRAINING_UNIT_PATTERNS = ["%Orientation%"]
TRAINING_QUALIFICATIONS = ["Third Party", "%FTO%"]
SPECIAL_EVENT_PATTERNS = ["LARGE%"]
ORIENTATION_PATTERNS = ["ECON%"]
# Call types that count as a transport level (daily dashboard "ran" rule).
TRANSPORT_LEVEL_PATTERNS = ["%ALS%", "%BLS%", "%CCT%", "%SCT%"]
# ---------------------------------------------------------------------------


def run_outcome(status: str = "last_status_id", lost: str = "lost_call_status",
                require: Column | None = None, other: str = "unknown") -> Column:
    """Run outcome (BO-3): status > 0 ran; < 0 with a lost reason turned; < 0 without
    one, or NULL, cancelled; anything else ``other``. ``require`` adds a condition to the
    'ran' branch (BO-4: only transport levels count as ran)."""
    s, lo = col(status), col(lost)
    ran = s > 0 if require is None else (s > 0) & require
    return (F.when(ran, "ran")
             .when((s < 0) & lo.isNotNull(), "turned")
             .when((s < 0) & lo.isNull(), "cancelled")
             .when(s.isNull(), "cancelled")
             .otherwise(other))


def ordered_like(c: ColumnOrStr, rules: Sequence[tuple[str, str]], default: Column) -> Column:
    c = col(c)
    out = None
    for pattern, label in rules:
        out = (F.when(c.like(pattern), label) if out is None else out.when(c.like(pattern), label))
    return default if out is None else out.otherwise(default)


ColumnOrStr = Column | str


def region_from_market(market: ColumnOrStr = "market", source: ColumnOrStr = "source_database",
                       rules: Sequence[tuple[str, str]] = MARKET_REGIONS) -> Column:
    """Region by market list, fallback to the source tag (BO-5)."""
    m = col(market)
    out = None
    for name, region in rules:
        out = F.when(m == name, region) if out is None else out.when(m == name, region)
    return out.otherwise(col(source))


def division_from_market(market: ColumnOrStr = "market", source: ColumnOrStr = "source_database", whole: Sequence[str] = WHOLE_DIVISIONS,
                         rules: Sequence[tuple[str, str]] = DIVISION_MARKETS) -> Column:
    """Division next to region (BO-5): a source that is one division, else a narrower market list; NULL for all other markets."""
    s, m = col(source), col(market)
    out = F.when(s.isin(*whole), s)
    for name, division in rules:
        out = out.when(m == name, F.concat(s, F.lit("_" + division)))
    return out


def region_from_cost_center(name: ColumnOrStr = "cost_center_name", source: ColumnOrStr = "source_database",
                            rules: Sequence[tuple[str, str]] = COST_CENTER_REGIONS) -> Column:
    """Region by cost-center prefix, fallback to the source tag (BO-5)."""
    return ordered_like(name, rules, col(source))


def level_from_name(name: ColumnOrStr = "cost_center_name",
                    rules: Sequence[tuple[str, str]] = LEVEL_RULES) -> Column:
    """Level of service from a cost-center name, ordered LIKE rules, 'Other' last (BO-6)."""
    return ordered_like(name, rules, F.lit("Other"))


def any_like(c: ColumnOrStr, patterns: Sequence[str]) -> Column:
    c = col(c)
    out = F.lit(False)
    for p in patterns:
        out = out | F.coalesce(c.like(p), F.lit(False))
    return out


def shift_flags(df: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Shift type flags (BO-52): training, special event, orientation by name rules (training also by the unit's name and the
    certification that the seat requires, where the frame has them); field shift when (cost_center_id, source_database) is in the allow-list (row-value IN,
    FLT-3) as a broadcast left join against a list of fixed size."""
    training = any_like("cost_center_name", TRAINING_PATTERNS)
    for column, patterns in (("unit_name", TRAINING_UNIT_PATTERNS), ("required_qualification", TRAINING_QUALIFICATIONS)):
        if column in df.columns:
            training = training | any_like(column, patterns)
    out = df.withColumns({
        "is_training": training,
        "is_special_event": any_like("cost_center_name", SPECIAL_EVENT_PATTERNS),
        "is_orientation": any_like("cost_center_name", ORIENTATION_PATTERNS),
    })
    if allow is None:
        return out
    a = F.broadcast(allow.select("cost_center_id", "source_database",
                                 F.lit(True).alias("_allowed")).distinct())
    out = out.join(a, ["cost_center_id", "source_database"], "left")
    return out.withColumn("is_field_shift",
                          F.coalesce(F.col("_allowed"), F.lit(False)) & ~F.col("is_special_event")
                          & ~F.col("is_training")).drop("_allowed")



def attendance_flags(df: DataFrame, as_of: dt.date, partial_ratio: float = 0.9) -> DataFrame:
    """Attendance (BO-27): no-show = assigned, no clock-in, shift day before ``as_of``;
    partial = worked < 90% of scheduled; open = no user."""
    assigned = F.col("user_id").isNotNull()
    return df.withColumns({
        "is_open": ~assigned,
        "is_no_show": assigned & F.col("clock_in_time").isNull() & (F.col("date_line") < F.lit(as_of)),
        "is_partial_shift": F.coalesce(
            assigned & F.col("hours_worked").isNotNull()
            & (F.col("hours_worked") < F.col("scheduled_hours") * partial_ratio), F.lit(False)),
    })


def urgency_flags(df: DataFrame, as_of: dt.date, date_col: str = "date_line") -> DataFrame:
    """Urgency (BO-30): today, tomorrow, at most 3 days ahead (past days too), days until."""
    days = F.datediff(F.col(date_col), F.lit(as_of))
    return df.withColumns({
        "days_until_shift": days,
        "is_today": days == 0,
        "is_tomorrow": days == 1,
        "is_within_3_days": days <= 3,
    })


def hours_fallback(hours: ColumnOrStr = "scheduled_hours", start: ColumnOrStr = "shift_start",
                   end: ColumnOrStr = "shift_end") -> Column:
    """Scheduled-hours fallback (BO-54): when the stored hours are 0 use end - start (0
    if either is missing), else keep them."""
    h = col(hours)
    span = F.coalesce(hours_between(end, start), F.lit(0.0))
    return F.when(F.coalesce(h, F.lit(0.0)) == 0, span).otherwise(h)


def hours_variance(actual: ColumnOrStr = "hours_worked", scheduled: ColumnOrStr = "scheduled_hours",
                   scale: int = 2) -> Column:
    """Variance (BO-55): actual - scheduled, NULL when there is no actual."""
    a = col(actual)
    return F.when(a.isNotNull(), round_numeric(a - col(scheduled), scale))
