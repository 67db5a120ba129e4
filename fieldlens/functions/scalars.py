"""Scalar column helpers (SC-*). All are built-in Spark expressions, so they stay inside
whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Exact minutes from ``start`` to ``end`` (double), NULL if either is NULL (SC-1).

    ``timestampdiff(MINUTE)`` truncates, so the difference is taken in microseconds.
    Works for TIMESTAMP and TIMESTAMP_NTZ alike.
    """
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(60_000_000.0)


def hours_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(3_600_000_000.0)


def add_minutes(ts: ColumnOrName, minutes: ColumnOrName) -> Column:
    return F.timestamp_add("MINUTE", col(minutes), col(ts))


def add_hours(ts: ColumnOrName, hours: ColumnOrName) -> Column:
    return F.timestamp_add("HOUR", col(hours), col(ts))


def add_seconds(ts: ColumnOrName, seconds: ColumnOrName) -> Column:
    return F.timestamp_add("SECOND", col(seconds), col(ts))


def dow0(d: ColumnOrName) -> Column:
    """Day of week with 0 = Sunday (PostgreSQL ``EXTRACT(DOW)``), SC-2."""
    return (F.dayofweek(col(d)) - 1).cast("int")


def week_start_monday(d: ColumnOrName) -> Column:
    """ISO week start (``date_trunc('week', d)::date``), SC-4."""
    return F.trunc(col(d).cast("date"), "week")


def week_start_sunday(d: ColumnOrName) -> Column:
    """Sunday-start week: ``date_trunc('week', d + 1) - 1``, SC-5."""
    return F.date_sub(F.trunc(F.date_add(col(d).cast("date"), 1), "week"), 1)


def week_start(d: ColumnOrName, first_day: str = "sun") -> Column:
    return week_start_sunday(d) if first_day == "sun" else week_start_monday(d)


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(col(d).cast("date"), "month")


def day_name(d: ColumnOrName, pad: bool = False) -> Column:
    """Full weekday name (``to_char(d, 'FMDay')``), SC-9; ``pad=True`` gives the
    blank-padded ``to_char(d, 'Day')`` form (9 characters)."""
    name = F.date_format(col(d), "EEEE")
    return F.rpad(name, 9, " ") if pad else name


def hour_bucket(ts: ColumnOrName) -> Column:
    """Military hour bucket '0000'..'2300' (``to_char(ts,'HH24') || '00'``), SC-10."""
    return F.concat(F.date_format(col(ts), "HH"), F.lit("00"))


def us_date(d: ColumnOrName) -> Column:
    """``MM/DD/YYYY`` text, SC-11."""
    return F.date_format(col(d), "MM/dd/yyyy")


def month_label(d: ColumnOrName) -> Column:
    """``Month YYYY`` text without padding, SC-11."""
    return F.date_format(col(d), "MMMM yyyy")


def clock_12h(ts: ColumnOrName) -> Column:
    """12-hour clock text such as ``07:00 AM``, SC-27."""
    return F.date_format(col(ts), "hh:mm a")


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a ``datetime`` or text, independent of the session and
    the JVM time zones (a naive ``datetime`` literal would be read in a zone)."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_instant(ts: ColumnOrName) -> Column:
    """The instant whose UTC wall clock is ``ts`` (TIMESTAMP_NTZ -> TIMESTAMP), without
    going through the session zone. Used where Spark needs an instant (watermarks)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), col(ts)))


def instant_to_ntz(ts: ColumnOrName) -> Column:
    """Inverse of :func:`utc_instant`: the UTC wall clock of an instant as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def epoch_ntz(epoch_seconds: ColumnOrName) -> Column:
    """UTC wall clock of a Unix epoch (seconds) as TIMESTAMP_NTZ, independent of session zone."""
    return F.timestamp_add("SECOND", col(epoch_seconds),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_to_local(epoch_seconds: ColumnOrName, tz: ColumnOrName) -> Column:
    """``TO_TIMESTAMP(epoch) AT TIME ZONE tz``: local wall clock as TIMESTAMP_NTZ (SC-12/13).

    ``tz`` may be a literal zone name or a column (one zone per source)."""
    tz_col = F.lit(tz) if isinstance(tz, str) and "/" in tz else col(tz)
    return F.convert_timezone(F.lit("UTC"), tz_col, epoch_ntz(epoch_seconds))


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole epoch seconds of a wall-clock timestamp read as UTC (floor)."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                    col(ts).cast("timestamp_ntz")) / F.lit(1_000_000)).cast("bigint")


def truthy(c: ColumnOrName) -> Column:
    """Truthiness of mixed encodings ('1', 'true', 't', 'yes', 1, TRUE), SC-25."""
    return F.lower(F.trim(col(c).cast("string"))).isin("1", "true", "t", "yes", "y")


def concat_skip_null(*cols: ColumnOrName) -> Column:
    """PostgreSQL ``CONCAT`` (NULL arguments are skipped), SC-17."""
    return F.concat_ws("", *[col(c) for c in cols])


def last_first(last: ColumnOrName, first: ColumnOrName) -> Column:
    """'Last, First' only if both present (NULL-propagating ``||``), SC-26."""
    return F.concat(col(last), F.lit(", "), col(first))


def round_half(c: ColumnOrName, scale: int) -> Column:
    """Round a double to ``scale`` decimals, half away from zero, in double arithmetic
    (``round(x * 10^n) / 10^n``): the same IEEE steps SQL engines use for a double
    ``round(x, n)``, so results agree bit for bit on equal inputs."""
    m = float(10 ** scale)
    return F.round(col(c) * F.lit(m)) / F.lit(m)


def exact_window_avg(c: ColumnOrName, window) -> Column:
    """Moving average whose result does not depend on the order of summation: the inputs
    are summed as decimals with 12 places, then divided once. Only a result is rounded."""
    total = F.sum(col(c).cast("decimal(28,12)")).over(window)
    return F.try_divide(total.cast("double"), F.count(col(c)).over(window).cast("double"))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: int | None = None) -> Column:
    """``num / NULLIF(den, 0)`` as double, optionally rounded (AG-13)."""
    r = F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))
    return round_half(r, scale) if scale is not None else r


def null_zero_date(c: ColumnOrName) -> Column:
    """Zero-date sentinel text ('0000-00-00 ...') to NULL, else a timestamp (SRC-9)."""
    s = col(c).cast("string")
    return F.when(s.startswith("0000-00-00"), F.lit(None).cast("timestamp_ntz")).otherwise(
        s.try_cast("timestamp_ntz"))


def round_numeric(c: ColumnOrName, scale: int = 2) -> Column:
    """``ROUND(x::numeric, n)``: round half up on the decimal value, not on the binary
    double (a double like 3.425 would otherwise round down). Returns double."""
    return F.round(col(c).cast("decimal(24,8)"), scale).cast("double")


def metres_to_miles(c: ColumnOrName) -> Column:
    """Metres to statute miles (SC-21)."""
    return col(c) / F.lit(1609.344)
