import datetime as dt

from pyspark.sql import functions as F

from fieldlens.functions import scalars as S


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def ts(s):
    return F.lit(dt.datetime.fromisoformat(s)).cast("timestamp_ntz")


def test_minutes_between_exact_and_null(spark):
    assert one(spark, S.minutes_between(ts("2024-01-01 10:00:30"), ts("2024-01-01 09:30:00"))) == 30.5
    assert one(spark, S.minutes_between(F.lit(None).cast("timestamp_ntz"), ts("2024-01-01 09:30:00"))) is None


def test_dow0_and_sunday_week(spark):
    sunday = F.lit(dt.date(2024, 1, 7))
    saturday = F.lit(dt.date(2024, 1, 13))
    assert one(spark, S.dow0(sunday)) == 0
    assert one(spark, S.dow0(saturday)) == 6
    assert one(spark, S.week_start_sunday(sunday)) == dt.date(2024, 1, 7)
    assert one(spark, S.week_start_sunday(saturday)) == dt.date(2024, 1, 7)
    assert one(spark, S.week_start_monday(sunday)) == dt.date(2024, 1, 1)


def test_truthy_mixed_encodings(spark):
    for v, want in [("1", True), ("true", True), (" T ", True), ("yes", True), ("0", False), ("false", False)]:
        assert one(spark, S.truthy(F.lit(v))) is want
    assert one(spark, S.truthy(F.lit(1))) is True
    assert one(spark, S.truthy(F.lit(None).cast("string"))) is None  # 3-valued logic kept


def test_concat_variants(spark):
    assert one(spark, S.concat_skip_null(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    assert one(spark, S.last_first(F.lit("Doe"), F.lit(None).cast("string"))) is None
    assert one(spark, S.last_first(F.lit("Doe"), F.lit("Jo"))) == "Doe, Jo"


def test_epoch_to_local_dst(spark):
    # 2024-03-10 08:30 UTC is after the US spring-forward (03:00 CDT), 2024-03-10 07:30 UTC before it
    after = int(dt.datetime(2024, 3, 10, 8, 30, tzinfo=dt.timezone.utc).timestamp())
    before = int(dt.datetime(2024, 3, 10, 7, 30, tzinfo=dt.timezone.utc).timestamp())
    assert one(spark, S.epoch_to_local(F.lit(after), F.lit("America/Chicago"))) == dt.datetime(2024, 3, 10, 3, 30)
    assert one(spark, S.epoch_to_local(F.lit(before), F.lit("America/Chicago"))) == dt.datetime(2024, 3, 10, 1, 30)
    assert one(spark, S.epoch_seconds(F.lit(S.epoch_ntz(F.lit(after))))) == after


def test_null_zero_date_and_rounding(spark):
    assert one(spark, S.null_zero_date(F.lit("0000-00-00 00:00:00"))) is None
    assert one(spark, S.null_zero_date(F.lit("2024-01-02 03:04:05"))) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, S.round_numeric(F.lit(3.425), 2)) == 3.43
    assert one(spark, S.round_half(F.lit(2.5), 0)) == 3.0
    assert one(spark, S.safe_ratio(F.lit(1), F.lit(0))) is None


def test_day_labels(spark):
    d = F.lit(dt.date(2024, 1, 7))
    assert one(spark, S.day_name(d)) == "Sunday"
    assert one(spark, S.us_date(d)) == "01/07/2024"
    assert one(spark, S.month_label(d)) == "January 2024"
    assert one(spark, S.hour_bucket(ts("2024-01-07 07:45:00"))) == "0700"
    assert one(spark, S.clock_12h(ts("2024-01-07 19:05:00"))) == "07:05 PM"
