import datetime as dt

from pyspark.sql import functions as F

from fieldlens.operators import calendar, reports
from fieldlens.sources import roles, tables
from fieldlens.session import scratch_path


def test_reconcile_range_is_last_full_week_plus_extra():
    # Thursday 2024-01-25: this Sunday is 01-21, last week starts 01-14
    assert calendar.reconcile_range(dt.date(2024, 1, 25), extra_days=7) == (dt.date(2024, 1, 14), dt.date(2024, 1, 28))
    assert calendar.reconcile_range(dt.date(2024, 1, 21), extra_days=14) == (dt.date(2024, 1, 14), dt.date(2024, 2, 4))


def test_week_chunks_clip_at_month_end(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1),)], "month_start date")
    rows = calendar.week_chunks(df).orderBy("chunk_no").collect()
    assert [(r.chunk_start, r.chunk_end) for r in rows] == [
        (dt.date(2024, 2, 1), dt.date(2024, 2, 8)), (dt.date(2024, 2, 8), dt.date(2024, 2, 15)),
        (dt.date(2024, 2, 15), dt.date(2024, 2, 22)), (dt.date(2024, 2, 22), dt.date(2024, 2, 29)),
        (dt.date(2024, 2, 29), dt.date(2024, 3, 1))]


def test_backfill_chunks(spark):
    rows = calendar.backfill_chunks(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 10), 4).orderBy("chunk_start").collect()
    assert [(r.chunk_start.day, r.chunk_end.day) for r in rows] == [(1, 5), (5, 9), (9, 10)]


def test_assign_period_and_current_next(spark, root):
    sh = roles.shifts(spark, root)
    per = roles.periods(spark, sh, "date_line")
    got = calendar.assign_period(sh, per, "date_line")
    assert got.count() == sh.count()  # left join on the exploded calendar: no fan-out
    assert got.where(F.col("pay_period_start").isNull()).count() == 0
    wk = got.select(F.datediff("date_line", "pay_period_start").alias("d"), "period_week").collect()
    assert all((r.d < 7) == (r.period_week == 1) for r in wk)
    cn = {r.which: r.start_date for r in calendar.current_next_period(per, dt.date(2024, 1, 25)).collect()}
    assert cn["current"] == dt.date(2024, 1, 21)


def test_load_seed_typed(spark):
    path = scratch_path(spark, "seed") + ".csv"
    with open(path, "w") as f:
        f.write("pay_period_year,pay_period_number,start_date,end_date\n2024,1,2023-12-24,2024-01-06\n")
    df = tables.load_seed(spark, path, "pay_period_year int, pay_period_number int, start_date date, end_date date")
    r = df.first()
    assert (r.pay_period_year, r.start_date) == (2024, dt.date(2023, 12, 24))


def test_values_relation_and_union_sources(spark):
    v = tables.values_relation(spark, [(1, "a"), (2, None)], "id int, name string")
    assert sorted(tuple(r) for r in v.collect()) == [(1, "a"), (2, None)]
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2,)], "id int")
    u = tables.union_sources({"s1": a, "s2": b}).orderBy("id").collect()
    assert [(r.id, r.a, r.source_database) for r in u] == [(1, "x", "s1"), (2, None, "s2")]


def test_report_totals_and_order(spark):
    rows = [("r", dt.date(2024, 1, 7), 1, "A", False, 8.0, dt.datetime(2024, 1, 7, 8)),
            ("r", dt.date(2024, 1, 7), None, None, True, 6.0, dt.datetime(2024, 1, 7, 6)),
            ("r", dt.date(2024, 1, 7), 2, "B", False, 4.0, dt.datetime(2024, 1, 7, 7))]
    df = spark.createDataFrame(rows, "region string, pay_period_start date, user_id long, assigned_name string, "
                                     "is_open boolean, report_hours double, shift_start timestamp_ntz")
    t = {r.row_label: r.scheduled_hours for r in reports.report_with_totals(df).collect()}
    assert t == {"A": 8.0, "B": 4.0, "OPEN": 6.0, "TOTAL": 18.0}
    assert [r.is_open for r in reports.report_order(df).collect()] == [True, False, False]
