import datetime as dt

from pyspark.sql import functions as F

from fieldlens.functions.scalars import epoch_seconds
from fieldlens.operators import matching, staffing
from fieldlens.sources import roles


def test_matched_and_orphan_partition_all_punches(spark, root):
    sh, pu = roles.shifts(spark, root), roles.punches(spark, root)
    pairs = matching.matched_pairs(sh, pu)
    matched_punches = pairs.select("time_id").distinct().count()
    orphans = matching.orphan_intervals(sh, pu, pairs=pairs).count()
    assert matched_punches + orphans == pu.count()


def test_bucketed_join_equals_brute_force(spark, root):
    """The (user, time bucket) join finds exactly the pairs of the plain OR predicate."""
    sh = roles.shifts(spark, root).where(F.col("user_id").isNotNull())
    pu = roles.punches(spark, root)
    s = sh.select("assignment_id", "user_id", epoch_seconds("shift_start").alias("a"),
                  epoch_seconds("shift_end").alias("b"))
    cond = ((s.user_id == pu.time_user_id)
            & ((s.assignment_id == pu.shift_assignment_id) | (F.abs(s.a - pu.time_start_ts) < 3600)
               | ((pu.time_start_ts >= s.a) & (pu.time_start_ts < s.b))))
    brute = {(r.assignment_id, r.time_id) for r in s.join(pu, cond).select("assignment_id", "time_id").collect()}
    fast = matching.matched_pairs(sh, pu).collect()
    assert {(r.assignment_id, r.time_id) for r in fast} == brute
    assert len(fast) == len(brute)  # no duplicates from the bucket explode


def test_match_intervals_clock_out_fallback(spark):
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    sh = spark.createDataFrame([(1, 7, "s", t0, t0 + dt.timedelta(hours=8), t0.date(), 0)],
                               "assignment_id long, user_id long, source_database string, shift_start timestamp_ntz, "
                               "shift_end timestamp_ntz, date_line date, cost_center_id int")
    e0 = int(t0.replace(tzinfo=dt.timezone.utc).timestamp())
    pu = spark.createDataFrame([(10, 7, None, e0 + 600, 0, "s"), (11, 7, None, e0 + 20 * 3600, e0 + 21 * 3600, "s")],
                               "time_id long, time_user_id long, shift_assignment_id long, time_start_ts long, "
                               "time_end_ts long, source_database string")
    m = matching.match_intervals(sh, pu).collect()
    assert len(m) == 1 and m[0].time_id == 10 and m[0].is_clocked_in
    assert m[0].effective_clock_out == t0 + dt.timedelta(hours=8)  # still clocked in: scheduled end
    assert [r.time_id for r in matching.orphan_intervals(sh, pu).collect()] == [11]


def test_partners_and_staffing_null_guard(spark):
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    rows = [(1, 1, "A", "s", 5, t0.date(), t0), (2, 2, "B", "s", 5, t0.date(), t0), (3, None, None, "s", 5, t0.date(), t0),
            (4, 4, "D", "s", None, t0.date(), t0), (5, 5, "E", "s", None, t0.date(), t0)]
    df = spark.createDataFrame(rows, "assignment_id long, user_id long, assigned_name string, source_database string, "
                                     "unit_id long, date_line date, shift_start timestamp_ntz")
    df = df.withColumn("assignment_status", F.when(F.col("user_id").isNull(), "OPEN").otherwise("ASSIGNED"))
    p = {r.assignment_id: r for r in staffing.shift_partners(df).collect()}
    assert p[1].partner_count == 2 and p[1].partner_names == "B"  # open seat counts, gives no name
    assert p[3].partner_names == "A, B"
    assert p[4].partner_count == 0 and p[4].partner_names is None  # NULL unit: no partners
    st = {r.assignment_id: r for r in staffing.staffing(df).collect()}
    assert (st[1].total_positions, st[1].filled_positions, st[1].staffing_status) == (3, 2, "UNDERSTAFFED")
    assert st[4].staffing_status is None


def test_cumulative_hours_tie_break_and_open(spark):
    t0 = dt.datetime(2024, 1, 7, 8, 0)
    rows = [(2, 9, "s", t0, dt.date(2024, 1, 7), 8.0), (1, 9, "s", t0, dt.date(2024, 1, 7), 4.0),
            (3, None, "s", t0, dt.date(2024, 1, 7), 0.0)]
    df = spark.createDataFrame(rows, "assignment_id long, user_id long, source_database string, "
                                     "shift_start timestamp_ntz, week_start date, scheduled_hours double")
    got = {r.assignment_id: r.cumulative_hours for r in staffing.cumulative_hours(df).collect()}
    assert got == {1: 4.0, 2: 12.0, 3: None}


def test_staffing_filled_plus_open_is_total(spark, root):
    from fieldlens.plans import queries as Q
    st = Q.q_staffing_status(spark, root).where(F.col("total_positions").isNotNull())
    assert st.where(F.col("filled_positions") + F.col("open_positions") != F.col("total_positions")).count() == 0
    assert st.where(F.col("open_positions") < 0).count() == 0


def test_dense_grid_is_dates_times_centers(spark, root):
    from fieldlens.plans import queries as Q
    g = Q.q_dense_grid(spark, root)
    days = g.select("date_line").distinct().count()
    centers = roles.valid_cost_centers(spark).count()
    cells = g.select("date_line", "cost_center_id", "source_database").distinct().count()
    assert 0 < days <= 36 and cells == days * centers


def test_daily_operations_keeps_both_sides(spark, root):
    """FULL OUTER JOIN: every run day and every labour day appears exactly once per region."""
    from fieldlens.plans import queries as Q
    ops = Q.q_daily_operations(spark, root)
    assert ops.groupBy("region", "report_date").count().where("count > 1").count() == 0
    run_days = Q.runs(spark, root).where(F.col("region").isNotNull()).select("region", "service_date").distinct().count()
    assert ops.where((F.col("total_transports") + F.col("cancelled_calls") + F.col("turned_calls")) >= 0).count() >= run_days


def test_equal_ids_in_two_sources_do_not_match(spark):
    """Seats and punches are numbered per source database."""
    import datetime as dt
    from fieldlens.operators import matching
    day = dt.datetime(2024, 1, 2, 8)
    seat = [(s, 1, 7, day, day + dt.timedelta(hours=8), day.date(), 1) for s in ("src0", "src1")]
    shifts = spark.createDataFrame(seat, "source_database string, assignment_id long, user_id long, shift_start timestamp_ntz, "
                                         "shift_end timestamp_ntz, date_line date, cost_center_id int")
    t0 = int(day.replace(tzinfo=dt.timezone.utc).timestamp())
    punches = spark.createDataFrame([(5, 7, 1, t0, t0 + 60, "src0", day)], "time_id long, time_user_id long, shift_assignment_id long, "
                                    "time_start_ts long, time_end_ts long, source_database string, date_created timestamp_ntz")
    got = {(r.source_database, r.match_type) for r in matching.match_intervals(shifts, punches).collect()}
    assert got == {("src0", "direct_match"), ("src1", "no_timesheet")}
    other = punches.withColumn("source_database", F.lit("src2"))
    assert matching.orphan_intervals(shifts, other).count() == 1
    fact = matching.schedule_fact(shifts, matching.match_intervals(shifts, punches))
    assert fact.count() == 2


def test_open_seats_have_no_cumulative_hours(spark):
    import datetime as dt
    from fieldlens.operators import staffing
    d = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("src0", 1, 5, d, d.date(), 8.0), ("src0", 2, None, d, d.date(), 0.0), ("src0", 3, 5, d + dt.timedelta(days=1), d.date(), 4.0)],
                               "source_database string, assignment_id long, user_id long, shift_start timestamp_ntz, week_start date, scheduled_hours double")
    got = {r.assignment_id: r.cumulative_hours for r in staffing.cumulative_hours(df).collect()}
    assert got == {1: 8.0, 2: None, 3: 12.0}


def test_periods_reach_back_before_the_anchor(spark):
    import datetime as dt
    from fieldlens.sources import roles
    dates = spark.createDataFrame([(dt.date(2023, 11, 1),), (dt.date(2024, 1, 10),)], "d date")
    rows = roles.periods(spark, dates, "d").orderBy("start_date").collect()
    assert rows[0].start_date <= dt.date(2023, 11, 1) <= rows[0].end_date and rows[0].pay_period_number == -3
    assert any(r.start_date == dt.date(2023, 12, 24) and r.pay_period_number == 1 for r in rows)


def test_report_keeps_employees_of_one_name_apart(spark):
    import datetime as dt
    from fieldlens.operators import reports
    p = dt.date(2024, 1, 7)
    df = spark.createDataFrame([("src0", 1, "Lee, Ann", False, 8.0, "s", p), ("src0", 2, "Lee, Ann", False, 6.0, "s", p), ("src0", None, None, True, 5.0, "s", p), ("src1", None, None, True, 4.0, "s", p)],
                               "source_database string, user_id long, assigned_name string, is_open boolean, report_hours double, region string, pay_period_start date")
    got = sorted((r.row_kind, r.scheduled_hours) for r in reports.report_with_totals(df).collect())
    assert got == [("employee", 6.0), ("employee", 8.0), ("open", 9.0), ("total", 23.0)]
