import datetime as dt

from fieldlens.operators import classify, keys, timeline


def test_distinct_on_explicit_null_order(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d")], "k int, o int, v string")
    asc = {r.k: r.v for r in keys.distinct_on(df, ["k"], ["o"]).collect()}
    assert asc == {1: "c", 2: "d"}  # NULLs last on ascending keys
    desc = {r.k: r.v for r in keys.distinct_on(df, ["k"], [("o", "desc")]).collect()}
    assert desc == {1: "a", 2: "d"}  # NULLs first on descending keys (PostgreSQL default)
    latest = {r.k: r.v for r in keys.latest_by(df, ["k"], "o").collect()}
    assert latest == {1: "b", 2: "d"}


def test_current_revision_and_full_join(spark):
    h = spark.createDataFrame([(1, 2, "x"), (2, 1, "y"), (3, None, "z")], "leg_id long, rev int, h string")
    r = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 30), (4, 1, 40)], "leg_id long, rev int, v int")
    cur = {(x.leg_id, x.v) for x in keys.current_revision(h, r, ["leg_id"]).collect()}
    assert cur == {(1, 20), (2, 30)}
    fj = keys.revision_full_join(h, r, "leg_id").collect()
    assert len(fj) == 5  # superseded revision (1,1), orphan revision (4,1) and header without rev survive
    assert {(x.leg_id, x.rev) for x in fj if x.h is None} == {(1, 1), (4, 1)}


def test_run_outcome_three_valued(spark):
    df = spark.createDataFrame([(1, None), (-1, "lost"), (-1, None), (None, None), (0, None)],
                               "last_status_id int, lost_call_status string")
    got = [r.o for r in df.select(classify.run_outcome().alias("o")).collect()]
    assert got == ["ran", "turned", "cancelled", "cancelled", "unknown"]


def test_repair_duration_rules(spark):
    df = spark.createDataFrame([(500.0, 10.0), (800.0, 10.0), (800.0, 600.0), (2000.0, 600.0), (None, 1.0)],
                               "x double, miles double")
    got = [r.y for r in df.select(timeline.repair_duration("x", "miles").alias("y")).collect()]
    assert got == [500.0, 100.0, 800.0, 1440.0, None]


def test_valid_runs_and_stage_nulls(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    rows = [(1, None, t0, t0 + dt.timedelta(minutes=30)),          # valid
            (2, t0, t0, t0 + dt.timedelta(minutes=30)),            # cancelled
            (3, None, t0, t0 - dt.timedelta(minutes=1)),           # clear before assigned
            (4, None, t0, t0 + dt.timedelta(minutes=800)),         # too long
            (5, None, None, t0)]                                   # missing assigned
    df = spark.createDataFrame(rows, "leg_id int, canceled_time timestamp_ntz, assigned_time timestamp_ntz, "
                                     "clear_time timestamp_ntz")
    df = df.withColumn("time_on_task_minutes", timeline.minutes_between("clear_time", "assigned_time"))
    assert [r.leg_id for r in timeline.valid_runs(df).collect()] == [1]


def test_sla_anchor_fallbacks(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    df = spark.createDataFrame(
        [(1, None, t0, t0 + dt.timedelta(minutes=40), False),
         (2, t0, t0, t0 + dt.timedelta(minutes=40), True),
         (3, None, t0, None, True)],
        "leg_id int, requested_time timestamp_ntz, pickup_time timestamp_ntz, at_scene_time timestamp_ntz, "
        "emergency boolean")
    out = {r.leg_id: r for r in timeline.sla_on_time(df).collect()}
    assert out[1].sla_anchor_time == t0 + dt.timedelta(minutes=15) and out[1].is_sla_on_time is True
    assert out[2].sla_threshold_minutes == 30 and out[2].is_sla_on_time is False
    assert out[3].is_sla_on_time is None


def test_pointed_full_join_equals_general(spark):
    lines = spark.createDataFrame([(1, 1, 5), (1, 1, 3), (1, 2, 7), (2, 1, 9), (4, 3, 1)], "k long, r int, o int")
    h = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, h string")
    got = sorted(tuple(x) for x in keys.revision_full_join_pointed(*keys.pointed_revisions(h, lines, "k", "r", ["o"]), "k", rev="r").select("k", "r", "h", "o").collect())
    ptr = lines.groupBy("k").agg({"r": "max"}).withColumnRenamed("max(r)", "r")
    hdr = h.join(ptr, "k", "left")
    first = keys.distinct_on(lines, ["k", "r"], ["o"])
    want = sorted(tuple(x) for x in keys.revision_full_join(hdr, first, "k", header_rev="r", rev_rev="r")
                  .select("k", "rev", "h", "o").collect())
    assert got == want
    assert (1, 1, None, 3) in got and (3, None, "z", None) in got and (4, 3, None, 1) in got


def test_a_hot_leg_is_spread(spark):
    """One leg with a third of all revisions: no task of the full join gets more than three times the median."""
    import statistics
    from pyspark.sql import functions as F
    lines = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 7 + F.col("id")).alias("r"), F.col("id").alias("o"))
    h = lines.select("k").distinct().withColumn("h", F.lit("x"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = keys.revision_full_join_pointed(*keys.pointed_revisions(h, lines, "k", "r", ["o"]), "k", rev="r")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and max(sizes) <= 3 * statistics.median(sizes)
    assert out.where("h is not null").count() == h.count()
