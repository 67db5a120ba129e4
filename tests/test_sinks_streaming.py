import datetime as dt

from pyspark.sql import functions as F

from fieldlens import sinks
from fieldlens.plans import queries as Q
from fieldlens.session import scratch_path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_is_idempotent_and_delta_wins(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    d = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    once = sinks.merge_frames(t, d, ["id"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(sinks.merge_frames(once, d, ["id"])) == rows(once)


def test_upsert_to_new_version(spark):
    base = scratch_path(spark, "t-base")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.parquet(base)
    out = sinks.upsert(base, spark.createDataFrame([(2, "B")], "id int, v string"), ["id"], scratch_path(spark, "t-v1"))
    assert rows(out) == [(1, "a"), (2, "B")]


def test_append_snapshot_rerun_safe(spark):
    path = scratch_path(spark, "snap")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    for _ in range(2):
        sinks.append_snapshot(df, path, "snapshot_week_start", dt.date(2024, 1, 28))
    sinks.append_snapshot(df.limit(1), path, "snapshot_week_start", dt.date(2024, 2, 4))
    got = spark.read.parquet(path).groupBy("snapshot_week_start").count().collect()
    assert {(r.snapshot_week_start, r["count"]) for r in got} == {(dt.date(2024, 1, 28), 2), (dt.date(2024, 2, 4), 1)}


def test_stream_equals_batch(spark, root):
    assert rows(Q.q_stream_upsert(spark, root)) == rows(Q.q_upsert_merge(spark, root))
    assert Q.q_stream_dedup(spark, root).count() == spark.read.parquet(f"{root}/events.parquet").count()
    counts = Q.q_stream_daily_counts(spark, root)
    batch = spark.read.parquet(f"{root}/events.parquet").groupBy(
        F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").count()
    assert rows(counts.select("window_start", "event_type", "events")) == rows(batch)


def test_register_quarantine_export_report(spark, root):
    from fieldlens.functions.scalars import day_name
    from fieldlens.operators import quality
    runs = Q.runs(spark, root)
    bad = quality.dq_invalid_durations(runs)
    q = scratch_path(spark, "quarantine")
    for _ in range(2):
        row = sinks.quarantine(bad, q, "durations", "r1").first()
    assert spark.read.parquet(f"{q}/rows").count() == bad.count() == row.failures and row.severity == "warn"
    t = sinks.register(bad.select("leg_id", "issue"), "dq_failures", kind="table")
    assert spark.table("dq_failures").count() == t.count() == bad.count()
    out = scratch_path(spark, "marts")
    sinks.export_marts({"runs": runs.select("leg_id", "region")}, out)
    assert spark.read.parquet(f"{out}/runs").count() == runs.count()
    rep = scratch_path(spark, "report")
    daily = runs.groupBy("region", F.col("service_date").alias("pay_period_start")).count()
    sinks.write_report(daily, rep)
    assert spark.read.parquet(rep).count() == daily.count()
    padded = spark.range(1).select(day_name(F.lit(dt.date(2024, 1, 7)), pad=True).alias("d")).first().d
    assert padded == "Sunday   "


def test_stream_upsert_restart_resumes(spark, root):
    """A second run with the same root and checkpoint finds nothing new and returns the
    same merged table (the newest committed version)."""
    from fieldlens.sources import roles
    from fieldlens.streaming import jobs
    base = roles.event_delta(spark, root, True).select(*Q.EVENT_COLS)
    rt = scratch_path(spark, "restart")
    src = f"{root}/events.parquet"
    first = rows(jobs.stream_upsert(spark, src, base, ["event_id"], transform=Q._delta_transform, root=rt))
    again = rows(jobs.stream_upsert(spark, src, base, ["event_id"], transform=Q._delta_transform, root=rt))
    assert first == again == rows(Q.q_upsert_merge(spark, root))


EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _events(spark, path, first, n, day):
    ts = dt.datetime(2024, 1, day, 10)
    spark.createDataFrame([(first + i, ts, 1, "click", 1.0) for i in range(n)], EVENT).coalesce(1).write.mode("append").parquet(path)


def test_late_file_reaches_counts_upsert_and_dedup(spark):
    """A file with rows of long ago, after a run over newer ones, changes the result; so does a restart of each job."""
    from fieldlens.streaming import jobs
    src = scratch_path(spark, "late-source")
    roots = {k: scratch_path(spark, k) for k in ("counts", "dedup", "upsert")}
    empty = spark.createDataFrame([], EVENT)

    def run():
        return (sum(r.events for r in jobs.stream_window_counts(spark, src, by=["event_type"], root=roots["counts"]).collect()),
                jobs.stream_dedup(spark, src, ["event_id"], root=roots["dedup"]).count(),
                jobs.stream_upsert(spark, src, empty, ["event_id"], root=roots["upsert"]).count())

    _events(spark, src, 0, 5, 30)
    assert run() == (5, 5, 5)
    _events(spark, src, 100, 7, 10)
    assert run() == (12, 12, 12)
    _events(spark, src, 100, 7, 10)  # repeats: counted again, but one row per key
    assert run() == (19, 12, 12)
    assert run() == (19, 12, 12)


def test_a_key_that_returns_on_another_day_stays_one_row(spark):
    from fieldlens.streaming import jobs
    src, up, de = (scratch_path(spark, k) for k in ("moved-source", "moved-upsert", "moved-dedup"))
    empty = spark.createDataFrame([], EVENT)

    def run():
        return (sorted((r.event_id, r.ts.day) for r in jobs.stream_upsert(spark, src, empty, ["event_id"], root=up, buckets=3).collect()),
                sorted((r.event_id, r.ts.day) for r in jobs.stream_dedup(spark, src, ["event_id"], root=de).collect()))

    _events(spark, src, 0, 10, 1)
    _events(spark, src, 50, 1, 2)
    run()
    _events(spark, src, 50, 1, 3)
    _events(spark, src, 0, 1, 3)
    upserted, deduped = run()
    assert upserted == [(0, 3), *((i, 1) for i in range(1, 10)), (50, 3)]
    assert deduped == [*((i, 1) for i in range(10)), (50, 2)]


def test_models_follow_their_input(spark):
    import shutil
    import tempfile
    from fieldlens.plans.models import drop_models, table_model
    from fieldlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    root = tempfile.mkdtemp(prefix="model-input-")
    spark.range(3).write.parquet(f"{root}/t.parquet")
    build = lambda: spark.read.parquet(f"{root}/t.parquet")
    assert table_model(spark, root, "m", build).count() == 3
    assert table_model(spark, root, "m", build).count() == 3
    spark.range(7).write.mode("append").parquet(f"{root}/t.parquet")
    assert table_model(spark, root, "m", build).count() == 10
    drop_models(spark)
    shutil.rmtree(root)
