"""Load jobs stopped at every step, quarantine reruns, models that follow their files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldlens import keyed, loads, sinks
from fieldlens.plans.ingest_queries import day_counts
from fieldlens.plans.models import DayModel
from fieldlens.session import scratch_path

SCHEMA = "id long, ts timestamp_ntz, v string"


def source(spark, items):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d), v) for i, d, v in items], SCHEMA)


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["plan", "merge", "done"])
def test_a_cursor_load_stopped_at_any_step_misses_nothing(spark, monkeypatch, step):
    job = loads.CursorLoad(spark, scratch_path(spark, f"cursor-{step}"), "ts", ["id"], "ts")
    first = [(1, 1, "a"), (2, 2, "a")]
    assert job.run(source(spark, first)) == 1 and job.run(source(spark, first)) is None
    second = [*first, (3, 3, "b"), (1, 4, "b")]
    real, calls = keyed.KeyedTable.merge, []

    def stop(self, *a, **k):
        calls.append(1)
        if step == "merge":
            raise Stopped
        real(self, *a, **k)
        if step == "done":
            raise Stopped

    with monkeypatch.context() as m:
        if step == "plan":
            m.setattr(loads.CursorLoad, "_bound", lambda *_: (_ for _ in ()).throw(Stopped()))
        else:
            m.setattr(keyed.KeyedTable, "merge", stop)
        with pytest.raises(Stopped):
            job.run(source(spark, second))
    # the source has grown before the run is repeated
    third = [*second, (4, 4, "c"), (5, 9, "c")]
    while job.run(source(spark, third)) is not None:
        pass
    held = sorted(tuple(r) for r in job.read(source(spark, third)).select("id", F.day("ts"), "v").collect())
    assert held == [(1, 4, "b"), (2, 2, "a"), (3, 3, "b"), (4, 4, "c"), (5, 9, "c")]
    assert job.mark() == dt.datetime(2024, 1, 9)


def test_an_empty_source_is_no_load(spark):
    job = loads.CursorLoad(spark, scratch_path(spark, "cursor-empty"), "ts", ["id"])
    assert job.run(source(spark, [])) is None and job.mark() is None
    assert job.run(source(spark, [(1, 1, "a")])) == 1


def test_a_chunk_load_takes_up_what_is_not_in_the_ledger(spark):
    job = loads.ChunkLoad(spark, scratch_path(spark, "chunks"))
    e = source(spark, [(i, i + 1, "x") for i in range(20)])
    days = [(dt.date(2024, 1, d), dt.date(2024, 1, d + 5)) for d in (1, 6, 11, 16)]
    seen = []

    def read(start, end, stop=None):
        seen.append(start)
        if start == stop:
            raise Stopped
        return e.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))

    with pytest.raises(Stopped):
        job.run(days, lambda a, b: read(a, b, days[2][0]))
    assert job.read().count() == 10 and job.ledger().count() == 2
    # data of a chunk that is not in the ledger is not read
    read(*days[2]).write.parquet(job._at("data", days[2][0]))
    assert job.read().count() == 10
    seen.clear()
    assert job.run(days, read) == seen == [d for d, _ in days[2:]]
    assert job.read().count() == 20 and job.run(days, read) == []
    assert job.run(days[:1], read, again=True) == [days[0][0]] and job.read().count() == 20


def test_a_rerun_stores_each_failing_row_once(spark):
    path = scratch_path(spark, "quarantine-runs")
    bad = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id long, issue string")
    for run in ("r1", "r1", "r2"):
        sinks.quarantine(bad, path, "rule_a", run, warn_at=2, error_at=3)
    sinks.quarantine(bad.limit(2), path, "rule_a", "r2", warn_at=2, error_at=3)  # fewer rows the second time
    sinks.quarantine(bad.limit(0), path, "rule_b", "r2")
    got = {(r.rule, r.run_id): (r.failures, r.severity) for r in sinks.run_summary(spark, path).collect()}
    assert got == {("rule_a", "r1"): (3, "error"), ("rule_a", "r2"): (2, "warn"), ("rule_b", "r2"): (0, "pass")}
    assert spark.read.parquet(f"{path}/rows").groupBy("run_id").count().where("run_id = 'r2'").first()["count"] == 2


EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def land(spark, path, name, days):
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, d, 3), i % 2, "click", 1.0) for i, d in enumerate(days)], EVENT)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def parts(path):
    return {d: sorted(os.listdir(f"{path}/table/{d}")) for d in os.listdir(f"{path}/table") if d.startswith("event_day")}


def test_a_day_model_rebuilds_only_touched_days(spark, monkeypatch):
    base = scratch_path(spark, "day-model")
    src = f"{base}/landing/*"
    land(spark, f"{base}/landing", "a", [1, 1, 2, 3])
    land(spark, f"{base}/landing", "b", [4, 5])
    model = DayModel(spark, f"{base}/model", src, "cast(ts as date)", day_counts, "event_day")
    assert [d.day for d in model.refresh()] == [1, 2, 3, 4, 5]
    before = parts(f"{base}/model")
    assert model.refresh() == [] and parts(f"{base}/model") == before
    land(spark, f"{base}/landing", "c", [2, 2])  # one late day
    assert [d.day for d in model.refresh()] == [2]
    after = parts(f"{base}/model")
    assert [d for d in after if after[d] != before[d]] == ["event_day=2024-01-02"]
    assert model.read().where("event_day = date'2024-01-02'").first().events == 3
    land(spark, f"{base}/landing", "b", [5])  # a file that changed: day 4 is left without rows
    stop = model.build
    model.build = lambda rows: (_ for _ in ()).throw(Stopped())
    with pytest.raises(Stopped):
        model.refresh()
    model.build = stop
    assert [d.day for d in model.refresh()] == [4, 5]
    want = sorted(map(str, day_counts(spark.read.parquet(src)).collect()))
    names = day_counts(spark.read.parquet(src)).columns
    assert sorted(map(str, model.read().select(*names).collect())) == want
    pruned = model.read().where("event_day >= date'2024-01-03'")
    assert pruned.select("_metadata.file_path").distinct().count() == 2  # days 3 and 5
    assert "PartitionFilters: [" in pruned._jdf.queryExecution().executedPlan().toString()
