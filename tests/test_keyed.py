"""Keyed tables, partial counts and incremental windows: what a batch reads and writes, restarts, late and repeated rows, equality with one pass."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fieldlens import keyed
from fieldlens.keyed import KeyedTable
from fieldlens.session import scratch_path
from fieldlens.streaming import jobs

SCHEMA = "id long, part string, ts timestamp_ntz, v double"


def rows(spark, items):
    return spark.createDataFrame([(i, f"p{i % 3}", None if d is None else dt.datetime(2024, 1, d, 5), float(v)) for i, d, v in items], SCHEMA)


def table(spark, name, items, buckets, **how):
    base = rows(spark, items)
    return KeyedTable(spark, scratch_path(spark, name), base.schema, ["id", "part"], "ts").create(base, buckets, **how)


def held(t):
    return sorted((r.id, None if r.ts is None else r.ts.day, r.v) for r in t.read().collect())


def files(t):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{t.root}/data") for f in fs if f.endswith(".parquet")}


def test_merges_equal_a_dictionary(spark):
    rng = random.Random(4)
    want = {i: (i % 6 + 1, 0.0) for i in range(300)}
    t = table(spark, "keyed", [(i, d, v) for i, (d, v) in want.items()], 5)
    for step in range(1, 4):
        delta = {rng.randrange(400): (rng.choice([None, *range(1, 9)]), float(step)) for _ in range(40)}
        assert t.merge(step, rows(spark, [(i, d, v) for i, (d, v) in delta.items()]))
        assert not t.merge(step, rows(spark, [(7, 7, 7)]))  # committed: nothing happens
        want |= delta
        assert held(t) == sorted(((i, d, v) for i, (d, v) in want.items()), key=lambda r: (r[0],))
    t.vacuum(1)
    assert held(t) == sorted(((i, d, v) for i, (d, v) in want.items()), key=lambda r: (r[0],)) and t.versions() == [6]


def test_only_new_keys_are_added(spark):
    t = table(spark, "insert", [(1, 1, 1), (2, 2, 2)], 2)
    before = files(t)
    t.merge(1, rows(spark, [(1, 5, 9), (3, 3, 3), (3, 4, 4)]), order=["ts"], newer_wins=False)
    assert held(t) == [(1, 1, 1.0), (2, 2, 2.0), (3, 3, 3.0)] and before <= files(t)
    none = t.read().limit(0)
    assert t.merge(2, none) and len(held(t)) == 3


def test_cells_without_the_batch_s_keys_stay(spark):
    t = table(spark, "cells", [(i, i % 10 + 1, 0) for i in range(200)], 4)
    before = t.manifest(0).where(f"kind = {keyed.DATA}").count()
    t.merge(1, rows(spark, [(3, 9, 5), (900, 9, 5)]))
    manifest = t.manifest(2).where(f"kind = {keyed.DATA}")
    new = manifest.where(f"{keyed.VERSION} = 2").count()
    assert new <= 3 and manifest.where(f"{keyed.VERSION} = 0").count() == before - 1
    assert dict((i, (d, v)) for i, d, v in held(t))[3] == (9, 5.0)


def test_a_merge_that_stopped_is_repeated(spark, monkeypatch):
    t = table(spark, "stopped", [(i, 1, 0) for i in range(50)], 3)
    delta = rows(spark, [(1, 2, 5), (60, 1, 5)])
    for broken in ("_write", "_write_index", "_commit"):
        with monkeypatch.context() as m:
            def fail(*_, real=getattr(KeyedTable, broken), **__):
                if real.__name__ != "_commit":
                    real(*_, **__)
                raise RuntimeError("stopped")
            m.setattr(KeyedTable, broken, fail)
            with pytest.raises(RuntimeError):
                t.merge(1, delta)
        assert len(held(t)) == 50 and held(t)[1] == (1, 1, 0.0)  # readers see the version before
    assert t.merge(1, delta)
    assert len(held(t)) == 51 and held(t)[1] == (1, 2, 5.0)


def test_many_small_files_are_put_together_and_hot_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(keyed, "PARTS", 3)
    t = table(spark, "parts", [(0, 1, 0)], 1)
    for step in range(1, 6):
        t.merge(step, rows(spark, [(step, 1, step)]))
    assert len(held(t)) == 6
    assert t.manifest(10).where(f"kind = {keyed.DATA}").count() <= 3
    monkeypatch.setattr(keyed, "ROWS_A_TASK", 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        big = table(spark, "split", [(i, 1, 0) for i in range(100)], 1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files(big)) > 1 and len(held(big)) == 100


def test_buckets_grow_with_the_table(spark):
    t = table(spark, "grow", [(i, 1, 0) for i in range(100)], 1)
    assert not t.grow(60) and t.grow(10)
    assert t.manifest(1).where(f"kind = {keyed.LAYOUT}").first()[keyed.BUCKET] == 16
    t.merge(1, rows(spark, [(5, 2, 9)]))
    assert len(held(t)) == 100 and dict((i, v) for i, _, v in held(t))[5] == 9.0


def _bytes_read(spark):
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(stats.get(i).getBytesRead() for i in range(stats.size()))


def test_bytes_read_follow_the_batch_not_the_table(spark):
    read = []
    for size in (20_000, 200_000):
        base = spark.range(size).select("id", F.lit("p").alias("part"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 5 as int))").alias("ts"),
                                        F.rand(1).alias("v"))
        t = KeyedTable(spark, scratch_path(spark, f"bytes-{size}"), base.schema, ["id", "part"], "ts").create(base, size // 500)
        delta = base.where("id in (11, 12, 13)").withColumn("v", F.lit(1.0))
        delta = spark.createDataFrame(delta.collect(), base.schema)
        before = _bytes_read(spark)
        t.merge(1, delta)
        read.append(_bytes_read(spark) - before)
        assert t.read().where("v = 1.0").count() == 3
    assert read[1] < 2 * read[0]  # a table ten times as large


EVENT = "event_id long, ts timestamp_ntz, event_type string, value double"


def _put(spark, path, items):
    spark.createDataFrame([(i, None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=3), k, v) for i, d, k, v in items], EVENT).coalesce(1).write.mode("append").parquet(path)


def _counts(df):
    return sorted((r.window_start, r.event_type or "", r.events, None if r.value_sum is None else round(r.value_sum, 6)) for r in df.collect())


def test_counts_read_each_row_once_and_equal_one_count(spark, monkeypatch):
    seen = []
    real = jobs._run
    monkeypatch.setattr(jobs, "_run", lambda *a: seen.extend(real(*a)))
    monkeypatch.setattr(jobs, "PARTIALS", 2)
    src, root = scratch_path(spark, "count-source"), scratch_path(spark, "count-root")
    rng, total = random.Random(1), 0
    for part in range(6):
        items = [(i, rng.choice([None, *range(12)]), rng.choice("ab") if rng.random() < 0.9 else None, rng.choice([None, 1.25, 2.5])) for i in range(30 + part)]
        items += [(1, 0, "late", 1.0)] * part  # long ago, and repeated
        total += len(items)
        _put(spark, src, items)
        got = _counts(jobs.stream_window_counts(spark, src, by=["event_type"], root=root, max_files=1))
        want = _counts(jobs.daily_counts(spark.read.parquet(src), ["event_type"]))
        assert got == want
    assert sum(seen) == total


def test_a_failed_and_repeated_batch_counts_once(spark):
    root = scratch_path(spark, "partials")
    src = scratch_path(spark, "partials-source")
    _put(spark, src, [(1, 1, "a", 1.0), (2, 1, "a", None)])
    day = jobs.daily_counts(spark.read.parquet(src), ["event_type"])
    p = jobs.Partials(spark, root, day.schema, ["window_start", "event_type"], ["events", "value_sum"])
    assert p.read().count() == 0
    p.put(0, day)
    at, fs = keyed.fs_of(spark, f"{root}/partial/0/_SUCCESS")
    fs.delete(at, False)  # stopped before its commit
    assert p.read().count() == 0
    for _ in range(2):
        p.put(0, day)
    p.put(1, day)
    assert [r.events for r in p.read().collect()] == [4]
    p.fold(1)
    assert [r.events for r in p.read().collect()] == [4] and keyed.numbered(spark, f"{root}/partial") == []


def test_windows_follow_late_days_and_only_theirs(spark):
    src, root = scratch_path(spark, "window-source"), scratch_path(spark, "window-root")

    def run():
        got = jobs.stream_moving_windows(spark, src, ["event_type"], rows=4, root=root)
        want = jobs.moving_windows(jobs.daily_counts(spark.read.parquet(src), ["event_type"]), ["event_type"], "window_start", ["events", "value_sum"], 4)
        key = lambda r: tuple(str(round(x, 6) if isinstance(x, float) else x) for x in (r.window_start, r.event_type, r.events, r.value_sum, r.events_ma, r.value_sum_ma))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))

    _put(spark, src, [(i, d, k, float(d)) for i in range(3) for d in range(0, 40, 2) for k in ("a", "b")])
    run()
    _put(spark, src, [(9, 6, "a", 5.0)])  # a day that is there
    run()
    _put(spark, src, [(9, 11, "a", 5.0), (9, 3, None, 1.0)])  # a new day between others, a new group
    run()
    daily = jobs.daily_counts(spark.read.parquet(src), ["event_type"])
    changed = daily.where("event_type = 'a' and window_start = timestamp_ntz'2024-01-12'")
    need = jobs.reached(daily, changed, ["event_type"], "window_start", 4)
    assert need.where("_reached").count() == 4 and need.count() == 7 and need.where("event_type <> 'a'").count() == 0
