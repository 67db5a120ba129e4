"""Registered queries of the ingest side: date policies, keyed calendars from a seed, constant and unit
columns, refresh times, sinks read back, report order, backfill, stored cursors and sweeps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens import loads, sinks
from fieldlens.functions import scalars as S
from fieldlens.operators import calendar, quality, reports
from fieldlens.plans import models
from fieldlens.plans import queries as Q
from fieldlens.session import scratch_path
from fieldlens.sources import roles, tables

POLICY = {"modified": "created", "business": "pickup_time"}
REFRESHED = dt.datetime(2024, 2, 1, 6)


def q_window_scan_business(spark, root) -> DataFrame:
    """SRC-4: the same window by the business date instead of the time of change."""
    h = roles.header_base(spark, root).select("leg_id", "source_database", "created", "pickup_time")
    both = [tables.window_scan_policy(h, p, dt.datetime(1996, 3, 1), dt.datetime(1996, 4, 1), POLICY)
            .transform(tables.add_constant, "policy", p) for p in POLICY]
    return both[0].unionByName(both[1])


def q_keyed_periods(spark, root) -> DataFrame:
    """SRC-7, JN-9: pay periods per source, written as a CSV seed and read back typed; src1 is a week off."""
    sh = roles.shifts(spark, root)
    per = roles.periods(spark, sh, "date_line")
    shifted = [per.select(F.lit(s).alias("source_database"), "pay_period_year", "pay_period_number", F.date_add("start_date", d).alias("start_date"),
                          F.date_add("end_date", d).alias("end_date")) for s, d in (("src0", 0), ("src1", 7), ("src2", 0))]
    path = scratch_path(spark, "seed-periods")
    shifted[0].unionByName(shifted[1]).unionByName(shifted[2]).write.option("header", True).csv(path)
    seed = tables.load_seed(spark, path, "source_database string, pay_period_year int, pay_period_number int, start_date date, end_date date")
    out = calendar.assign_period(sh, seed, "date_line", keys=["source_database"])
    return out.select("assignment_id", "source_database", "date_line", "pay_period_number", "pay_period_start", "period_week")


def q_upsert_refresh(spark, root) -> DataFrame:
    """SNK-5: rows that come from the delta carry the time of the refresh, others none."""
    merged = sinks.merge_frames(roles.event_delta(spark, root, True), roles.event_delta(spark, root, False), ["event_id"],
                                updates={"refreshed_at": S.ntz_lit(REFRESHED)})
    return merged.select(*Q.EVENT_COLS, "refreshed_at")


def q_reconcile_merge(spark, root) -> DataFrame:
    """ST-2, ST-4: what a weekly sweep re-reads is merged over what an earlier load left out or had wrong."""
    h = roles.header_base(spark, root).select("leg_id", "source_database", "service_date", "last_status_id")
    start, end = calendar.reconcile_range(Q.AS_OF_ORDERS, extra_days=7)
    in_range = (F.col("service_date") >= F.lit(start)) & (F.col("service_date") < F.lit(end))
    early = h.where(~in_range | (F.col("leg_id") % 3 != 0)).withColumn("last_status_id", F.when(in_range, F.lit(0)).otherwise(F.col("last_status_id")))
    return sinks.merge_frames(early, h.where(in_range), ["source_database", "leg_id"])


def q_sinks_read_back(spark, root) -> DataFrame:
    """SNK-1, 7, 8, 9: rows of each sink after it was written; a run's quarantine and the replaced table were written twice."""
    runs = Q.runs(spark, root).select("leg_id", "region", "service_date", "enroute_time", "clear_time")
    bad = quality.dq_invalid_durations(runs).select("leg_id", "issue")
    base = scratch_path(spark, "sinks")
    sinks.write_replace(runs.limit(1), f"{base}/replace")
    sinks.write_replace(runs, f"{base}/replace")
    for _ in range(2):
        sinks.quarantine(bad, f"{base}/quarantine", "invalid_durations", "run-1")
    sinks.export_marts({"runs": runs.select("leg_id", "region")}, f"{base}/marts")
    sinks.write_report(runs.select("region", F.trunc("service_date", "year").alias("pay_period_start"), "leg_id"), f"{base}/report")
    out = [spark.read.parquet(f"{base}/{path}").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("leg_id").alias("legs")).select(F.lit(name).alias("sink"), "row_count", "legs")
           for name, path in (("replace", "replace"), ("quarantine", "quarantine/rows"), ("mart", "marts/runs"), ("report", "report"))]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def q_report_sorted(spark, root) -> DataFrame:
    """SL-1, SL-5, SL-6: the place of each row in its report, by open seat, start, name and id."""
    rs = Q._report_shifts(spark, root)
    order = Window.partitionBy(*reports.REPORT_KEYS).orderBy((~F.col("is_open")).asc(), F.col("shift_start").asc_nulls_last(),
                                                            F.col("assigned_name").asc_nulls_last(), "assignment_id")
    return rs.select(*reports.REPORT_KEYS, "assignment_id", "is_open", F.row_number().over(order).alias("place"))


def q_backfill(spark, root) -> DataFrame:
    """ST-6: a range loaded chunk by chunk. The first run stops after two chunks; the second finds them in the ledger and loads the rest."""
    e = tables.load_table(spark, root, "events", ["event_id", "ts", "event_type"])
    chunks = [(c.chunk_start, c.chunk_end) for c in calendar.backfill_chunks(spark, dt.date(2024, 1, 3), dt.date(2024, 1, 24)).collect()]  # calendar rows
    job = loads.ChunkLoad(spark, scratch_path(spark, "backfill"))
    read = lambda start, end: tables.window_scan(e, "ts", dt.datetime.combine(start, dt.time()), dt.datetime.combine(end, dt.time()))
    job.run(chunks[:2], read)
    job.run(chunks, read)
    return job.read().select("event_id", "ts", "event_type", "chunk_start")


def q_stored_cursor(spark, root) -> DataFrame:
    """SRC-5, ST-8: three loads, each from the stored mark on, over a source that grows."""
    e = tables.load_table(spark, root, "events", Q.EVENT_COLS)
    job = loads.CursorLoad(spark, scratch_path(spark, "cursor"), "ts", ["event_id"], "ts")
    for until in ("2024-01-10", "2024-01-20", "9999-01-01"):
        job.run(e.where(f"ts < timestamp_ntz'{until}'"))
    return job.read(e)


def q_quality_run(spark, root) -> DataFrame:
    """SNK-7, BO-47, BO-48: a run of rules, stored twice under one run id: failures and severity of each, and the rows kept for it."""
    runs = Q.runs(spark, root).select("leg_id", "source_database", "run_number", "enroute_time", "clear_time")
    base = scratch_path(spark, "quality")
    rules = {"invalid_durations": (quality.dq_invalid_durations(runs).select("leg_id", "issue"), 1, None),
             "missing_clear_time": (runs.where("clear_time is null").select("leg_id", F.lit("no clear time").alias("issue")), 1, 1),
             "missing_leg": (runs.where("leg_id is null").select("leg_id", F.lit("no leg").alias("issue")), 1, 1)}
    for rule, (failing, warn_at, error_at) in [*rules.items(), *rules.items()]:
        sinks.quarantine(failing, base, rule, "2024-02-01", warn_at, error_at)
    rows = spark.read.schema("leg_id long, issue string, rule string, run_id string").option("basePath", f"{base}/rows").parquet(f"{base}/rows")
    stored = rows.groupBy("rule", "run_id").agg(F.count(F.lit(1)).alias("stored_rows"))
    return sinks.run_summary(spark, base).join(stored, ["rule", "run_id"], "left").select("rule", "run_id", "failures", "severity", F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"))


def q_day_model(spark, root) -> DataFrame:
    """SNK-6: a model by day that follows its source: built over a first load, refreshed after a file with later and changed days arrived, read by a window of days."""
    e = tables.load_table(spark, root, "events", Q.EVENT_COLS)
    base = scratch_path(spark, "day-model")
    early = F.col("ts") < S.ntz_lit(dt.datetime(2024, 1, 20))
    model = models.DayModel(spark, f"{base}/model", f"{base}/landing", "cast(ts as date)", day_counts, "event_day")
    for part in (early & (F.col("event_id") % 2 == 0), early & (F.col("event_id") % 2 == 1) | ~early):
        e.where(part).repartitionByRange(4, "ts").write.mode("append").parquet(f"{base}/landing")
        model.refresh()
    out = model.read().where(F.col("event_day") >= F.lit(dt.date(2024, 1, 10)))
    return out.select("event_day", "event_type", "events", "users", S.round_half("value_sum", 4).alias("value_sum"))


def day_counts(events: DataFrame) -> DataFrame:
    """Events, users and value per day and type: what ``q_day_model`` keeps."""
    return events.groupBy(F.col("ts").cast("date").alias("event_day"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"), F.sum("value").alias("value_sum"))


def q_measures(spark, root) -> DataFrame:
    """SC-3, SC-21, UD-5: ISO week and year, metres to miles, and a predicate handed in by the caller."""
    h = roles.header_base(spark, root).withColumn("metres", F.col("mileage") * 1000.0)
    far = tables.with_predicate(h, F.col("metres") > 100_000)
    return far.select("leg_id", "service_date", F.weekofyear("service_date").alias("iso_week"), F.extract(F.lit("YEAROFWEEK"), "service_date").cast("int").alias("iso_year"),
                      S.round_half(S.metres_to_miles("metres"), 4).alias("miles"))


QUERIES = {
    "window_scan_business": q_window_scan_business,
    "keyed_periods": q_keyed_periods,
    "upsert_refresh": q_upsert_refresh,
    "reconcile_merge": q_reconcile_merge,
    "sinks_read_back": q_sinks_read_back,
    "report_sorted": q_report_sorted,
    "backfill": q_backfill,
    "stored_cursor": q_stored_cursor,
    "measures": q_measures,
    "quality_run": q_quality_run,
    "day_model": q_day_model,
}
