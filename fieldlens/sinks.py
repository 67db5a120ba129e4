"""Sinks and write modes (SNK-*): full replace, upsert/merge on a key, snapshot append,
quarantine, mart export, partitioned report output.

Plain Parquet has no ``MERGE INTO``; an upsert is a union of target and delta with a
priority column and ``row_number() = 1`` per key (top-1 pruned before the shuffle),
written to a new version folder, never over the folder being read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.keys import distinct_on


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full replace (SNK-1)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def merge_frames(target: DataFrame, delta: DataFrame, keys: Sequence[str],
                 order: Sequence = (), updates: Mapping[str, F.Column] | None = None) -> DataFrame:
    """Upsert result (SNK-2, SNK-3): delta rows win over target rows with the same key;
    among rows of one side, ``order`` decides (first wins). ``updates`` sets columns on
    the rows that came from the delta (SNK-5, e.g. a refresh timestamp)."""
    t = target.withColumn("_from_delta", F.lit(0))
    d = delta.withColumn("_from_delta", F.lit(1))
    if updates:
        d = d.withColumns(updates)
        t = t.withColumns({k: F.lit(None).cast(d.schema[k].dataType) for k in updates if k not in t.columns})
    u = t.unionByName(d, allowMissingColumns=True)
    return distinct_on(u, keys, [("_from_delta", "desc"), *order]).drop("_from_delta")


def upsert(target_path: str, delta: DataFrame, keys: Sequence[str], out_path: str,
           order: Sequence = ()) -> DataFrame:
    """Merge ``delta`` into the Parquet table at ``target_path`` and write the merged
    version to ``out_path``; returns a reader of the new version."""
    spark = delta.sparkSession
    merged = merge_frames(spark.read.parquet(target_path), delta, keys, order)
    merged.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def tag_snapshot(df: DataFrame, tag_col: str, tag: dt.date) -> DataFrame:
    return df.withColumn(tag_col, F.lit(tag))


def append_snapshot(df: DataFrame, path: str, tag_col: str, tag: dt.date) -> None:
    """Append with a snapshot tag (SNK-4); rerun-safe because only the tagged partition is
    overwritten (dynamic partition overwrite)."""
    tag_snapshot(df, tag_col, tag).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(tag_col).parquet(path)


def register(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """Materialize a model (SNK-6): ``view`` registers a temp view (recomputed on read);
    ``table`` writes Parquet under the shared checkpoint folder and registers a view over
    the written files (computed once)."""
    spark = df.sparkSession
    if kind == "table":
        from fieldlens.session import scratch_path
        path = scratch_path(spark, f"table-{name}")
        df.write.mode("overwrite").parquet(path)
        df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def quarantine(failing: DataFrame, path: str, rule: str, run_id: str, warn_at: int = 1, error_at: int | None = None) -> DataFrame:
    """Store the failing rows of a DQ rule in a run (SNK-7), and a row of the run's summary; -> that row.

    Rows and summary lie in a folder of the rule and the run, which a second try overwrites, also by fewer rows or none: each run has its rows once.
    The severity is ``error`` from ``error_at`` failures on (never, if None), ``warn`` from ``warn_at``, else ``pass``."""
    spark = failing.sparkSession
    at = f"rule={rule}/run_id={run_id}"
    failing.withColumn("quarantined_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/rows/{at}")
    stored = spark.read.schema(failing.schema).parquet(f"{path}/rows/{at}")
    n = F.count(F.lit(1))
    severity = F.when(n >= error_at, "error") if error_at is not None else F.when(F.lit(False), "error")
    summary = stored.agg(n.alias("failures"), severity.when(n >= warn_at, "warn").otherwise("pass").alias("severity"))
    summary.write.mode("overwrite").parquet(f"{path}/summary/{at}")
    return spark.read.schema(summary.schema).parquet(f"{path}/summary/{at}").select(F.lit(rule).alias("rule"), F.lit(run_id).alias("run_id"), "failures", "severity")


def run_summary(spark, path: str) -> DataFrame:
    """``(rule, run_id, failures, severity)`` of all runs stored under ``path``."""
    schema = "failures long, severity string, rule string, run_id string"
    return spark.read.schema(schema).option("basePath", f"{path}/summary").parquet(f"{path}/summary").select("rule", "run_id", "failures", "severity")


def export_marts(marts: Mapping[str, DataFrame], root: str) -> None:
    """Replace each named mart under ``root`` (SNK-8)."""
    for name, df in marts.items():
        write_replace(df, f"{root.rstrip('/')}/{name}")


def write_report(df: DataFrame, root: str, partition_by: Sequence[str] = ("region", "pay_period_start")) -> None:
    """Per-region, per-period report output (SNK-9). Rows are dealt by partition first, so a
    partition is one file (or a few), not one from every task."""
    write_replace(df.repartition(*partition_by), root, partition_by)
