"""Data-quality rules (BO-47, BO-48): singular duration test and column tests. Each is
one filtered scan or one aggregation; failing rows can be stored with
:func:`fieldlens.sinks.quarantine`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import minutes_between


def dq_invalid_durations(df: DataFrame, start: str = "enroute_time", end: str = "clear_time",
                         max_minutes: float = 720.0) -> DataFrame:
    """Runs whose ``start -> end`` duration is negative or above ``max_minutes``,
    labelled by issue (BO-47)."""
    d = minutes_between(end, start)
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & ((d < 0) | (d > max_minutes))) \
        .withColumn("duration_minutes", d) \
        .withColumn("issue", F.when(F.col("duration_minutes") < 0, "negative_duration")
                    .otherwise("exceeds_12_hours"))


def dq_column_checks(df: DataFrame, table: str, not_null: Sequence[str] = (),
                     unique: Sequence[str] = ()) -> DataFrame:
    """not_null and unique tests as one aggregation over the table (BO-48): one output
    row per (column, test) with its failure count."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nn__{c}") for c in not_null]
    aggs += [(F.count(F.col(c)) - F.countDistinct(F.col(c))).alias(f"uq__{c}") for c in unique]
    wide = df.agg(*aggs)
    tests = [(c, "not_null", f"nn__{c}") for c in not_null] + [(c, "unique", f"uq__{c}") for c in unique]
    # turned into rows after the one aggregation, not by one aggregation per test
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), F.col(n).alias("failures"))
                               for c, t, n in tests])).alias("r")
    out = wide.select(rows).select(F.lit(table).alias("table_name"), "r.*")
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
