"""Structured Streaming jobs for the reference's polling loads (ST-1, ST-3, ST-9, ST-10).

The reference re-reads a recent window every ten minutes and merges it, and sweeps further
back weekly and monthly, so a late row is never lost. Here a file stream is read with
``trigger(availableNow=True)`` (catch up, then stop; schedule it like the polling). There is no
watermark: a row of any age counts, and a batch reads what it changes, not the target or the source:

* Keyed loads (``stream_upsert``, ``stream_dedup``) merge into a :class:`fieldlens.keyed.KeyedTable` under the batch's number.
* Counts (``stream_window_counts``) keep the partial counts of each batch. A batch aggregates its own rows and writes them under its
  number; a repeated batch overwrites its own. Readers add the partials up, and the end of a run folds many into one.
* Moving windows over the counted days (``stream_moving_windows``) recompute the rows that a changed day reaches.

Offsets and targets sit in the cluster's shared folder (``spark.checkpoint.dir``) or where ``root`` says."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldlens.keyed import KeyedTable, delete, numbered
from fieldlens.session import scratch_path

#: Partial counts that a run leaves unfolded.
PARTIALS = 20


def stream_glob(path: str) -> str:
    """A file source watches a folder or a glob; a single file becomes a glob matching it
    (its parent folder is then the watched folder)."""
    if path.endswith(".parquet") and not any(ch in path for ch in "*?["):
        return path[:-1] + "[" + path[-1] + "]"
    return path


def file_stream(spark: SparkSession, path: str, schema=None, max_files: int | None = None) -> DataFrame:
    """Parquet file stream over ``path`` (a file, folder or glob); the schema comes from a
    batch read of the same path (streams need it up front)."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(stream_glob(path))


def _run(writer, checkpoint: str) -> list[int]:
    """Runs the query until its source is used up; numbers of input rows of its batches."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return [p["numInputRows"] for p in q.recentProgress]


def stream_upsert(spark: SparkSession, source_path: str, target: DataFrame, keys: Sequence[str],
                  transform: Callable[[DataFrame], DataFrame] = lambda d: d, order: Sequence = (),
                  event_time: str = "ts", newer_wins: bool = True, name: str = "stream-upsert",
                  root: str | None = None, max_files: int | None = None, buckets: int | None = None) -> DataFrame:
    """ST-1/SNK-2: merge every micro-batch of the source stream into the target table.

    A key may return on another day; the table's key index knows where it lies. ``newer_wins=False`` keeps the
    rows that are there (insert only). The initial ``target`` is written once per ``root``."""
    root = root or scratch_path(spark, name)
    table = KeyedTable(spark, root, target.schema, keys, event_time).create(target, buckets, order)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        delta = transform(batch)
        if not delta.isEmpty():
            table.merge(batch_id + 1, delta, order, newer_wins)

    _run(file_stream(spark, source_path, max_files=max_files).writeStream.foreachBatch(merge_batch),
         os.path.join(root, "_checkpoint"))
    table.grow()
    table.vacuum()
    return table.read()


def stream_dedup(spark: SparkSession, source_path: str, keys: Sequence[str], event_time: str = "ts",
                 name: str = "stream-dedup", root: str | None = None) -> DataFrame:
    """ST-3: one row per key. A batch adds the keys that the table does not hold yet, so
    duplicates within a batch, across batches and across runs of the same ``root`` go, and
    late rows stay."""
    empty = spark.read.parquet(source_path).limit(0)
    return stream_upsert(spark, source_path, empty, keys, event_time=event_time, newer_wins=False, name=name, root=root)


# -- counts ---------------------------------------------------------------------------------------

class Partials:
    """Mergeable partial sums under ``root``: a folder for each batch, and a folded one for all batches up to a number."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, by: Sequence[str], sums: Sequence[str]) -> None:
        self.spark, self.root, self.schema, self.by, self.sums = spark, root, schema, list(by), list(sums)

    def put(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/partial/{batch_id}")

    def _parts(self) -> tuple[list[str], list[int], int]:
        folded = numbered(self.spark, f"{self.root}/folded")
        last = folded[-1] if folded else -1
        open_ = [n for n in numbered(self.spark, f"{self.root}/partial") if n > last]
        return [f"{self.root}/folded/{last}"] * bool(folded) + [f"{self.root}/partial/{n}" for n in open_], open_, last

    def read(self) -> DataFrame:
        """Partials added up; a sum over no value stays null."""
        paths, _, _ = self._parts()
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return rows.groupBy(*self.by).agg(*[F.sum(c).alias(c) for c in self.sums]).select(*self.schema.names)

    def fold(self, at_most: int = PARTIALS) -> None:
        """Put more than ``at_most`` open partials into one. Only between runs: a batch that can still be repeated is not folded."""
        _, open_, last = self._parts()
        if len(open_) > at_most:
            self.read().write.mode("overwrite").parquet(f"{self.root}/folded/{open_[-1]}")
            for n in open_:
                delete(self.spark, f"{self.root}/partial/{n}")
            delete(self.spark, f"{self.root}/folded/{last}")


def daily_counts(rows: DataFrame, by: Sequence[str], event_time: str = "ts") -> DataFrame:
    day = F.col(event_time).cast("date")
    return (rows.where(day.isNotNull()).groupBy(day.cast("timestamp_ntz").alias("window_start"), *by)
            .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value_sum")))


def stream_window_counts(spark: SparkSession, source_path: str, by: Sequence[str] = (), event_time: str = "ts",
                         name: str = "stream-counts", root: str | None = None, max_files: int | None = None) -> DataFrame:
    """ST-9, ST-2: counts and sums per day. A batch reads its own rows only; late rows, repeated batches and
    restarts give the same result as one count over everything."""
    root = root or scratch_path(spark, name)
    schema = daily_counts(spark.read.parquet(source_path).limit(0), by, event_time).schema
    partials = Partials(spark, root, schema, ["window_start", *by], ["events", "value_sum"])
    _run(file_stream(spark, source_path, max_files=max_files).writeStream.foreachBatch(
        lambda batch, batch_id: partials.put(batch_id, daily_counts(batch, by, event_time))), os.path.join(root, "_checkpoint"))
    partials.fold()
    return partials.read().withColumn("window_end", F.expr("window_start + interval 1 day")).select(
        "window_start", "window_end", *by, "events", "value_sum")


# -- windows over the counted days ----------------------------------------------------------------

def moving_windows(daily: DataFrame, by: Sequence[str], order: str, measures: Sequence[str], rows: int) -> DataFrame:
    """``daily`` with the mean of each measure over the last ``rows`` rows of a group, as ``<measure>_ma``: exact sums, divided once."""
    last = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - rows, 0)
    return daily.withColumns({f"{m}_ma": F.sum(F.col(m).cast("decimal(28,6)")).over(last).cast("double") / F.count(m).over(last) for m in measures})


def reached(daily: DataFrame, changed: DataFrame, by: Sequence[str], order: str, rows: int) -> DataFrame:
    """``daily`` cut to what a change needs: column ``_reached`` marks the rows whose last ``rows`` rows hold a row of ``changed(by, order)``; the others are
    those that their windows read. A row that is new moves the windows after it like one that changed."""
    w = Window.partitionBy(*by).orderBy(order)
    named = changed.select(*by, order).distinct().withColumn("_changed", F.lit(1))
    same = functools.reduce(lambda a, b: a & b, [daily[c].eqNullSafe(named[c]) for c in [*by, order]])
    groups = named.select(*by).distinct()
    # days of the groups that changed, never of the others
    own = daily.join(groups, functools.reduce(lambda a, b: a & b, [daily[c].eqNullSafe(groups[c]) for c in by]), "left_semi") if by else daily
    marked = own.join(named, same, "left").select(*[own[c] for c in daily.columns], F.coalesce("_changed", F.lit(0)).alias("_changed"))
    hit = marked.withColumn("_reached", F.max("_changed").over(w.rowsBetween(1 - rows, 0)) == 1)
    read = hit.withColumn("_read", F.max(F.col("_reached").cast("int")).over(w.rowsBetween(0, rows - 1)) == 1)
    return read.where("_read").drop("_changed", "_read")


def stream_moving_windows(spark: SparkSession, source_path: str, by: Sequence[str] = (), event_time: str = "ts", rows: int = 7,
                          name: str = "stream-windows", root: str | None = None, max_files: int | None = None) -> DataFrame:
    """ST-10 over ST-9: moving means over the last ``rows`` counted days of a group, kept as a table. A batch adds its partial counts, then
    recomputes and replaces only the rows that its days reach."""
    root = root or scratch_path(spark, name)
    schema = daily_counts(spark.read.parquet(source_path).limit(0), by, event_time).schema
    measures = ["events", "value_sum"]
    partials = Partials(spark, f"{root}/counts", schema, ["window_start", *by], measures)
    kept = moving_windows(spark.createDataFrame([], schema), by, "window_start", measures, rows)
    table = KeyedTable(spark, f"{root}/windows", kept.schema, [*by, "window_start"]).create(kept, 1)

    def update(batch: DataFrame, batch_id: int) -> None:
        partials.put(batch_id, daily_counts(batch, by, event_time))
        changed = spark.read.schema(schema).parquet(f"{partials.root}/partial/{batch_id}")
        if changed.isEmpty():
            return
        need = reached(partials.read(), changed, by, "window_start", rows)
        fresh = moving_windows(need, by, "window_start", measures, rows).where("_reached").drop("_reached")
        table.merge(batch_id + 1, fresh)

    _run(file_stream(spark, source_path, max_files=max_files).writeStream.foreachBatch(update), os.path.join(root, "_checkpoint"))
    partials.fold()
    table.vacuum()
    return table.read()
