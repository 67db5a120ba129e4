"""Load jobs that can stop at any step and be run again (SRC-5, ST-6, ST-8).

``cursor_load`` reads what lies at or past a stored mark and merges it by key. Before it merges, it writes down how far the load will reach; after it, that the load is
done. A run that finds a plan that is not done carries it out again, up to the same bound, whatever has arrived since, so nothing between
two marks is passed over. ``chunk_load`` loads a range chunk by chunk and enters each finished chunk in a ledger; a later run takes up the chunks that
are not in it. Marks, plans and the ledger are small Parquet folders beside the target; a folder's ``_SUCCESS`` is its commit."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.keyed import KeyedTable, complete, delete, numbered
from fieldlens.sources.tables import incremental_scan


class CursorLoad:
    """Loads ``source`` rows by a growing column ``cursor`` into the keyed table at ``root``."""

    def __init__(self, spark: SparkSession, root: str, cursor: str, keys: Sequence[str], event_time: str | None = None) -> None:
        self.spark, self.root, self.cursor, self.keys, self.event_time = spark, root.rstrip("/"), cursor, list(keys), event_time

    def _bound(self, kind: str, number: int):
        return self.spark.read.parquet(f"{self.root}/{kind}/{number}").first()["bound"]

    def mark(self):
        """The cursor's value up to which everything is loaded; nothing before the first load."""
        done = numbered(self.spark, f"{self.root}/done")
        return self._bound("plan", done[-1]) if done else None

    def table(self, source: DataFrame) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/table", source.schema, self.keys, self.event_time)

    def run(self, source: DataFrame, order: Sequence = ()) -> int | None:
        """One load: the plan that a stopped run left, or a new one. -> its number, or nothing if there was nothing to load."""
        done = numbered(self.spark, f"{self.root}/done")
        number = (done[-1] if done else 0) + 1
        mark = self.mark()
        if not complete(self.spark, f"{self.root}/plan/{number}"):
            reach = incremental_scan(source, self.cursor, mark).agg(F.max(self.cursor).alias("bound"))
            reach.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/plan/{number}")
        bound = self._bound("plan", number)
        if bound is None or bound == mark and self._known(source, mark):
            # nothing new: the plan goes, so that the next run looks again
            delete(self.spark, f"{self.root}/plan/{number}")
            return None
        table = self.table(source).create(source.limit(0), 1)
        rows = incremental_scan(source, self.cursor, mark).where(F.col(self.cursor) <= F.lit(bound))
        table.merge(number, rows, order)
        table.grow()
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/{number}")
        return number

    def _known(self, source: DataFrame, mark) -> bool:
        """Whether the rows at the mark are all in the table: rows may arrive late with the mark's own value."""
        held = self.table(source).read()
        same = [held[k].eqNullSafe(source[k]) for k in self.keys]
        at = source.where(F.col(self.cursor) == F.lit(mark))
        return at.join(held, functools.reduce(operator.and_, same), "left_anti").isEmpty()

    def read(self, source: DataFrame) -> DataFrame:
        return self.table(source).read()


class ChunkLoad:
    """Loads a range of days chunk by chunk under ``root``: a folder of data for each chunk, and a ledger of those that are done."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, kind: str, start: dt.date) -> str:
        return f"{self.root}/{kind}/chunk_start={start.isoformat()}"

    def done(self, start: dt.date) -> bool:
        return complete(self.spark, self._at("ledger", start))

    def run(self, chunks: Iterable[tuple[dt.date, dt.date]], read: Callable[[dt.date, dt.date], DataFrame], again: bool = False) -> list[dt.date]:
        """Load the chunks that are not in the ledger (``again``: all of them), each replacing what an earlier try left. -> the chunks loaded now."""
        loaded = []
        for start, end in chunks:  # a list of calendar days
            if again or not self.done(start):
                read(start, end).write.mode("overwrite").parquet(self._at("data", start))
                entry = self.spark.createDataFrame([(start, end)], "first date, until date")
                entry.coalesce(1).write.mode("overwrite").parquet(self._at("ledger", start))
                loaded.append(start)
        return loaded

    def ledger(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/ledger").select("first", "until")

    def read(self) -> DataFrame:
        """Rows of the chunks in the ledger, with ``chunk_start``."""
        data = self.spark.read.option("basePath", f"{self.root}/data").parquet(f"{self.root}/data")
        return data.join(F.broadcast(self.ledger().select(F.col("first").alias("chunk_start"))), "chunk_start", "left_semi").select(*[c for c in data.columns if c != "chunk_start"], "chunk_start")
