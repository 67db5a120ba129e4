"""Table models (SNK-6): shared intermediate results written once per build and read by
the queries downstream, the way the reference materializes its timesheet, run-crew and
mart models as tables.

A model is written as Parquet under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), then read back. This cuts the lineage (an executor lost later
recomputes from the written files, not from the raw tables) and lets every query that
shares the model reuse it. Models are keyed by application, input root, version of the
input files and name: two inputs never mix, and a table that changes is built anew.
:func:`drop_models` forgets all models and deletes their files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.keyed import complete, delete, numbered
from fieldlens.session import scratch_path

_MODELS: dict[tuple[str, str, str, str], str] = {}


def input_version(spark: SparkSession, root: str) -> str:
    """Size, file count and modification time of every table under ``root``, as one text.
    One call per table: a table folder's own time changes when files come or go."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = []
    for st in fs.listStatus(path):
        sm = fs.getContentSummary(st.getPath())
        parts.append(f"{st.getPath().getName()}:{sm.getLength()}:{sm.getFileCount()}:{st.getModificationTime()}")
    return "|".join(sorted(parts))


def table_model(spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (_app_id(spark), root, input_version(spark, root), name)
    path = _MODELS.get(key)
    if path is None:
        path = scratch_path(spark, f"model-{name}")
        build().write.mode("overwrite").parquet(path)
        _MODELS[key] = path
    return spark.read.parquet(path)


def _app_id(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def drop_models(spark: SparkSession | None = None) -> None:
    """Forget all models; with a session, delete their files too."""
    if spark is not None:
        jvm = spark.sparkContext._jvm
        for (app, *_), path in _MODELS.items():
            if app == _app_id(spark):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _MODELS.clear()


class DayModel:
    """A table model partitioned by day that follows its source files (SNK-6): only days that a new, changed or removed file holds are built again.

    Beside the table lies a map from source file (with its size and time of change) to the days it holds. ``refresh`` compares it with the files that are there
    now, reads the day column of the files that differ, and rebuilds the days they hold or held from all files, pruned to those days. The new map
    is written last: a refresh that stopped finds the old one and builds the same days again."""

    def __init__(self, spark: SparkSession, root: str, source: str, day: str, build: Callable[[DataFrame], DataFrame], out_day: str) -> None:
        """``build`` makes the model's rows of a day from the source's rows of that day; ``day`` is an expression over the source, ``out_day`` the model's date column."""
        self.spark, self.root, self.source, self.day, self.build, self.out_day = spark, root.rstrip("/"), source, day, build, out_day

    _MAP = "file string, size long, changed timestamp, day date"

    def _maps(self) -> list[int]:
        return numbered(self.spark, f"{self.root}/map")

    def _files(self) -> DataFrame:
        return self.spark.read.parquet(self.source).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                                                           F.col("_metadata.file_modification_time").alias("changed")).distinct()

    def refresh(self) -> list:
        """Bring the table up to its source; -> the days that were built."""
        maps = self._maps()
        old = self.spark.read.schema(self._MAP).parquet(f"{self.root}/map/{maps[-1]}") if maps else self.spark.createDataFrame([], self._MAP)
        now = self._files()
        same = ["file", "size", "changed"]
        names = [r.file for r in now.join(old, same, "left_anti").select("file").collect()]  # names of files that differ
        fresh = self.spark.createDataFrame([], self._MAP)
        if names:
            rows = self.spark.read.parquet(*names)
            fresh = rows.select(*[F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("file_size", "size"), ("file_modification_time", "changed"))],
                                F.expr(self.day).alias("day")).distinct()
        kept, gone = old.join(now, same, "left_semi"), old.join(now, same, "left_anti")
        number = (maps[-1] if maps else 0) + 1
        fresh_map = f"{self.root}/map/{number}"
        days = sorted({r.day for r in fresh.select("day").union(gone.select("day")).where("day is not null").distinct().collect()})  # calendar days
        if not days and not names and gone.isEmpty() and maps:
            return []
        table = f"{self.root}/table"
        if days:
            held = self.spark.read.parquet(self.source).where(F.expr(self.day).isin(days))
            built = self.build(held)
            built.repartition(self.out_day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.out_day).parquet(table)
            left = {r.day for r in held.select(F.expr(self.day).alias("day")).distinct().collect()}
            for d in days:
                if d not in left:
                    delete(self.spark, f"{table}/{self.out_day}={d.isoformat()}")
        kept.select("file", "size", "changed", "day").unionByName(fresh).coalesce(1).write.mode("overwrite").parquet(fresh_map)
        if complete(self.spark, fresh_map):
            for n in maps:
                delete(self.spark, f"{self.root}/map/{n}")
        return days

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/table")
