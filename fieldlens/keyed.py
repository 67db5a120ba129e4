"""Tables that are merged by key without being read (SNK-2, SNK-3, ST-1, ST-3).

Rows lie in cells: a bucket of the key's hash, and a day. Beside them lies a key index, for each bucket the keys it holds and their day. A merge looks
up its keys in the index of the buckets they fall in, rewrites only the cells that hold one of them (a key may have moved to another day), and adds
the other rows as files of their own. What it reads follows the batch, not the table: buckets are sized by rows, and there are more of them in a
larger table (``grow`` doubles them).

Every merge has a version. It writes its cells and index under that number, then a manifest, the list of the cells and indexes that make up the
table; the manifest's ``_SUCCESS`` is the commit. A merge that stopped is repeated under its number and overwrites what it left; one that is committed is
skipped. Readers see the cells of the newest manifest. ``vacuum`` deletes what no manifest names any more.

All of it is plain Parquet written and read by Spark. On the driver are only names of cells that a batch touches, no rows."""

from __future__ import annotations

import functools
import operator
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DateType, IntegerType, LongType, StructField, StructType

from fieldlens.operators.keys import distinct_on

BUCKET, DAY, VERSION = "_bucket", "event_day", "_version"
#: Rows of a bucket, about.
BUCKET_ROWS = 1_000_000
#: Rows of a cell that one task writes, about.
ROWS_A_TASK = 500_000
#: Files that a cell may consist of before a merge that touches it puts them together.
PARTS = 8
#: The day of rows without a time.
NO_DAY = "0001-01-01"
#: More cells than this are read as a folder joined with the manifest, fewer by their paths.
LISTED = 5000
_MANIFEST = StructType([StructField("kind", IntegerType()), StructField(BUCKET, IntegerType()), StructField(DAY, DateType()), StructField(VERSION, LongType())])
#: Kinds of manifest rows; that of the layout has the number of buckets in its bucket column.
DATA, INDEX, LAYOUT = 0, 1, 2


def fs_of(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed; storage errors are raised, not read as no."""
    at, fs = fs_of(spark, os.path.join(path, "_SUCCESS"))
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = fs_of(spark, path)
    if fs.exists(at):
        fs.delete(at, True)


def numbered(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    """Numbers of the committed folders ``path/<prefix><number>``, in order."""
    at, fs = fs_of(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    numbers = [int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit()]
    return sorted(n for n in numbers if complete(spark, f"{path}/{prefix}{n}"))


class KeyedTable:
    """The table at ``root``: rows of ``schema``, one for each value of ``keys``; ``event_time`` names the column that gives a row its day, if any."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], event_time: str | None = None) -> None:
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        none = F.to_date(F.lit(NO_DAY))
        self.day: Column = F.coalesce(F.col(event_time).cast("date"), none) if event_time else none
        self._where = [StructField(VERSION, LongType()), StructField(BUCKET, IntegerType()), StructField(DAY, DateType())]

    # -- what is there

    def versions(self) -> list[int]:
        return numbered(self.spark, f"{self.root}/_manifest")

    def manifest(self, version: int) -> DataFrame:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_manifest/{version}")

    def read(self) -> DataFrame:
        """The rows of the newest version."""
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self._cells(self.manifest(versions[-1]).where(F.col("kind") == DATA)).select(*self.schema.names)

    def _cells(self, named: DataFrame) -> DataFrame:
        """Rows of the cells that manifest rows name, with bucket and day."""
        schema = StructType([*self.schema.fields, *self._where])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        at = named.select(VERSION, BUCKET, DAY).limit(LISTED + 1).collect()
        if not at:
            return self.spark.createDataFrame([], schema)
        if len(at) <= LISTED:
            return reader.parquet(*[f"{self.root}/data/{VERSION}={v}/{BUCKET}={b}/{DAY}={d.isoformat()}" for v, b, d in at])
        return reader.parquet(f"{self.root}/data").join(named.select(VERSION, BUCKET, DAY), [VERSION, BUCKET, DAY], "left_semi")

    def _index(self, manifest: DataFrame, buckets: DataFrame) -> DataFrame:
        """Keys, bucket and day of the rows in ``buckets``."""
        fields = [self.schema[k] for k in self.keys]
        schema = StructType([*fields, self._where[2], self._where[0], self._where[1]])
        named = manifest.where(F.col("kind") == INDEX).join(buckets, BUCKET, "left_semi").select(VERSION, BUCKET)
        paths = [f"{self.root}/index/{VERSION}={v}/{BUCKET}={b}" for v, b in named.collect()]  # at most the buckets of the batch
        if not paths:
            return self.spark.createDataFrame([], schema).drop(VERSION)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/index").parquet(*paths).drop(VERSION)

    def _same_key(self, left: DataFrame, right: DataFrame) -> Column:
        return functools.reduce(operator.and_, [left[k].eqNullSafe(right[k]) for k in self.keys])

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(buckets)).cast("int")

    # -- writing

    def create(self, rows: DataFrame, buckets: int | None = None, order: Sequence = ()) -> KeyedTable:
        """Version 0: ``rows``, of each key the first by ``order``. A table that is there stays as it is."""
        if not self.versions():
            n = buckets or max(1, -(-rows.count() // BUCKET_ROWS))
            self._replace(0, distinct_on(rows, self.keys, order or self.keys), n)
        return self

    def _replace(self, version: int, rows: DataFrame, buckets: int) -> None:
        placed = rows.select(*self.schema.names).withColumns({BUCKET: self.bucket(buckets), DAY: self.day})
        data = self._write(placed, version)
        index = self._write_index(data.select(*self.keys, BUCKET, DAY), version)
        self._commit(version, self._rows(data, DATA, version).unionByName(self._rows(index, INDEX, version)), buckets)

    def _write(self, placed: DataFrame, version: int) -> DataFrame:
        """Cells of a version; a cell of many rows is dealt to several tasks."""
        tasks = placed.groupBy(F.col(BUCKET).alias("_b"), F.col(DAY).alias("_d")).agg(F.ceil(F.count(F.lit(1)) / F.lit(ROWS_A_TASK)).alias("_tasks")).where("_tasks > 1")
        own = F.xxhash64(*[f.name for f in self.schema.fields if isinstance(f.dataType, AtomicType)])
        dealt = placed.join(tasks, (F.col(BUCKET) == F.col("_b")) & (F.col(DAY) == F.col("_d")), "left").withColumn("_task", F.pmod(own, F.coalesce("_tasks", F.lit(1))))
        path = f"{self.root}/data/{VERSION}={version}"
        (dealt.repartition(BUCKET, DAY, "_task").select(*self.schema.names, BUCKET, DAY).write.mode("overwrite").partitionBy(BUCKET, DAY).parquet(path))
        return self.spark.read.schema(StructType([*self.schema.fields, *self._where[1:]])).parquet(path)

    def _write_index(self, keyed: DataFrame, version: int) -> DataFrame:
        path = f"{self.root}/index/{VERSION}={version}"
        keyed.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        return self.spark.read.schema(StructType([*[self.schema[k] for k in self.keys], self._where[2], self._where[1]])).parquet(path)

    def _rows(self, written: DataFrame, kind: int, version: int) -> DataFrame:
        day = F.col(DAY) if kind == DATA else F.lit(None).cast("date")
        return written.select(F.lit(kind).alias("kind"), F.col(BUCKET), day.alias(DAY)).distinct().withColumn(VERSION, F.lit(version).cast("long"))

    def _commit(self, version: int, rows: DataFrame, buckets: int) -> None:
        layout = self.spark.createDataFrame([(LAYOUT, buckets, None, version)], _MANIFEST)
        rows.select(*_MANIFEST.names).unionByName(layout).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_manifest/{version}")

    def merge(self, step: int, delta: DataFrame, order: Sequence = (), newer_wins: bool = True) -> bool:
        """Merge ``delta`` as ``step``, from 1: its rows (the first of a key by ``order``) replace those of the same key, or, with ``newer_wins=False``, only new
        keys are added. Nothing happens if the step is committed. -> whether it was merged now."""
        version, versions = 2 * step, self.versions()
        if version in versions:
            return False
        before = self.manifest(max(v for v in versions if v < version))
        buckets = before.where(F.col("kind") == LAYOUT).first()[BUCKET]
        staged = f"{self.root}/_staged/{version}"
        winners = distinct_on(delta, self.keys, order or self.keys).select(*self.schema.names)
        winners.withColumns({BUCKET: self.bucket(buckets), DAY: self.day}).write.mode("overwrite").parquet(staged)
        new = self.spark.read.schema(StructType([*self.schema.fields, *self._where[1:]])).parquet(staged)
        touched = new.select(BUCKET).distinct()
        index = self._index(before, touched)
        found = index.join(new.select(*self.keys), self._same_key(index, new), "left_semi")
        if newer_wins:
            stale = found.select(BUCKET, DAY).distinct()
        else:
            new = new.join(found.select(*self.keys), self._same_key(new, found), "left_anti")
            stale = found.limit(0).select(BUCKET, DAY)
        worn = (before.where(F.col("kind") == DATA).join(new.select(BUCKET, DAY).distinct(), [BUCKET, DAY], "left_semi")
                .groupBy(BUCKET, DAY).agg(F.count(F.lit(1)).alias("parts")).where(F.col("parts") >= PARTS).select(BUCKET, DAY))
        cells = self.spark.createDataFrame(stale.union(worn).distinct().collect(), StructType(self._where[1:]))  # cells of the batch's keys
        old = self._cells(before.where(F.col("kind") == DATA).join(cells, [BUCKET, DAY], "left_semi")).drop(VERSION)
        kept = old.join(new.select(*self.keys), self._same_key(old, new), "left_anti")
        data = self._write(kept.unionByName(new), version)
        stay = index.join(cells, [BUCKET, DAY], "left_anti").select(*self.keys, BUCKET, DAY)
        keyed = self._write_index(stay.unionByName(data.select(*self.keys, BUCKET, DAY)), version)
        same = (before.where(F.col("kind") == DATA).join(cells, [BUCKET, DAY], "left_anti")
                .unionByName(before.where(F.col("kind") == INDEX).join(touched, BUCKET, "left_anti")).select(*_MANIFEST.names))
        self._commit(version, same.unionByName(self._rows(data, DATA, version)).unionByName(self._rows(keyed, INDEX, version)), buckets)
        delete(self.spark, staged)
        return True

    def grow(self, bucket_rows: int = BUCKET_ROWS) -> bool:
        """Double the buckets of a table whose buckets have twice the rows they should; a table that grows n-fold is so rewritten about as often as log n."""
        last = self.versions()[-1]
        manifest = self.manifest(last)
        buckets = manifest.where(F.col("kind") == LAYOUT).first()[BUCKET]
        rows = self._index(manifest, manifest.where(F.col("kind") == INDEX).select(BUCKET).distinct()).count()
        if rows <= 2 * bucket_rows * buckets:
            return False
        while rows > bucket_rows * buckets:
            buckets *= 2
        self._replace(last + 1, self.read(), buckets)  # steps have even versions, so this one is free
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Delete what only older versions than the last ``keep`` name."""
        versions = self.versions()
        old, live = versions[:-keep], versions[-keep:]
        if not old:
            return
        named = functools.reduce(DataFrame.unionByName, [self.manifest(v) for v in live]).where(F.col("kind") != LAYOUT).drop_duplicates()
        past = functools.reduce(DataFrame.unionByName, [self.manifest(v) for v in old]).where(F.col("kind") != LAYOUT).drop_duplicates()
        same = functools.reduce(operator.and_, [past[c].eqNullSafe(named[c]) for c in _MANIFEST.names])
        for kind, bucket, day, version in past.join(named, same, "left_anti").select(*_MANIFEST.names).toLocalIterator():  # names of cells
            cell = f"data/{VERSION}={version}/{BUCKET}={bucket}/{DAY}={day}" if kind == DATA else f"index/{VERSION}={version}/{BUCKET}={bucket}"
            delete(self.spark, f"{self.root}/{cell}")
        for v in old:
            delete(self.spark, f"{self.root}/_manifest/{v}")
