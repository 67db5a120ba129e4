"""Source operators (SRC-*): scans with pruning and pushed-down windows, multi-source
union, inline relations and seeds. Every scan is a plain DataFrame read, so Catalyst
pushes the filters and the column list into the Parquet (or JDBC) reader."""

from __future__ import annotations

import datetime as dt
import functools
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldlens.functions.scalars import ntz_lit, null_zero_date

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")


def load_table(spark: SparkSession, root: str, name: str, columns: Sequence[str] | None = None,
               source: str | None = None, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Scan one table (SRC-1); ``columns`` prunes the read schema (SRC-2); ``source``
    tags rows with ``source_database`` (SRC-6). ``fmt``/``options`` switch the reader,
    e.g. ``fmt="jdbc"`` with ``dbtable``, ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` for a parallel read of an operational database
    (the column list and predicates are then pushed into the database query)."""
    if fmt == "parquet" and not options:
        df = spark.read.parquet(table_path(root, name))
    else:
        reader = spark.read.format(fmt)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        df = reader.load() if fmt == "jdbc" else reader.load(table_path(root, name).replace(".parquet", f".{fmt}"))
    if columns:
        df = df.select(*columns)
    if source is not None:
        df = df.withColumn("source_database", F.lit(source))
    return df


def parts_of(spark: SparkSession, root: str, name: str, mb: int = 4) -> int:
    """Number of partitions to deal a table's rows to: one for every ``mb`` MB of its files, the session's number at least. Rows of a few numbers
    shrink so much in a shuffle that partitions merged by their size would hold millions of them, and sorts of those spill."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (mb << 20)))


# Which column drives a window, per policy (SRC-4): "modified" reads by change time,
# "business" by the business date.
DEFAULT_POLICY_COLUMNS = {"modified": "modified", "business": "service_date"}


def _bound(v):
    # wall-clock datetimes become TIMESTAMP_NTZ literals (zone independent); dates stay dates
    return ntz_lit(v) if isinstance(v, dt.datetime) else F.lit(v)


def window_scan(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Half-open window ``start <= c < end`` (SRC-3); pushed to the Parquet scan."""
    c = F.col(date_col)
    return df.where((c >= _bound(start)) & (c < _bound(end)))


def window_scan_policy(df: DataFrame, policy: str, start, end,
                       columns: Mapping[str, str] = DEFAULT_POLICY_COLUMNS) -> DataFrame:
    return window_scan(df, columns[policy], start, end)


def incremental_scan(df: DataFrame, cursor: str, high_water_mark, initial=None) -> DataFrame:
    """Rows at or past the cursor's high-water mark (SRC-5). When no mark is stored yet,
    ``initial`` is used; the next mark is ``max(cursor)`` of the result (see
    :func:`next_high_water_mark`)."""
    hwm = high_water_mark if high_water_mark is not None else initial
    if hwm is None:
        return df
    return df.where(F.col(cursor) >= (hwm if isinstance(hwm, Column) else _bound(hwm)))


def next_high_water_mark(df: DataFrame, cursor: str) -> DataFrame:
    """One-row frame holding the new mark; stored next to the target, not on the driver."""
    return df.agg(F.max(cursor).alias("high_water_mark"))


def union_sources(frames: Mapping[str, DataFrame], tag: str = "source_database") -> DataFrame:
    """Same logical table from several databases, tagged and unioned by name (SRC-6, SET-1).
    Columns missing in one source come out as typed NULLs (PRJ-7)."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def values_relation(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Inline ``VALUES`` relation (SRC-8), built JVM-side (an inline generator over a
    one-row range, no Python RDD), typed by ``schema``. Its size is fixed by the code, so
    it is marked for broadcast."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = [f.name for f in st.fields]
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    df = spark.range(1).select(F.inline(F.array(*structs))).select(*names)
    return F.broadcast(df)


def load_seed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Typed CSV seed with header (SRC-7); declared types, no inference."""
    return spark.read.schema(schema).option("header", True).csv(path)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Row map on ingest: add a literal column (SRC-10, UD-4)."""
    return df.withColumn(name, F.lit(value))


def null_zero_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row map on ingest: zero-date sentinel strings become NULL timestamps (SRC-9)."""
    return df.withColumns({c: null_zero_date(c) for c in cols})


def with_predicate(df: DataFrame, predicate: Column | None) -> DataFrame:
    """Query-adapter callback: inject a predicate into a scan (UD-5)."""
    return df if predicate is None else df.where(predicate)
