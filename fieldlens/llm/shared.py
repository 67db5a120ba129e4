"""Helpers of the training-data operators: the shared folder, written intermediate tables, words, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

#: ASCII upper case to lower case, as bytes; other letters stay.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session on one machine may leave it unset: one is made for it then."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage is cut, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Deletes what this application has written; call it once results that read it are stored."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` in the UTF-8 text, A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def text_key(text: str | Column = "text") -> Column:
    """64-bit key of a text; null has its own. With the document id it tells rows apart when ids repeat."""
    at = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(at, at.isNull(), F.length(at))


def batches_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def first_rows(df: DataFrame, doc_id: str, text: str, also: Sequence[str] = ()) -> DataFrame:
    """Of rows that share id and text, and the columns ``also``, the first by their other columns, so that a rerun keeps the same one. Each task sends one row of a group."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    order = F.struct(*[part for c in plain for part in (c.isNull(), c)])
    keyed = df.select(F.struct(F.col(f"`{doc_id}`"), text_key(F.col(f"`{text}`")), *[F.col(f"`{c}`") for c in also]).alias("key"), order.alias("order"), whole.alias("whole"))
    return keyed.groupBy("key").agg(F.min_by("whole", "order").alias("whole")).select("whole.*")


#: A group is hot if it has more than one of so many rows; so there are at most so many hot groups.
HOT_SHARE = 1024


def join_sized(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined with their row of ``groups`` by ``key``. Groups whose ``size`` is over ``total`` / 1024, at most 1024 of them, are broadcast,
    so that no task gets a hot group; the rest are joined by shuffling."""
    hot = groups.where(F.col(size) * HOT_SHARE > total)
    cold = groups.where(F.col(size) * HOT_SHARE <= total)
    settled = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return settled.unionByName(others)
