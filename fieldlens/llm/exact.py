"""Exact dedup by two passes over a Bloom filter of repeated hashes; DataFrame functions only.

A text's hash is the SHA-256 of its text with runs of ``[\\x20\\x09-\\x0D]`` made one space. Pass one counts the slots that a first hash of it
takes in a field of bits: a slot taken twice may be a repeated text, any other slot holds a text that is alone. Pass two does the same
with a second, independent hash for the rows that pass one leaves. What moves for a filter is a slot number and a count for each distinct
slot of a task, never a row; the slots taken twice are packed into bitmaps of 32768 bits and broadcast.
Rows whose two slots are both taken twice are possibly repeated: only they are shuffled, by the whole SHA-256, which settles
whether they are. All other rows pass straight through.

The filter's size follows the number of rows (four bits a row, the two passes together let through about one lone text in a hundred) and is bounded by
``max_bits``; more rows than that holds are worked off in rounds, each over its own share of the hashes.
Groups over 1/1024 of all rows, of which there are at most 1024, are joined to their rows by broadcast, so a hot group lies in no one task.

Defined cases: a null text counts as empty; a text of white space alone equals one space, not the empty text; a null doc_id takes
part and comes after all others; of rows that repeat (doc_id and text) exactly one is kept; an empty table gives no rows; other columns
may have any name, also those of the result.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from fieldlens.llm.shared import join_sized, written

#: Bits of the filter for a row.
BITS_A_ROW = 4
#: Largest filter of a round: 2^28 bits are 32 MB of bitmaps.
MAX_BITS = 1 << 28
#: Bits of one bitmap of Spark's bitmap functions.
_BITMAP = 1 << 15


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_hash(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _slot(sha: Column, turn: int, bits: int) -> Column:
    """The slot, from 1, that hash number ``turn`` of a text takes."""
    return F.pmod(F.xxhash64(sha, F.lit(turn)), F.lit(bits)) + 1


def _taken_twice(rows: DataFrame, turn: int, bits: int) -> DataFrame:
    """``rows(sha)`` -> ``(bucket, bitmap)`` of the slots that more than one row takes."""
    twice = rows.groupBy(_slot(F.col("sha"), turn, bits).alias("slot")).agg(F.count("*").alias("n")).where("n > 1")
    packed = twice.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
    return written(packed, "exact-filter")


def _probe(rows: DataFrame, filters: DataFrame, turn: int, bits: int) -> DataFrame:
    """``rows`` with the column ``twice``: whether the filter holds the row's slot."""
    slot = _slot(F.col("sha"), turn, bits)
    found = rows.join(F.broadcast(filters), F.bitmap_bucket_number(slot) == F.col("bucket"), "left")
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1")
    return found.withColumn("_at", at).withColumn("_byte", byte).withColumn("twice", F.coalesce(bit == 1, F.lit(False))).select(*rows.columns, "twice")


def filter_size(rows: int, max_bits: int = MAX_BITS) -> tuple[int, int]:
    """Bits of a round's filter and the number of rounds for so many rows."""
    rounds = max(1, math.ceil(rows * BITS_A_ROW / max_bits))
    bits = _BITMAP
    while bits < max_bits and bits * rounds < rows * BITS_A_ROW:
        bits *= 2
    return bits, rounds


def split_repeats(rows: DataFrame, count: int, max_bits: int = MAX_BITS) -> list[tuple[DataFrame, DataFrame]]:
    """``rows(sha, ...)`` of a written table -> for each round its rows that are possibly repeated, and those that are surely alone."""
    bits, rounds = filter_size(count, max_bits)
    out = []
    for r in range(rounds):
        part = rows.where(F.pmod(F.xxhash64("sha", F.lit("round")), F.lit(rounds)) == r) if rounds > 1 else rows
        first = _probe(part, _taken_twice(part.select("sha"), 1, bits), 1, bits)
        left = first.where("twice").drop("twice")
        second = _probe(left, _taken_twice(left.select("sha"), 2, bits), 2, bits)
        alone = first.where("not twice").drop("twice").unionByName(second.where("not twice").drop("twice"))
        out.append((second.where("twice").drop("twice"), alone))
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, sha)`` for every row of ``docs``: the group of equal texts it is in, and whether it is the one that stays."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), text_hash(F.col(text)).alias("sha")), "exact-rows")
    count = rows.count()
    split = split_repeats(rows, count, max_bits)
    maybe = written(_union([m for m, _ in split]), "exact-maybe")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    sized = written(maybe.groupBy("sha").agg(F.count("*").alias("group_size"), F.min(order).alias("first")), "exact-groups")
    settled = (join_sized(maybe, sized, "sha", "group_size", count)
               .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "sha"))
    alone = _union([a for _, a in split]).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return alone.unionByName(settled)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of equal texts: that of the smallest doc_id, then of the smallest hash of its columns.
    Rows that are alone pass straight through; of a possibly repeated text each task sends one row."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), text_hash(F.col(text)).alias("sha"))
    count = docs.count()
    split = split_repeats(whole, count, max_bits)
    plain = [f"`{f.name}`" for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    order = F.struct(F.col(f"whole.`{doc_id}`").isNull(), F.col(f"whole.`{doc_id}`"), F.xxhash64(*[F.col(f"whole.{c}") for c in plain]))
    chosen = _union([m for m, _ in split]).groupBy("sha").agg(F.min_by("whole", order).alias("whole")).select("whole")
    alone = _union([a for _, a in split]).select("whole")
    return alone.unionByName(chosen).select("whole.*")
