"""SimHash near duplicates with pigeonring candidate filtering.

A fingerprint has 64 bits, cut into ``segments`` consecutive segments that form a ring. If two fingerprints
differ in at most ``t`` bits, some chain of consecutive segments keeps every cumulative difference of its
first ``l`` segments within ``floor(l * t / segments)``. Pairs that share ``segments - t`` equal segments are
the only ones that can hold such a chain, so these are the candidates; the chain test prunes them before the
full Hamming test. Groups of candidates over ``pair_limit`` are not paired: they are linked through the points
one bit away from both, which finds exactly the same links with a number of rows in proportion to the group.

Defined cases: null or empty text has fingerprint zero and links like any other; a null doc_id takes part, and a
component without any doc_id has a null component_id; rows that repeat give a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.graph import components
from fieldlens.llm.shared import batches_of, first_rows, text_key, words_of, written

BITS = 64
_BLOCK = 1 << 16  # shingles whose bits are unpacked at a time
_POWERS = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned fingerprint: a bit is set if it is set in over half of the shingles' XXH64 values (seed 42)."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle_words + 1)
    last = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], last[:-1] + 1))[:n].tolist()
    end = (last[shingle_words - 1:] if len(words) >= shingle_words else last[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(start, end, strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _BLOCK):
        part = hashes[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_POWERS[ones * 2 > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row; fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 2000):
            fp = np.fromiter((fingerprint(t, shingle_words) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment."""
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def in_ring(x: Column, max_bits: int, segments: int) -> Column:
    """True where some chain of segments, each of its beginnings within the proportional budget, is one segment short of the whole ring. Within the distance there always is
    one; beyond it there may be, so the distance is checked after."""
    d = [F.bit_count(F.shiftrightunsigned(x, a).bitwiseAND(F.lit((1 << n) - 1))) for a, n in _segments(segments)]
    found = F.lit(False)
    for i in range(segments):
        chain, total = F.lit(True), F.lit(0)
        for length in range(1, segments):
            total = total + d[(i + length - 1) % segments]
            chain = chain & (total <= length * max_bits // segments)
        found = found | chain
    return found


def links(fps: DataFrame, max_bits: int = 2, segments: int = 4, pair_limit: int = 32) -> DataFrame:
    """``fps(fp)``, distinct -> ``(a, b)``: links that connect exactly the fingerprints that chains of links of at most
    ``max_bits`` differing bits connect. ``pair_limit`` picks how a group is linked, not what is linked."""
    if not 0 < max_bits < segments:
        raise ValueError("segments must be over max_bits, and max_bits over 0")
    cut = _segments(segments)
    masks = [sum(((1 << n) - 1) << a for a, n in pick) for pick in combinations(cut, segments - max_bits)]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    grouped = written(keyed.join(sizes, ["mask", "key"]), "simhash-groups")
    small = grouped.where(F.col("n") <= pair_limit)
    a, b = small.alias("a"), small.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    pairs = (a.join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
             .where(in_ring(x, max_bits, segments)).where(F.bit_count(x) <= max_bits)
             .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    return pairs.union(_large_groups(grouped.where(F.col("n") > pair_limit), masks, max_bits)).distinct()


def _large_groups(groups: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Links within large groups: two fingerprints differ in at most two bits exactly if some value is at most one
    bit from both. Every fingerprint lists these values among the bits that its group leaves free; those that meet at a value
    are few (one for each free bit) and are linked to the smallest. ``max_bits`` of 1 needs only the value itself and a direct test;
    for more than 2 the values are those within half the distance."""
    half = (max_bits + 1) // 2
    flips = []
    for m in masks:
        free = [1 << i for i in range(BITS) if not m >> i & 1]
        flips.append([_signed(sum(c)) for k in range(half + 1) for c in combinations(free, k)])
    table = F.array(*[F.array(*[F.lit(v) for v in row]) for row in flips])
    near = groups.select("fp", "mask", F.explode(table[F.col("mask")]).alias("flip"))
    met = (near.select("mask", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"), "fp").groupBy("mask", "at")
           .agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1).select(F.explode(F.col("all")).alias("a"), F.array_min("all").alias("low"), "all"))
    if max_bits == 2 * half:
        return met.where("a <> low").select("a", F.col("low").alias("b"))
    pair = met.select("a", F.explode("all").alias("b")).where("a < b")
    return pair.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3, max_bits: int = 2,
                    segments: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp, component_id)`` for every row of ``docs``; component_id is the smallest doc_id reachable."""
    rows = written(fingerprints(docs, doc_id, text, shingle_words), "simhash")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-fps")
    roots = components(links(fps.select("fp"), max_bits, segments))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = written(rooted.join(lows, "root").select(F.col("fp").alias("at"), "component_id"), "simhash-components")
    return rows.join(by_fp, rows["fp"] == by_fp["at"]).select("doc_id", "text_key", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest doc_id (then the smallest
    text key) stays, with all its columns; of rows that repeat, one."""
    found = written(near_duplicates(docs, doc_id, text, **how).drop("fp"), "simhash-found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key"))).alias("first")
    per_row = found.groupBy("component_id", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    best = per_row.groupBy("component_id").agg(first)
    chosen = (per_row.join(best, per_row["component_id"].eqNullSafe(best["component_id"]))
              .where(per_row["doc_id"].eqNullSafe(F.col("first.doc_id")) & (per_row["text_key"] == F.col("first.text_key")))
              .select(per_row["doc_id"].alias("kept_id"), per_row["text_key"].alias("kept_key"), "copies"))
    chosen = written(chosen, "simhash-kept")

    def stay(only: DataFrame) -> DataFrame:
        return docs.join(only, docs[doc_id].eqNullSafe(only["kept_id"]) & (text_key(docs[text]) == only["kept_key"]), "left_semi")

    once = stay(chosen.where("copies = 1"))
    return once.unionByName(first_rows(stay(chosen.where("copies > 1")), doc_id, text))
