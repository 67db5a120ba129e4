"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Test items are partitioned by their number of shingles (bounds a factor of about 1.4 apart). A document is read once for
each partition in overlapping windows of three blocks, each half the partition's upper bound long, so any run of an
item's length lies whole in some window. Within a partition the containment threshold gives a least Jaccard similarity of
item and window, and the number of one-row bands is set so that a true match is missed with probability ``miss`` at most.

Items of at most ``FEW`` shingles, and items that repeat so few distinct ones that more bands would be needed than there are, are
found exactly instead: all their shingles are looked up in every document.

Windows are pruned where they are read by a bit table of the items' band keys: its size is fixed, and it has no false
negatives. What passes is joined to the items in Spark, and the share of an item's distinct shingles found in the whole
document, compared as strings, decides.

Defined cases: an item or document of fewer than five words has its whole sequence as one shingle; empty or null text
has none and never matches; null ids take part and stay null; rows that repeat are reported once; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.shared import batches_of, text_key, written
from fieldlens.llm.shingles import Shingles, mixed, shingles

#: log2 of the bits of the table of band keys, and of that of shingles.
TABLE_BITS = 24
#: Items of so many shingles are found by the shingles themselves.
FEW = 8
_SEEDS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(_SEEDS) | np.uint64(1)


def _order(hashes: np.ndarray, band: int) -> np.ndarray:
    """The hashes under a band's order."""
    return (hashes ^ _SEEDS[band]) * _FACTORS[band]


def partition_of(n: int) -> int:
    """Partition of an item with ``n`` shingles."""
    return max(0, math.ceil(2 * math.log2(n) - 1e-9))


def block_of(part: int) -> int:
    """Shingles of a block: half the largest item of the partition, rounded up."""
    return max(1, math.ceil(2 ** (part / 2) / 2))


def bands_of(part: int, distinct: int, share: float, miss: float) -> int:
    """Bands so that an item of ``distinct`` shingles in the partition whose ``share`` is in a window is missed with probability
    ``miss`` at most; may be more than there are."""
    jaccard = share * distinct / (3 * block_of(part) + (1 - share) * distinct)
    return math.ceil(math.log(miss) / math.log(1 - min(0.999, jaccard)))


def _keys(low: np.ndarray, part: int, band: int) -> np.ndarray:
    return mixed(low ^ np.uint64(part << 9 | band))


def item_keys(s: Shingles, i: int, part: int, bands: int) -> np.ndarray:
    """Band keys of item ``i``: the least hash under each band's order."""
    own = s.hashes[s.first[i]:s.first[i] + s.count[i]]
    return np.array([_keys(_order(own, k).min(keepdims=True), part, k)[0] for k in range(bands)], np.uint64)


def window_keys(s: Shingles, part: int, bands: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each band (text of each window, key of each window)."""
    size = block_of(part)
    blocks = -(-s.count // size)
    if not blocks.sum():
        return
    at = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    text = np.repeat(np.arange(len(blocks)), blocks)
    begin = s.first[text] + (np.arange(len(text)) - at[text]) * size
    # a window starts at each block that has two more after it, and at the first block of shorter texts
    left = blocks[text] - (np.arange(len(text)) - at[text])
    heads = np.flatnonzero((left >= 3) | (np.arange(len(text)) == at[text]))
    second, third = heads + np.minimum(1, left[heads] - 1), heads + np.minimum(2, left[heads] - 1)
    for k in range(bands):
        low = np.minimum.reduceat(_order(s.hashes, k), begin)
        yield text[heads], _keys(np.minimum(np.minimum(low[heads], low[second]), low[third]), part, k)


def _table(hashes: DataFrame) -> np.ndarray:
    """``hashes(h)`` -> bit table of fixed size, one bit for each value of the low ``TABLE_BITS`` bits."""
    low = hashes.select(F.col("h").bitwiseAND(F.lit((1 << TABLE_BITS) - 1)).alias("low"))
    cells = (low.selectExpr("cast(shiftright(low, 5) as int) as cell", "shiftleft(1L, cast(low & 31 as int)) as bit")
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect())
    out = np.zeros(1 << (TABLE_BITS - 5), np.uint32)
    for r in cells:
        out[r["cell"]] = r["bits"]
    return out


def _in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = h & np.uint64((1 << TABLE_BITS) - 1)
    return (table[(low >> np.uint64(5)).astype(np.int64)] >> (low & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def index_items(items: DataFrame, share: float, miss: float, words: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, item_key, n, part, bands, keys, hashes, shingles)`` of every item that has shingles; bands are 0 where the shingles decide alone."""
    rows = items.select(F.col(item_id).alias("item_id"), text_key(text).alias("item_key"), F.col(text).cast("string").alias("text")).distinct()
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 500):
            s = shingles(b.column(2).to_pylist(), words)
            pick, out = [], {"n": [], "part": [], "bands": [], "keys": [], "hashes": [], "shingles": []}
            for i in range(b.num_rows):
                own = sorted({s.text_of(i, r) for r in range(s.first[i], s.first[i] + s.count[i])})
                if not own:
                    continue
                part = partition_of(int(s.count[i]))
                bands = bands_of(part, len(own), share, miss)
                if s.count[i] <= FEW or bands > len(_SEEDS):
                    bands = 0
                pick.append(i)
                out["n"].append(len(own))
                out["part"].append(part)
                out["bands"].append(bands)
                out["keys"].append(item_keys(s, i, part, bands).view(np.int64).tolist())
                out["hashes"].append(np.unique(s.hashes[s.first[i]:s.first[i] + s.count[i]]).view(np.int64).tolist())
                out["shingles"].append(own)
            some = b.take(pa.array(pick, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(out["n"], pa.int64()), pa.array(out["part"], pa.int32()), pa.array(out["bands"], pa.int32()), pa.array(out["keys"], pa.list_(pa.int64())), pa.array(out["hashes"], pa.list_(pa.int64())), pa.array(out["shingles"], pa.list_(pa.string()))], ["item_id", "item_key", "n", "part", "bands", "keys", "hashes", "shingles"])

    return rows.mapInArrow(run, f"item_id {kind}, item_key long, n long, part int, bands int, keys array<long>, hashes array<long>, shingles array<string>")


def contamination(docs: DataFrame, items: DataFrame, share: float = 0.8, words: int = 5, miss: float = 1e-5, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, text_key, item_id, n_shingles, containment)`` for every document that holds ``share`` of an item's shingles."""
    index = written(index_items(items, share, miss, words, item_id, item_text), "items")
    bands = {r["part"]: r["bands"] for r in index.where("bands > 0").groupBy("part").agg(F.max("bands").alias("bands")).orderBy("part").collect()}
    sc = docs.sparkSession.sparkContext
    key_table = sc.broadcast(_table(index.select(F.explode("keys").alias("h"))))
    few_table = sc.broadcast(_table(index.where("bands = 0").select(F.explode("hashes").alias("h"))))
    hash_table = sc.broadcast(_table(index.select(F.explode("hashes").alias("h"))))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known, few = key_table.value, hash_table.value, few_table.value
        for b in batches_of(batches, 200):
            s = shingles(b.column(2).to_pylist(), words)
            if not len(s.hashes):
                continue
            text_of, key_of = [], []
            for p, n in bands.items():
                for owner, key in window_keys(s, p, n):
                    hit = _in_table(keys, key)
                    text_of.append(owner[hit])
                    key_of.append(key[hit])
            hits = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (text_of, key_of)]
            pairs = np.unique(np.stack([hits[0].astype(np.uint64), hits[1]], axis=1), axis=0)
            touched = np.zeros(b.num_rows, bool)
            touched[pairs[:, 0].astype(np.int64)] = True
            owner = s.owner()
            at = np.flatnonzero((touched[owner] & _in_table(known, s.hashes)) | _in_table(few, s.hashes))
            if not len(at):
                continue
            found = sorted({(int(owner[r]), s.text_of(owner[r], r)) for r in at.tolist()})
            pick = pa.array(np.concatenate((pairs[:, 0].astype(np.int64), np.array([i for i, _ in found], np.int64))))
            key_col = pa.array(pairs[:, 1].view(np.int64).tolist() + [None] * len(found), pa.int64())
            text_col = pa.array([None] * len(pairs) + [x for _, x in found], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), key_col, text_col], ["doc_id", "text_key", "key", "shingle"])

    hits = written(rows.mapInArrow(run, f"doc_id {kind}, text_key long, key long, shingle string").distinct(), "hits")
    by_key = index.select("item_id", "item_key", F.explode("keys").alias("at"))
    found = hits.where("key is not null").join(by_key, F.col("key") == F.col("at")).select("doc_id", "text_key", "item_id", "item_key").distinct()
    by_shingle = index.select(F.col("item_id").alias("i"), F.col("item_key").alias("k"), "n", (F.col("bands") == 0).alias("few"), F.explode("shingles").alias("at"))
    held = (hits.where("shingle is not null").join(by_shingle, F.col("shingle") == F.col("at"))
            .groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "i", "k", "n", "few").agg(F.count("*").alias("found"))
            .where(F.col("found") >= share * F.col("n") - 1e-9))
    held = written(held, "held")
    kept = ["d", "t", "i", "n", "found"]
    sure = held.where("not few").join(found, held["d"].eqNullSafe(found["doc_id"]) & (held["t"] == found["text_key"]) & held["i"].eqNullSafe(found["item_id"]) & (held["k"] == found["item_key"])).select(*kept).unionByName(held.where("few").select(*kept))
    return sure.select(F.col("d").alias("doc_id"), F.col("t").alias("text_key"), F.col("i").alias("item_id"), F.col("n").alias("n_shingles"), (F.col("found") / F.col("n")).alias("containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: float) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns."""
    bad = written(contamination(docs, items, doc_id=doc_id, text=text, **how).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct(), "contaminated")
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["bad_id"]) & (text_key(docs[text]) == bad["bad_key"]), "left_anti")
