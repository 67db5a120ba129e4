"""Approximate nearest neighbours by a hash-prefix forest.

Each of ``TREES`` trees gives a vector a string of ``BITS`` bits, the sides of random hyperplanes that it lies on, so close vectors share
long prefixes. Vectors lie in blocks of about ``BLOCK_ROWS`` rows, those with one prefix in the first tree together (a prefix of more rows is salted); a block holds
each tree's strings as a sorted array.
A query descends to its longest match in every tree, then all trees ascend together, bit by bit, and the rows that each shorter prefix adds
are scored with the exact cosine.

It stops when its ``k``-th best cosine so far is one that the trees would have missed with a chance of at most ``MISS`` at the
length reached: two vectors at an angle of a share a bit with a chance of 1 - a / pi, so a length l misses with (1 - (1 - a / pi) ** l) ** TREES.
The better its neighbours are, the longer the prefix at which it stops. Only if it has none at all does it go up to the root, where all rows match.

A query first searches the block of its own prefix. What it finds there is a floor for its ``k``-th best in the whole table, and tells the shortest prefix that it may need elsewhere.
Where that is ``ROUTES`` bits or more the forest, rows (length, tree, prefix, block), says which blocks hold it, and the query goes only there; a shorter prefix is
in nearly every block. A block asked by over ``BLOCK_QUERIES`` queries takes them in batches, side by side.

Vectors that are equal bit by bit are one entry with its ``k + 1`` smallest ids, which is all a result of ``k`` can hold, so
a vector that repeats without end is one row.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components takes no part, nor does a null id;
vectors meet only those of their own length; a row that repeats counts once, and an id's own rows are never its neighbours; of an id with several vectors the
nearest counts, though a search may count each where it decides to stop.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from fieldlens.llm.shared import batches_of, written

TREES, BITS, SEED = 128, 32, 29
MISS = 0.1
BLOCK_ROWS, BLOCK_QUERIES = 4096, 4096
#: Prefix lengths, in bits, at which the forest says which blocks hold a prefix.
ROUTES = (32, 27, 22)
_AT_ONCE = 256  # queries that ascend together in a task


@lru_cache(maxsize=8)
def _planes(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, TREES * BITS))


def hash_strings(x: np.ndarray) -> np.ndarray:
    """(rows, TREES) strings of unit vectors, as integers whose leading bits come first."""
    sides = (x @ _planes(x.shape[1]) > 0).reshape(len(x), TREES, BITS)
    return sides @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def missed(score: np.ndarray, length: int) -> np.ndarray:
    """Chance that no tree holds a neighbour of that cosine under a prefix of ``length`` bits."""
    return (1 - (1 - np.arccos(np.clip(score, -1, 1)) / np.pi) ** length) ** TREES


def settles(length: int) -> float:
    """The least cosine that is missed with a chance of ``MISS`` at most under prefixes of ``length`` bits."""
    return float(np.cos(np.pi * (1 - (1 - MISS ** (1 / TREES)) ** (1 / length)))) if length else -2.0


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda v: v != 0)


def entries(rows: DataFrame, vec_id: str, vector: str, k: int) -> DataFrame:
    """``(entry, dim, ids, vec)``: distinct vectors as bytes of doubles with their ``k + 1`` smallest ids; entry is the smallest."""
    ok = rows.where(F.col(vec_id).isNotNull() & _usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("id"), F.transform(F.col(vector), lambda v: v.cast("double") + 0.0).alias("v"))
    ranked = ok.distinct().withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    packed = ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 2000):
            vec = [np.asarray(v, np.float64).tobytes() for v in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(v) // 8 for v in vec], pa.int32()), b.column(1), pa.array(vec, pa.binary())], ["entry", "dim", "ids", "vec"])

    return packed.mapInArrow(run, "entry long, dim int, ids array<long>, vec binary")


def with_strings(some: DataFrame) -> DataFrame:
    """``some(key, dim, ids, vec)`` with ``strings``, one for each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 1000):
            dims = np.array(b.column("dim"))
            for dim in np.unique(dims).tolist():
                part = b.take(pa.array(np.flatnonzero(dims == dim)))
                strings = hash_strings(_unit(_matrix(part.column("vec").to_pylist())))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(strings.tolist(), pa.list_(pa.int64()))], [*part.schema.names, "strings"])

    return some.mapInArrow(run, "entry long, dim int, ids array<long>, vec binary, strings array<long>")


def _matrix(vecs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows, in double precision, summed in the same way for every pair."""
    top = np.abs(q).max(), np.abs(x).max(axis=1)
    q, x = q / top[0], x / top[1][:, None]
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


_FOUND = "query_id long, asked long, vec_id long, score double, prefix int, scored long"


def _ascend(unit: np.ndarray, arrays: np.ndarray, order: np.ndarray, q: np.ndarray, strings: np.ndarray, floor: np.ndarray, own: list[list[int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """For some queries the rough cosines of a block's rows, -inf for those not reached, and the prefix length at which each query stopped."""
    n = len(unit)
    score = np.full((len(q), n), -np.inf)
    stop = np.zeros(len(q), int)
    total = np.zeros(len(q), np.int64)
    best = floor.copy()
    active = np.arange(len(q))
    base = np.arange(TREES)[:, None] * n
    flat = order.ravel()
    for length in range(BITS, -1, -1):
        shift = BITS - length
        first = strings[active] >> shift
        low = np.stack([np.searchsorted(arrays[t], first[:, t] << shift) for t in range(TREES)])
        size = np.stack([np.searchsorted(arrays[t], (first[:, t] + 1) << shift) for t in range(TREES)]) - low
        for j, i in enumerate(active):
            held = size[:, j].sum()
            if held == total[i]:
                continue
            total[i] = held
            if length:
                some = size[:, j]
                at = np.repeat((low + base)[:, j] - np.cumsum(some) + some, some) + np.arange(held)
                here = np.zeros(n, bool)
                here[flat[at]] = True
                new = np.flatnonzero(here & np.isneginf(score[i]))
            else:
                new = np.flatnonzero(np.isneginf(score[i]))
            score[i, new] = unit[new] @ q[i]
            others = score[i].copy()
            others[own[i]] = -np.inf
            if n >= k:
                best[i] = max(best[i], np.partition(others, -k)[-k])
        done = best[active] >= settles(length)
        stop[active[done]] = length
        active = active[~done]
        if not len(active):
            break
    return score, stop


def _search(k: int):
    """For one block and batch: the ``k`` nearest found by each query, and a row with a null id that tells how many rows it scored."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int | None, float | None, int, int]] = []
        if len(queries) and len(rows):
            x = _matrix(rows["vec"].tolist())
            unit = _unit(x)
            ids = [list(v) for v in rows["ids"]]
            alone: dict[int, list[int]] = {}
            for r, v in enumerate(ids):
                if len(v) == 1:
                    alone.setdefault(v[0], []).append(r)
            strings = np.stack(rows["strings"].tolist()).T
            order = np.argsort(strings, axis=1, kind="stable")
            arrays = np.take_along_axis(strings, order, axis=1)
            for start in range(0, len(queries), _AT_ONCE):
                some = queries.iloc[start:start + _AT_ONCE]
                q = _matrix(some["vec"].tolist())
                floor = np.nan_to_num(some["floor"].to_numpy(np.float64, na_value=np.nan), nan=-1.5)
                score, stop = _ascend(unit, arrays, order, _unit(q), np.stack(some["strings"].tolist()), floor, [alone.get(v, []) for v in some["query_id"]], k)
                for i, (query_id, asked) in enumerate(zip(some["query_id"], some["asked"], strict=True)):
                    scored = int(np.isfinite(score[i]).sum())
                    most, found = k + 1, {}
                    while scored and len(found) < k:
                        most = min(most, scored)
                        near = np.flatnonzero(score[i] >= np.partition(score[i], -most)[-most] - 1e-9)
                        for s, r in sorted(zip(cosine(q[i], x[near]).tolist(), near.tolist(), strict=True)):
                            found |= {v: s for v in ids[r] if v != query_id}
                        if most == scored:
                            break
                        most *= 4
                    out += [(query_id, asked, v, s, int(stop[i]), 0) for v, s in sorted(found.items(), key=lambda f: (-f[1], f[0]))[:k]]
                    out.append((query_id, asked, None, None, int(stop[i]), scored))
        return pd.DataFrame(out, columns=["query_id", "asked", "vec_id", "score", "prefix", "scored"]).astype({"vec_id": "Int64"})

    return run


def nearest(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score, prefix, scored)``: for rows where ``is_query`` holds of ``vec_id``, the ``k`` nearest found, the shortest prefix
    that the query went up to and the number of rows scored for it."""
    kind = rows.schema[vector].dataType
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, FloatType | DoubleType):
        raise ValueError(f"{vector} must be an array of floats or doubles")
    held = written(with_strings(entries(rows, vec_id, vector, k)), "ann-entries")
    # cells of the first tree, about as many as blocks are needed; those of more rows are salted
    cell = F.shiftright(F.col("strings")[0], BITS - min(20, (held.count() // BLOCK_ROWS).bit_length()))
    cells = held.groupBy("dim", cell.alias("cell")).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("salts"))
    dealt = held.withColumn("cell", cell).join(cells, ["dim", "cell"])
    index = written(dealt.withColumn("block", F.xxhash64("cell", F.pmod(F.xxhash64("entry"), "salts"))).drop("cell", "salts"), "ann-index")
    asking = rows.where(is_query & F.col(vec_id).isNotNull() & _usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("query_id"), F.transform(F.col(vector), lambda v: v.cast("double") + 0.0).alias("v")).distinct()
    own = written(with_strings(_as_entries(asking)).select(F.col("ids")[0].alias("query_id"), F.col("entry").alias("asked"), "dim", "vec", "strings"), "ann-queries")
    query = ["query_id", "asked"]
    first = written(own.withColumn("cell", cell).join(cells, ["dim", "cell"]).select(*query, "dim", F.xxhash64("cell", F.pmod("asked", "salts")).alias("block")), "ann-first")
    found = written(_round(index, own.withColumn("floor", F.lit(None).cast("double")), first, k), "ann-found")
    if index.select("block").distinct().limit(2).count() > 1:
        floors = found.where(F.col("vec_id").isNotNull()).groupBy(*query).agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select(*query, F.col("least").alias("floor"))
        floored = written(own.join(floors, query, "left"), "ann-floors")
        rest = _routes(index, floored).join(first, [*query, "dim", "block"], "left_anti")
        found = found.unionByName(written(_round(index, floored, rest, k), "ann-found"))
    top = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.where(F.col("vec_id").isNotNull()).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
    effort = found.groupBy("query_id").agg(F.min("prefix").alias("prefix"), F.sum("scored").alias("scored"))
    return best.join(effort, "query_id").select("query_id", "rank", "vec_id", "score", "prefix", "scored")


def _as_entries(queries: DataFrame) -> DataFrame:
    """Queries in the form of entries; the entry numbers an id's vectors by their bytes, the ids hold the query's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 2000):
            vec = [np.asarray(v, np.float64).tobytes() for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(v) // 8 for v in vec], pa.int32()), b.column(0), pa.array(vec, pa.binary())], ["dim", "query_id", "vec"])

    rows = queries.mapInArrow(run, "dim int, query_id long, vec binary")
    return rows.select(F.xxhash64("vec").alias("entry"), "dim", F.array("query_id").alias("ids"), "vec")


def _routes(index: DataFrame, own: DataFrame) -> DataFrame:
    """``(query_id, asked, dim, block)``: blocks that may hold a row of a query under the prefix at which its floor would let it stop."""
    query, block = ["query_id", "asked"], ["dim", "block"]
    route = F.lit(0)
    for length in sorted(ROUTES):
        route = F.when(F.col("floor") >= settles(length), length).otherwise(route)
    own = own.withColumn("route", route)
    out = own.where(F.col("route") == 0).select(*query, "dim").join(index.select(*block).distinct(), "dim")
    for length in sorted(row["route"] for row in own.where(F.col("route") > 0).select("route").distinct().collect()):  # at most one for each of ROUTES
        prefix = F.shiftright("string", BITS - length).alias("cell")
        cells = index.select(*block, F.posexplode("strings").alias("tree", "string")).select(*block, "tree", prefix).distinct()
        wanted = own.where(F.col("route") == length).select(*query, "dim", F.posexplode("strings").alias("tree", "string")).select(*query, "dim", "tree", prefix)
        out = out.unionByName(wanted.join(cells, ["dim", "tree", "cell"]).select(*query, *block).distinct())
    return out


def _round(index: DataFrame, own: DataFrame, routes: DataFrame, k: int) -> DataFrame:
    """What queries find in the blocks that they are sent to, ``k`` rows from each at most."""
    query, block = ["query_id", "asked"], ["dim", "block"]
    routes = written(routes, "ann-routes")
    batches = routes.groupBy(*block).agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("batches"))
    asks = (routes.join(batches, block).withColumn("batch", F.pmod(F.xxhash64(*query), F.col("batches")).cast("int"))
            .join(own.drop("dim"), query).select(*query, "vec", "strings", "floor", *block, "batch"))
    rows = (index.join(batches, block).select("ids", "vec", "strings", *block, F.explode(F.sequence(F.lit(0), F.col("batches") - 1)).alias("batch")))
    keys = [*block, "batch"]
    return asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(_search(k), _FOUND)
