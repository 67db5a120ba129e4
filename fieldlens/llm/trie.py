"""Prefix trie of conversations, rolled up by centroid decomposition of its parent-edge forest.

A node is a distinct sequence of the first d turns (role, text); a conversation is a member of the nodes of all its prefixes. A prefix is known by two
60-bit XORs over its turns' SHA-256 (with their places), so the prefix before it is the XOR without its last turn, and running XORs need no
task to hold a conversation: they are taken within ranges of (conversation, turn), and carried over from range to range.

**Rollup.** Nodes with the same smallest member and as many members lie on one chain without a branch; chains, named by their last node, are the
nodes of a forest whose totals are rolled up, and within a chain a running sum gives each node its part. The forest is decomposed: of each
component the centroid is the deepest node with half of the members that end in the component. It is taken out; what hangs below each
of its children is a component of its own, and so is what is left above. The total of all below the centroid is added to the nodes on the path from it
up to the component's top. So a node's total is its own component's, the last time it is looked at, plus what was added to it. Every round halves
the components, so a chain of branches takes as few rounds as a bush.

Rounds run as joins while a component has more than ``limit`` nodes; then each component is decomposed to the end within a task, many of them at once
as arrays, by number of nodes. Whether a node lies below a centroid is read off the membership: the prefix of its smallest member at the centroid's depth.

Defined cases: turns are ordered by turn (null first), then role, then SHA-256 of the text; a null role or text is empty; rows with a null conv_id take no
part; repeated rows are turns of their own; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.shared import join_sized, written

#: Nodes of a component that a task decomposes by itself, and about the nodes that a task gets.
LIMIT = 1 << 15
#: Characters of conversation ids that are joined before they are hashed in order.
CHUNK = 1 << 16
ROOT = "0" * 30


# -- running totals ------------------------------------------------------------------------------------------

_KINDS = {"sum": (F.sum, lambda a, b: a + b), "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}


def running(rows: DataFrame, key: str, order: list[str], totals: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with columns ``name: (kind, column)``: the running sum or XOR of a column over the rows of a key, in order, up to the row. Rows
    are dealt by ranges of key and order, so a key may have any number of rows; the totals of a key's earlier ranges are carried, at most one key a range."""
    dealt = written(rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()), "trie-dealt")
    ends = dealt.groupBy(F.col(key).alias("_key"), "_part").agg(*[_KINDS[kind][0](c).alias(f"_{n}") for n, (kind, c) in totals.items()])
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    several = ends.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    carried = ends.join(F.broadcast(several), "_key").select(F.col("_key"), F.col("_part").alias("_at"), *[_KINDS[kind][0](f"_{n}").over(before).alias(f"_{n}") for n, (kind, _) in totals.items()])
    carried = carried.where(f"_{next(iter(totals))} is not null")
    within = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({n: _KINDS[kind][0](c).over(within) for n, (kind, c) in totals.items()})
    joined = local.join(F.broadcast(carried), (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_at")), "left")
    out = {n: _KINDS[kind][1](F.col(n), F.coalesce(F.col(f"_{n}"), F.lit(0))) for n, (kind, _) in totals.items()}
    return joined.withColumns(out).select(*rows.columns, *totals)


# -- conversations -------------------------------------------------------------------------------------------

def ordered(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> ``(conv_id, place, role, sha, n_bytes)``: turns numbered from 1; texts do not move."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                                                             F.sha2(text.cast("binary"), 256).alias("sha"), F.octet_length(text).cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("one"))
    return running(rows, "conv_id", ["turn", "role", "sha"], {"place": ("sum", "one")}).drop("turn", "one")


def branched(turns: DataFrame, family: int = 5, shared: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as others do: conversation c starts with the first h turns of conversation c - c % ``family`` and goes on with its own turns after its
    first h, h being crc32(c) % ``shared``. Gives ``(conv_id, place, role, sha, n_bytes, last)`` and ``(conv_id, length)``, also of those without turns."""
    turns = written(turns, "trie-turns")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    named = own.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    bases = own.select(F.col("conv_id").alias("b"), F.col("n").alias("base_n"))
    plan = named.join(bases, F.col("base") == F.col("b"), "left").select("conv_id", "n", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    plan = written(plan.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-plan")
    total = turns.count()
    kept = join_sized(turns, plan, "conv_id", "n", total).where("place > h").withColumn("place", F.col("taken") + F.col("place") - F.col("h"))
    heads = turns.where(F.col("place") < shared).withColumnRenamed("conv_id", "of")
    begun = heads.join(plan, (F.col("of") == F.col("base")) & (F.col("place") <= F.col("h")))
    out = [x.select("conv_id", "place", "role", "sha", "n_bytes", (F.col("place") == F.col("length")).alias("last")) for x in (begun, kept)]
    return out[0].unionByName(out[1]), plan.select("conv_id", "length")


# -- the trie ------------------------------------------------------------------------------------------------

def _sixty(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def _name(a: Column, b: Column) -> Column:
    return F.concat(F.lpad(F.hex(a), 15, "0"), F.lpad(F.hex(b), 15, "0"))


def members(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(conv_id, depth, node, parent, n_bytes, last)``: a row for each prefix of each conversation, the empty one included."""
    digest = F.sha2(F.concat_ws(":", F.col("place").cast("string"), F.length("role").cast("string"), "role", "sha").cast("binary"), 256)
    hashed = turns.withColumn("digest", digest).select("conv_id", "place", "n_bytes", "last", _sixty(F.col("digest"), 1).alias("e1"), _sixty(F.col("digest"), 16).alias("e2"))
    run = running(hashed, "conv_id", ["place"], {"k1": ("xor", "e1"), "k2": ("xor", "e2")})
    rows = run.select("conv_id", F.col("place").cast("long").alias("depth"), _name(F.col("k1"), F.col("k2")).alias("node"),
                      _name(F.col("k1").bitwiseXOR(F.col("e1")), F.col("k2").bitwiseXOR(F.col("e2"))).alias("parent"), "n_bytes", "last")
    top = lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("n_bytes"), (F.col("length") == 0).alias("last"))
    return rows.unionByName(top)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, conv_id) in order -> (node, first, ids): ids joined by commas, about ``CHUNK`` characters at a time."""
    schema = pa.schema([("node", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
    held, node, first, ids, size = [], None, None, [], 0

    def close() -> None:
        if ids:
            held.append((node, first, ",".join(ids)))

    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n != node or size >= CHUNK:
                close()
                node, first, ids, size = n, c, [], 0
            ids.append(str(c))
            size += len(ids[-1])
        if len(held) > 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], schema=schema)
            held = []
    close()
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, ids) in order -> (node, ends_sha256); only the state of one hash is held."""
    schema = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])
    node, state, held = None, None, []
    for batch in batches:
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n != node:
                if state:
                    held.append((node, state.hexdigest()))
                node, state = n, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(held) > 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], schema=schema)
            held = []
    if state:
        held.append((node, state.hexdigest()))
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], schema=schema)


def end_digests(rows: DataFrame) -> DataFrame:
    """``rows(node, conv_id)`` -> ``(node, ends_sha256)``: SHA-256 over a node's conversations, in order. Ids are joined to chunks by ranges; only the chunks of a
    node are hashed one after the other, because the hash is a sequence."""
    dealt = rows.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = dealt.mapInArrow(_chunks, "node string, first long, ids string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(_digests, "node string, ends_sha256 string")


# -- centroid decomposition ----------------------------------------------------------------------------------

def decompose(up: np.ndarray, depth: np.ndarray, values: np.ndarray, added: np.ndarray) -> np.ndarray:
    """``up``: each node's parent by index, -1 for a top; ``values``: a row of measures for each node; ``added``: what earlier rounds added. Gives each node's
    totals over its subtree. All components are decomposed at once, a centroid of each in every round."""
    up, added = up.copy(), added.copy()
    out = np.zeros_like(values)
    alive = np.argsort(depth, kind="stable")
    while len(alive):
        size, total = np.ones(len(up), np.int64), values.copy()
        levels = np.split(alive, np.flatnonzero(np.diff(depth[alive])) + 1)
        root = np.arange(len(up))
        for level in reversed(levels):
            below = level[up[level] >= 0]
            np.add.at(size, up[below], size[below])
            np.add.at(total, up[below], total[below])
        for level in levels:
            below = level[up[level] >= 0]
            root[below] = root[up[below]]
        half = alive[2 * size[alive] >= size[root[alive]]]
        half = half[np.lexsort((-depth[half], size[half], root[half]))]
        centroid = half[np.append(True, root[half][1:] != root[half][:-1])]
        at, amount = up[centroid], total[centroid]
        while (on := at >= 0).any():  # up the paths of all components together
            at, amount = at[on], amount[on]
            added[at] += amount  # a path is in one component, so no node comes twice
            at = up[at]
        out[centroid] = added[centroid] + total[centroid]
        gone = np.zeros(len(up) + 1, bool)
        gone[centroid] = True
        up[gone[up]] = -1
        alive = alive[~gone[alive]]
    return out


def _finish(table: pa.Table, measures: list[str]) -> pa.Table:
    nodes, comp = table.column("node").to_pylist(), table.column("comp").to_pylist()
    place = {n: i for i, n in enumerate(nodes)}
    up = np.array([place.get(u, -1) for u in table.column("up").to_pylist()], np.int64)
    up = np.array([u if u >= 0 and comp[u] == comp[i] else -1 for i, u in enumerate(up.tolist())], np.int64)
    values, added = (np.stack([table.column(f"{p}{m}").to_numpy() for m in measures], axis=1) for p in ("", "added_"))
    out = decompose(up, table.column("depth").to_numpy(), values, added)
    return pa.table({"node": pa.array(nodes, pa.string())} | {f"total_{m}": out[:, i] for i, m in enumerate(measures)})


def rollup(forest: DataFrame, prefixes: DataFrame, measures: list[str], limit: int = LIMIT) -> DataFrame:
    """``forest(node, up, line, depth, size, measures...)``: nodes with their parent, a member, and how many members they have; ``prefixes(conv_id, depth, node, parent)``.
    -> ``(node, total_measure...)``: whole numbers added up over each node's subtree."""
    added = [f"added_{m}" for m in measures]
    schema = ", ".join(["node string", *[f"total_{m} long" for m in measures]])
    plain = ["node", "up", "line", "depth", "size", "comp", *measures, *added]
    active = written(forest.withColumns({"comp": F.lit(ROOT)} | {a: F.lit(0).cast("long") for a in added}).select(*plain), "trie-forest")
    ready, done = [], []
    while True:
        sizes = active.groupBy("comp").agg(F.count("*").alias("nodes"), F.max("size").alias("all"), F.min("depth").alias("top"))
        sizes = written(sizes, "trie-sizes")
        large = sizes.where(F.col("nodes") > limit)
        # at most as many rows as limits go into the forest
        ready.append(active.join(F.broadcast(large.select("comp")), "comp", "left_anti").select(*plain))
        if large.isEmpty():
            break
        rest = active.join(F.broadcast(large), "comp")
        eligible = rest.where("2 * size >= all")
        picked = F.min_by(F.struct("node", "line", "depth", "size", "top"), F.struct(F.col("size"), -F.col("depth"), F.col("node")))
        centroid = eligible.groupBy("comp").agg(picked.alias("c"))
        centroid = written(centroid.select("comp", F.col("c.node").alias("c_node"), F.col("c.line").alias("c_line"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size"), F.col("c.top").alias("top")), "trie-centroids")
        rest = active.join(F.broadcast(centroid), "comp")
        # below the centroid: the prefix, one turn longer than the centroid, of the node's line
        asked = rest.where("depth > c_depth").groupBy("comp", "line", "c_node", "c_depth").agg(F.count("*").alias("asking"))
        longer = prefixes.select(F.col("conv_id").alias("line"), (F.col("depth") - 1).alias("c_depth"), F.col("node").alias("label"), F.col("parent").alias("c_node"))
        below = written(asked.join(longer, ["line", "c_depth", "c_node"]).select(F.struct("comp", "line").alias("branch"), "label", "asking"), "trie-below")
        keyed = rest.withColumn("branch", F.struct("comp", "line"))
        under = join_sized(keyed.where("depth > c_depth"), below, "branch", "asking", active.count())
        under = written(under.select(*plain, "label", "c_node"), "trie-under")
        central = rest.where("node = c_node")
        totals = (under.select("comp", *measures).unionByName(central.select("comp", *measures)).groupBy("comp").agg(*[F.sum(m).alias(f"sum_{m}") for m in measures]))
        totals = written(totals, "trie-totals")
        done.append(central.join(F.broadcast(totals), "comp").select("node", *[(F.col(f"added_{m}") + F.col(f"sum_{m}")).alias(f"total_{m}") for m in measures]))
        path = (prefixes.join(F.broadcast(centroid.join(totals, "comp")), (F.col("conv_id") == F.col("c_line")) & F.col("depth").between(F.col("top"), F.col("c_depth") - 1))
                .select("comp", "node", "c_size", *[f"sum_{m}" for m in measures]))
        above = rest.join(under.select("node"), "node", "left_anti").where("node <> c_node").select(*plain).join(path, ["comp", "node"], "left")
        above = above.withColumn("size", F.col("size") - F.coalesce("c_size", F.lit(0))).withColumns({f"added_{m}": F.col(f"added_{m}") + F.coalesce(f"sum_{m}", F.lit(0)) for m in measures})
        active = written(above.select(*plain).unionByName(under.withColumn("comp", F.col("label")).select(*plain)), "trie-forest")
    small = ready[0]
    for r in ready[1:]:
        small = small.unionByName(r)
    small = written(small, "trie-ready")
    tasks = max(1, -(-small.count() // limit))
    solved = small.withColumn("task", F.pmod(F.xxhash64("comp"), F.lit(tasks))).groupBy("task").applyInArrow(lambda t: _finish(t, measures), schema)
    for d in done:
        solved = solved.unionByName(d)
    return solved


def trie(turns: DataFrame, lengths: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``turns(conv_id, place, role, sha, n_bytes, last)`` and ``lengths(conv_id, length)`` -> a row for each node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``."""
    rows = written(members(turns, lengths), "trie-members")
    nodes = rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"))
    nodes = written(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("n_bytes")), "trie-nodes")
    count = nodes.count()
    born = nodes.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("born"))
    nodes = written(nodes.join(born, F.col("node") == F.col("of"), "left").select(*nodes.columns, F.coalesce("born", F.lit(0)).cast("long").alias("n_children"), F.struct("conv_id", "n_convs").alias("chain")), "trie-nodes")
    chains = nodes.groupBy("chain").agg(F.max_by("node", "depth").alias("node"), F.min_by("parent", "depth").alias("up"), F.max("depth").alias("depth"), F.count("*").alias("links"),
                                        F.sum("own").alias("saved"), F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaves"))
    chains = written(chains, "trie-chains")
    forest = chains.select("node", "up", F.col("chain.conv_id").alias("line"), "depth", F.col("chain.n_convs").alias("size"), "leaves", "saved")
    totals = rollup(forest, rows.select("conv_id", "depth", "node", "parent"), ["leaves", "saved"], limit)
    by_chain = written(chains.select("chain", "links", F.col("node").alias("at")).join(totals, F.col("at") == F.col("node")).select("chain", "links", "total_leaves", "total_saved"), "trie-rolled")
    run = running(nodes, "chain", ["depth"], {"upto": ("sum", "own")})
    rolled = join_sized(run, by_chain, "chain", "links", count)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"))
    placed = written(rolled.select("node", "conv_id", "depth", "parent", "n_convs", "n_children", F.col("total_leaves").alias("n_leaves"),
                                   (F.col("total_saved") - F.col("upto") + F.col("own")).alias("saved_tokens")), "trie-placed")
    linked = join_sized(placed.where("parent is not null"), parents, "parent", "siblings", count).drop("siblings")
    whole = linked.unionByName(placed.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")))
    ends = end_digests(rows.where("last")).select(F.col("node").alias("end"), "ends_sha256")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.join(ends, F.col("node") == F.col("end"), "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
