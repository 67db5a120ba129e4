"""Prefix trie: nodes against brute force, decomposition against plain sums, with and without rounds of joins, edge cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from fieldlens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node int"


def brute(rows):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:]
    nodes = collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    kids = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((m[0], len(p), nodes[p[:-1]][0] if p else -10**9, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in nodes.items())


def result(df):
    return sorted((r.conv_id, r.depth, -10**9 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def conversations(seed, convs=260):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "héllo", "", None, "why?", "long " * 300])) for c in rng.sample(range(-40, 900), convs) for t in range(rng.randrange(0, 9))]
    rows += [(2000 + i, t, "user", "same") for i in range(150) for t in range(4)]
    rows += [(3000, t, "user", f"t{t}") for t in range(400)]  # one long conversation
    rows += [(None, 1, "user", "x"), (4001, None, None, None), (4001, None, "user", "a"), (4001, 3, "user", "b"), (4001, 3, "user", "b"), (4001, 3, "user", "a")]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("limit", [trie.LIMIT, 40])
def test_nodes_equal_brute_force(spark, limit):
    rows = conversations(limit)
    got = trie.trie(*trie.branched(trie.ordered(table(spark, rows))), limit=limit)
    assert result(got) == brute(rows)


def test_empty_table_and_one_turnless_conversation(spark):
    build = lambda rows: trie.trie(*trie.branched(trie.ordered(table(spark, rows))))
    rows = [(next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1), 0, "user", "gone")]
    assert result(build(rows)) == brute(rows) and len(brute(rows)) == 1
    assert table(spark, rows).limit(0).transform(lambda d: trie.trie(*trie.branched(trie.ordered(d)))).count() == 0


@pytest.mark.parametrize("shape", ["chain", "bush", "comb", "random", "forest"])
def test_decomposition_gives_subtree_sums(shape):
    rng = np.random.default_rng(7)
    n = 600
    up = {"chain": np.arange(n) - 1, "bush": np.where(np.arange(n) > 0, 0, -1), "comb": np.where(np.arange(n) % 2, np.arange(n) - 1, np.arange(n) - 2),
          "random": np.array([-1, *[rng.integers(0, i) for i in range(1, n)]]), "forest": np.array([-1 if i % 50 == 0 else rng.integers(i // 50 * 50, i) for i in range(n)])}[shape]
    up = np.maximum(up, -1)
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = depth[up[i]] + 1 if up[i] >= 0 else 0
    values, added = rng.integers(0, 100, (n, 2)), rng.integers(0, 9, (n, 2))
    want = values.copy()
    for i in range(n - 1, -1, -1):
        if up[i] >= 0:
            want[up[i]] += want[i]
    assert (trie.decompose(up, depth, values, added) == want + added).all()


def test_running_totals_carry_over_ranges(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(30)}", i, rng.randrange(1 << 59), 1) for i in range(3000)]
    got = trie.running(spark.createDataFrame(rows, "k string, i long, e long, one long"), "k", ["i"], {"n": ("sum", "one"), "x": ("xor", "e")}).collect()
    count, xor = collections.Counter(), collections.Counter()
    want = set()
    for k, i, e, _ in rows:
        count[k] += 1
        xor[k] ^= e
        want.add((k, i, count[k], xor[k]))
    assert {(r.k, r.i, r.n, r.x) for r in got} == want and len(got) == 3000


def test_long_lists_of_ends_are_hashed_in_order(spark, monkeypatch):
    ids = [("a", i) for i in range(-5, 40_000)] + [("b", 3)]
    got = {r.node: r.ends_sha256 for r in trie.end_digests(spark.createDataFrame(ids, "node string, conv_id long").repartition(6)).collect()}
    assert got == {"a": hashlib.sha256(",".join(map(str, range(-5, 40_000))).encode()).hexdigest(), "b": hashlib.sha256(b"3").hexdigest()}
