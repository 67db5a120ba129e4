"""What the operators keep to beside their results: a ring that prunes, scores that do not follow the split, whole short texts, one row chosen by all columns, no hot leaf."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import gru, langid, licenses, mixing, shared, simhash


def test_the_ring_rejects_pairs_that_share_segments(spark):
    """Pairs that share two of four segments: the chain drops most of those too far apart, the full check the rest, and none within the distance."""
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(3000):
        x = 0
        for s in rng.choice(4, 2, replace=False):
            for b in rng.choice(16, rng.integers(0, 6), replace=False):
                x |= 1 << int(16 * s + b)
        rows.append((x - (1 << 64) if x >> 63 else x,))
    frame = spark.createDataFrame(rows, "x long").withColumn("bits", F.bit_count("x")).withColumn("ring", simhash.in_ring(F.col("x"), 2, 4))
    count = {(r.ring, r.near): r["count"] for r in frame.groupBy("ring", (F.col("bits") <= 2).alias("near")).count().collect()}
    assert (False, True) not in count
    assert count[False, False] > 0 and count[True, False] > 0  # both the chain and the check reject


def _texts(spark):
    rng = random.Random(2)
    return spark.createDataFrame([(i, " ".join(rng.choice(["red", "blue", "green", "stone", f"w{rng.randrange(60)}"]) for _ in range(rng.randrange(1, 120)))) for i in range(400)] + [(900, None), (901, "")],
                                 "doc_id long, text string")


def test_scores_do_not_follow_the_split(spark, monkeypatch):
    monkeypatch.setattr(gru, "SHARD_TOKENS", 2500)
    docs = _texts(spark)
    held = F.col("doc_id") % 5 == 1
    one, eight = [{r.doc_id: (r.n_tokens, r.base_score, r.score) for r in gru.score(docs.repartition(n), held).collect()} for n in (1, 8)]
    assert one.keys() == eight.keys()
    for i, (n, base, own) in one.items():
        assert eight[i][0] == n and eight[i][1] == pytest.approx(base, abs=1e-9) and eight[i][2] == pytest.approx(own, rel=1e-4, abs=1e-4)


def test_excerpts_come_from_anywhere_in_a_text(spark):
    long = " ".join(f"word{i}" for i in range(4000))
    parts = [p for p, _ in gru._excerpts(spark.createDataFrame([(i, f"{long} {i}") for i in range(30)], "doc_id long, text string"), "text")]
    starts = {p.split()[0] for p in parts}
    assert len(parts) == 30 and len(starts) > 15 and all(s.startswith("word") for s in starts)


def test_a_language_of_two_word_texts_is_learned(spark):
    rng = random.Random(1)
    xx, yy = ["bakko", "tikko", "lukko", "sakko"], ["renta", "vinta", "lonta", "minta"]
    rows = [(i, " ".join(rng.choice(xx) for _ in range(2)), "xx") for i in range(200)] + [(1000 + i, " ".join(rng.choice(yy) for _ in range(30)), "yy") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True))
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark.createDataFrame([(1, "bakko lukko"), (2, "nakko"), (3, "renta minta"), (4, "zzanta")], "doc_id long, text string"), model, ["doc_id"]).collect()}
    assert got == {1: "xx", 2: "xx", 3: "yy", 4: "yy"}


def test_short_templates_are_found_by_their_shingles():
    assert [licenses.half_of(n) for n in (1, 4, 7)] == [0, 0, 0] and licenses.half_of(8) > 0
    assert all(licenses.miss_bound(n) == 0 for n in range(1, 8))


def test_one_of_repeated_rows_is_the_same_in_every_run(spark):
    rows = [(1, "a", "x", 5), (1, "a", "x", None), (1, "a", "b", 9), (2, None, "q", 1), (2, None, "p", 1), (None, "z", "k", 1)]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string, key string, order int").repartition(1 + seed)
        got = sorted(map(tuple, shared.first_rows(frame, "doc_id", "text").collect()), key=str)
        assert got == sorted([(1, "a", "b", 9), (2, None, "p", 1), (None, "z", "k", 1)], key=str)


def test_rows_are_not_dealt_by_leaf(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") >= 0, "x").otherwise("y").alias("a"), F.lit(3).alias("n_tokens"))
    plan = spark.createDataFrame([("x", 1, 2)], "a string, whole int, part int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = mixing._planned(rows, plan, ["a"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
