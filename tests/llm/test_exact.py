"""Exact dedup: groups and kept rows against brute force, filter rounds, edge cases, plan."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from fieldlens.llm import exact

SCHEMA = "doc_id long, text string, sha string, keep_id long, whole int"


def brute(rows):
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for text in {p for _, p in plain}:
        ids = sorted((i for i, p in plain if p == text), key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def result(found):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in found.collect()), key=str)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "x", 7, 1) for i, t in rows], SCHEMA).repartition(parts)


def sample():
    rng = random.Random(5)
    rows = [(i, f"text {rng.randrange(900)} of\t{'many' if i % 2 else 'many '} words") for i in range(1500)]
    rows += [(5000 + i, "hot  copy" if i % 2 else "hot\ncopy") for i in range(800)]
    rows += [(9001, None), (9000, ""), (9002, " "), (9003, "\t\n"), (9004, "x" * 200_000), (9005, "x" * 200_000), (None, "hot copy"), (None, "alone"), (None, "alone"), (9006, "Ä é"), (9007, "Ä é"), (12, "again"), (12, "again")]
    return rows


def test_groups_equal_brute_force(spark):
    rows = sample()
    assert result(exact.groups(table(spark, rows))) == brute(rows)


def test_rounds_give_the_same(spark):
    rows = sample()
    bits, rounds = exact.filter_size(len(rows), 1 << 12)
    assert rounds == 3
    assert result(exact.groups(table(spark, rows), max_bits=1 << 12)) == brute(rows)


def test_kept_rows_hold_all_columns(spark):
    rows = sample()
    kept = exact.keep_first(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "sha", "keep_id", "whole"]
    got = sorted(((r.doc_id, r.sha, r.keep_id) for r in kept.collect()), key=str)
    assert got == sorted(((i, "x", 7) for i, _, _, k, _ in brute(rows) if k), key=str)


def test_empty_table(spark):
    none = table(spark, sample()).limit(0)
    assert exact.groups(none).count() == 0 and exact.keep_first(none).count() == 0


def test_lone_texts_pass_the_filter_by(spark):
    rows = table(spark, [(i, f"own text {i}") for i in range(4000)] + [(10_000 + i, f"own text {i}") for i in range(40)])
    hashed = rows.select("doc_id", exact.text_hash(F.col("text")).alias("sha"))
    (maybe, alone), = exact.split_repeats(hashed, 4040)
    n = maybe.count()
    assert 80 <= n < 80 + 4000 * 0.04 and n + alone.count() == 4040


def test_plan_runs_no_python(spark):
    plan = exact.groups(table(spark, sample()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "NestedLoop" not in plan
