"""License scans: MinHash over overlapping windows retrieves templates, exact shingle containment verifies them.

DataFrame operations only. A text's five-word shingles are hashed; they lie in blocks of ``BLOCK`` shingles, and a
template's class is the window that fits it: three half-blocks, each half the class's upper bound long, so that a run of the template's length
lies whole in some window. A window retrieves a template if they agree in one of the ``BANDS`` one-row bands, that is in the
least hash under one of the orders ``hash xor seed``. With the threshold of 0.8 a match then goes unseen with a probability of about
``(1 - jaccard) ** BANDS``, under 1e-5 for every template (``miss_bound`` tells it for each). The orders are not independent, which shows
with few shingles; a template of under ``LEAST_SHINGLES``, or one that is too short for its window, is in the class of single shingles, where nothing is missed.

The least hash of a window is that of one of its blocks. So a window can only retrieve something if one of its blocks has
a least hash that some template has in that band; blocks without are left out before windows are formed, which loses nothing.

Defined cases: null or empty text has no match; a text of fewer than five words is one shingle; a null doc_id stays; rows that repeat
are one; templates need five words; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.shared import text_key

WORDS, BLOCK, BANDS = 5, 4, 32
#: Half-blocks of the classes, in shingles and multiples of ``BLOCK``; the first stands for single shingles.
HALVES = (0, 4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512)
#: Templates of fewer shingles are found by single shingles.
LEAST_SHINGLES = 8
#: Templates whose window would share less with them are found by single shingles.
LEAST_JACCARD = 0.3
SEPARATORS = r"[^a-z0-9ß-ɏ]+"

# License notices as they are commonly written.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
                   'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
                   "See the License for the specific language governing permissions and limitations under the License."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": ["Released under the MIT License.",
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
}


def _seeds() -> list[int]:
    """Seeds whose leading bits spread over the range, as signed longs."""
    out, x = [], 0x2545F4914F6CDD1D
    for k in range(BANDS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        top = (k * (1 << 64) // BANDS + (x >> 6)) % (1 << 64)
        out.append(top - (1 << 64) if top >> 63 else top)
    return out


SEEDS = _seeds()


def words_in(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def half_of(n: int, share: float = 0.8) -> int:
    """Half-block of a template of ``n`` shingles: half of the least class that holds it; 0 where the window would be too wide for it."""
    half = next(h for h in HALVES if 2 * h >= n)
    return 0 if n < LEAST_SHINGLES or _jaccard(n, half, share) < LEAST_JACCARD else half


def _jaccard(n: int, half: int, share: float) -> float:
    need = -(-n * share // 1)
    return need / (3 * half + n - need)


def miss_bound(n: int, share: float = 0.8) -> float:
    """Probability that a window with ``share`` of a template's ``n`` shingles does not retrieve it."""
    half = half_of(n, share)
    return (1 - _jaccard(n, half, share)) ** BANDS if half else 0.0


def _shingles(words: Column) -> tuple[Column, Column]:
    """(number of shingles, positions from 0)."""
    n = F.greatest(F.size(words) - (WORDS - 1), F.least(F.size(words), F.lit(1)))
    return n, F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))


def _hashes(words: Column) -> Column:
    return F.transform(_shingles(words)[1], lambda i: F.xxhash64(F.slice(words, i + 1, WORDS)))


def _texts(words: Column) -> Column:
    return F.array_distinct(F.transform(_shingles(words)[1], lambda i: F.array_join(F.slice(words, i + 1, WORDS), " ")))


def _least(hashes: Column) -> Column:
    """The least hash under each band's order."""
    return F.transform(F.array(*map(F.lit, SEEDS)), lambda s: F.array_min(F.transform(hashes, lambda x: x.bitwiseXOR(s))))


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """``(license, variant, half, n, shingles, hashes, least)`` of fixed texts; a row for each."""
    flat = [(name, i, text, len(set(zip(*[words_in(text)[k:] for k in range(WORDS)], strict=False)))) for name, texts in sorted(templates.items()) for i, text in enumerate(texts)]
    if not all(n for *_, n in flat):
        raise ValueError("a template needs at least five words")
    rows = spark.createDataFrame([(name, i, text, half_of(len(words_in(text)) - WORDS + 1), n) for name, i, text, n in flat], "license string, variant int, text string, half int, n int")
    words = rows.withColumn("words", split_words(F.col("text")))
    return words.select("license", "variant", "half", "n", _texts(F.col("words")).alias("shingles"), _hashes(F.col("words")).alias("hashes")).withColumn("least", _least(F.col("hashes")))


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, share: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_key, license, n_shingles, containment, first_word)``: the best match of each license in each document."""
    table = template_table(docs.sparkSession, templates)
    known = table.collect()  # as many rows as there are fixed texts
    keys = [sorted({r["least"][k] for r in known if r["half"]}) for k in range(BANDS)]  # by band
    single = sorted({x for r in known if not r["half"] for x in r["hashes"]})
    halves = sorted({r["half"] for r in known if r["half"]})

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), split_words(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("words"))
    hashed = rows.select("doc_id", "text_key", "words", _hashes(F.col("words")).alias("hashes"))
    n = F.size("hashes")
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / BLOCK).cast("int") - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    # a block as a struct of its hashes, so that a band's least hash is one flat expression
    held = F.transform(blocks, lambda j: F.struct(j.alias("j"), *[F.get(F.col("hashes"), j * BLOCK + i).alias(f"h{i}") for i in range(BLOCK)]))

    def may_retrieve(b: Column) -> Column:
        found = F.lit(False)
        for seed, values in zip(SEEDS, keys, strict=True):
            found = found | F.least(*[b[f"h{i}"].bitwiseXOR(F.lit(seed)) for i in range(BLOCK)]).isin(values)
        return found

    some = F.transform(F.filter(held, may_retrieve), lambda b: b["j"]) if halves else F.expr("cast(array() as array<int>)")
    alone = F.filter(_shingles(F.col("words"))[1], lambda i: F.get(F.col("hashes"), i).isin(single)) if single else F.expr("cast(array() as array<int>)")

    def windows(j: Column) -> Column:
        """The windows, as (half, start), that block ``j`` lies in."""
        out = []
        for h in halves:
            block = F.floor(j * BLOCK / h).cast("int")
            out += [F.struct(F.lit(h).alias("half"), (F.greatest(block - back, F.lit(0)) * h).alias("start")) for back in range(3)]
        return F.array(*out)

    wide = F.flatten(F.transform(some, windows)) if halves else F.expr("cast(array() as array<struct<half:int,start:int>>)")
    narrow = F.transform(alone, lambda i: F.struct(F.lit(0).alias("half"), i.alias("start")))
    # explode_outer and a test after it, so that the windows are worked out once
    found = hashed.select("doc_id", "text_key", "words", "hashes", F.explode_outer(F.array_distinct(F.concat(wide, narrow))).alias("w")).where("w is not null")
    # a window of single shingles reaches a template's length to both sides
    widest = max([r["n"] for r in known if not r["half"]], default=1)
    start = F.when(F.col("w.half") > 0, F.col("w.start")).otherwise(F.greatest(F.col("w.start") - (widest - 1), F.lit(0)))
    length = F.when(F.col("w.half") > 0, 3 * F.col("w.half")).otherwise(2 * widest - 1)
    cut = found.select("doc_id", "text_key", F.col("w.half").alias("half"), start.alias("start"), F.slice("words", start + 1, length + WORDS - 1).alias("words"), F.slice("hashes", start + 1, length).alias("hashes"))
    fixed = F.broadcast(table.select("license", "n", "shingles", F.col("half").alias("h"), F.col("hashes").alias("template_hashes"), F.col("least").alias("template_least")))
    least = _least(F.col("hashes"))
    agree = F.when(F.col("half") > 0, F.exists(F.arrays_zip(least.alias("a"), F.col("template_least").alias("b")), lambda x: x["a"] == x["b"])).otherwise(F.arrays_overlap("hashes", "template_hashes"))
    retrieved = cut.join(fixed, F.col("half") == F.col("h")).where(agree)
    sure = retrieved.select("doc_id", "text_key", "license", "n", "start", "words", "shingles", F.size(F.array_intersect(_texts(F.col("words")), F.col("shingles"))).alias("found")).where(F.col("found") >= share * F.col("n") - 1e-9)
    place = F.array_min(F.filter(_shingles(F.col("words"))[1], lambda i: F.array_contains(F.col("shingles"), F.array_join(F.slice(F.col("words"), i + 1, WORDS), " "))))
    best = sure.select("doc_id", "text_key", "license", F.struct((F.col("found") / F.col("n")).alias("containment"), F.col("n").alias("n"), (-(F.col("start") + place)).alias("place")).alias("m"))
    return (best.groupBy("doc_id", "text_key", "license").agg(F.max("m").alias("m"))
            .select("doc_id", "text_key", "license", F.col("m.n").cast("long").alias("n_shingles"), F.col("m.containment").alias("containment"), (-F.col("m.place")).cast("long").alias("first_word")))
