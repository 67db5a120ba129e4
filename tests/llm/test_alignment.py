"""Token alignment against a plain walk over the tokenizers' own output, on odd texts, with and without broadcast pairs."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from fieldlens.llm import alignment as al

A_FILE, B_FILE = al.public_file("byte_bpe_50k.json"), al.public_file("piece_bpe_32k.model")
TEXTS = [None, "", " ", "Hello world", "  two  spaces\n\nlines\t", "naïve café Ωmega 漢字かな 😀👩‍👩‍👧", "<s> </s> <unk> <0x41> <|endoftext|>", "1234567890 3.14159 a1b2c3",
         "a▁b", "x" * 3000, "-" * 700 + "=" * 333, "ab\x00c ﻿", "don't we're I'll", "　   x", "é é", "Hello world", "Hello world", "𞤀ꟲᲀ ǆ", "0" * 999, "\n" * 50 + " " * 77 + "z"]


def plain(texts):
    """Definition: the tokenizers' ids, byte ends, groups by common ends, all products."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A_FILE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    spans_a = al.ByteLevel(A_FILE).entries.spans
    docs = []
    for t in texts:
        groups = []
        if t:
            a, b = first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)
            bytes_b = [bytes([int(second.id_to_piece(k)[3:5], 16)]) if second.is_byte(k) else second.id_to_piece(k).replace("▁", " ").encode() for k in b]
            whole = (" " + t).encode()
            if b"".join(spans_a[k] for k in a) == whole == b"".join(bytes_b):
                ea, eb = np.cumsum([len(spans_a[k]) for k in a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                common = sorted(set(ea) & set(eb))
                pa_, pb = 0, 0
                for end in common:
                    ga, gb = [], []
                    while pa_ < len(ea) and ea[pa_] <= end:
                        ga.append(a[pa_])
                        pa_ += 1
                    while pb < len(eb) and eb[pb] <= end:
                        gb.append(b[pb])
                        pb += 1
                    groups.append((ga, gb))
        docs.append(groups)
    held = collections.Counter()
    links = []
    for groups in docs:
        c = collections.Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        links.append(c)
        held.update(c.keys())
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for i, (groups, c) in enumerate(zip(docs, links)):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def corpus():
    rng = random.Random(3)
    words = ["alpha", "Betöne", "naïf", "12", "…", "日本語", "'s", "Zürich", "unbelievably", "🙂", "--", "qwxz"]
    return TEXTS + ["".join(rng.choice(words) + rng.choice([" ", "", "  ", "\n"]) for _ in range(rng.randrange(1, 400))) for _ in range(25)] + [" ".join(rng.choice(words) for _ in range(9000))]


@pytest.mark.parametrize("head", [1, 64, al.HEAD])
def test_equals_the_definition(spark, head):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(texts)], "doc_id long, text string, pairs string, n_a int").repartition(3)
    got = sorted(tuple(r) for r in al.align(docs, A_FILE, B_FILE, head=head).collect())
    assert got == plain(texts)


def test_null_ids_repeats_and_an_empty_table(spark):
    docs = spark.createDataFrame([(None, "Hello world"), (7, "Hello world"), (7, "Hello world"), (8, None)], "doc_id long, text string")
    rows = al.align(docs, A_FILE, B_FILE).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in rows) == [(0, 2, 6), (7, 2, 6), (7, 2, 6), (8, 0, 0)]
    assert al.align(docs.limit(0), A_FILE, B_FILE).count() == 0


def test_entries_give_the_tokenizers_ids():
    first, texts = al.ByteLevel(A_FILE), [t for t in corpus() if t]
    assert first.quick is not None
    for t in texts:
        assert first.encode(t).tolist() == first.whole.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("lane", [1, 3, 64, 10**6])
def test_lanes_and_blocks_change_nothing(lane):
    rng = np.random.default_rng(lane)
    a_ends, b_ends = [], []
    for n in (0, 1, 7, 300, 2000):
        ends = [np.append(np.sort(rng.choice(np.arange(1, n), rng.integers(0, n), replace=False)), n) if n else np.zeros(0, np.int64) for _ in range(2)]
        a_ends.append(ends[0])
        b_ends.append(ends[1])
    m = al.merge(a_ends, b_ends, lane)
    start = np.cumsum([0, *map(len, a_ends)])
    want = [start[d] + np.flatnonzero(np.isin(a, b)) for d, (a, b) in enumerate(zip(a_ends, b_ends))]
    assert m.a_cut.tolist() == np.concatenate(want).tolist()
    n_a = [len(x) for x in a_ends]
    a, b = rng.integers(0, 5, sum(n_a)), rng.integers(0, 5, sum(map(len, b_ends)))
    doc = np.repeat(np.arange(5), n_a)
    whole = al.linked(m, a, b, doc)
    for block in (1, 5, 100):
        small = al.linked(m, a, b, doc, block)
        assert small[0].tolist() == whole[0].tolist() and small[1].tolist() == whole[1].tolist()
    if lane == 64:
        assert m.steps < 130  # not the length of the longest document


def test_a_very_long_word_is_quick():
    first, second = al.ByteLevel(A_FILE), al.Pieces(B_FILE)
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    batch = al._align_texts([(0, 1, text)], first, second)
    assert isinstance(batch, pa.RecordBatch) and batch.column("n_a")[0].as_py() > 50_000
