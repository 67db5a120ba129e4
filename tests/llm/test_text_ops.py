"""Language ID, decontamination, near duplicates, personal data and language-model scores on small tables."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldlens.llm import crf, decontaminate, gru, langid, pii, simhash
from fieldlens.llm.queries import _fold
from fieldlens.llm.shingles import shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, spans string, row string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def table(spark, texts, langs=None):
    rows = [(i if i >= 0 else None, t, (langs or {}).get(i, "en"), None, None, "x", "y", "z", "r") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, LONG), (6, "the same words again"), (6, "the same words again"), (-1, "no id here at all"), (7, "7 8 9 !!")]


# -- SimHash -------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(fps))]


def test_fingerprints_match_the_definition():
    for text in [None, "", "A b", "One two THREE four", "ÄÖ ü x y z z z", "a " * 300, LONG[:5000]]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_xxhash_is_the_same_hash(spark):
    assert spark.sql("select xxhash64('ab cd ef')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"ab cd ef", 42)


def test_near_duplicates_edge_rows(spark):
    rows = simhash.near_duplicates(table(spark, EDGE)).collect()
    assert len(rows) == len(EDGE)
    by = {(r.doc_id, r.text_key): r for r in rows}
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}  # fingerprint zero links like any other
    assert len(by) == len(EDGE) - 1
    assert simhash.near_duplicates(table(spark, EDGE).limit(0)).collect() == []


def test_near_duplicates_equal_brute_force(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [plain_fingerprint(t) for _, t in texts]
    comps = plain_components([d for d, _ in texts], fps, 2)
    assert all(got[d].fp % (1 << 64) == fp and got[d].component_id == c for (d, _), fp, c in zip(texts, fps, comps, strict=True))


@pytest.mark.parametrize("bits,segments", [(1, 3), (2, 4), (2, 6), (3, 5)])
def test_links_of_dense_groups_equal_brute_force(spark, bits, segments):
    rng = np.random.default_rng(1)
    centre = [int(x) for x in rng.integers(0, 1 << 63, 4)]
    fps = {c ^ sum(1 << int(b) for b in rng.integers(0, 64, int(rng.integers(0, 4)))) for c in centre for _ in range(90)} | {0, (1 << 64) - 1}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    plain = plain_components(signed, [f % (1 << 64) for f in signed], bits)
    for limit in (2, 10_000):  # both ways to link a group
        from fieldlens.llm.graph import components
        got = {r.node: r.root for r in components(simhash.links(frame, bits, segments, limit)).collect()}
        parts = Counter(plain)
        groups = {}
        for f, c in zip(signed, plain, strict=True):
            groups.setdefault(c, set()).add(got.get(f, f))
            assert (f in got) == (parts[c] > 1)
        assert all(len(roots) == 1 for roots in groups.values()) and len({next(iter(r)) for r in groups.values()}) == len(groups)


def test_pigeonring_keeps_every_close_pair(spark):
    rng = np.random.default_rng(2)
    xs = [0] + [sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in (1, 2) for _ in range(200)]
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in xs], "x long")
    assert frame.where(~simhash.in_ring(F.col("x"), 2, 4)).count() == 0


def test_keep_one_keeps_one_row_of_each_group(spark):
    docs = table(spark, EDGE)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 4), (False, 5), (False, 6), (False, 7), (True, 0)]


# -- decontamination -----------------------------------------------------------------------------------------

def plain_shingles(text, n=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)} or ({" ".join(w)} if w else set())


def test_shingle_texts_and_counts():
    texts = [None, "a b", "A b c d e f", "", "x  y\nz x y z x y z"]
    s = shingles(texts, 5)
    for i, t in enumerate(texts):
        own = {s.text_of(i, r) for r in range(s.first[i], s.first[i] + s.count[i])}
        assert own == plain_shingles(t)
    assert len(set(s.hashes.tolist())) == len({g for t in texts for g in plain_shingles(t)})


def test_contamination_equals_brute_force(spark, root):
    docs, items = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): round(r.containment, 9) for r in decontaminate.contamination(docs, items).collect()}
    want = {}
    item_sets = [(r.item_id, plain_shingles(r.text)) for r in items.collect()]
    for d in docs.select("doc_id", "text").collect():
        own = plain_shingles(d.text)
        for i, s in item_sets:
            if s and len(s & own) >= 0.8 * len(s):
                want[d.doc_id, i] = round(len(s & own) / len(s), 9)
    assert got == want


def test_contamination_finds_short_items_in_long_texts(spark):
    words = LONG.split()
    items = {1: "alpha beta gamma delta epsilon", 2: " ".join(f"q{i}" for i in range(60)), 3: "tiny item", 4: None, 5: "", 6: "go " * 40}
    changed = [*items[2].split()[:30], "other", *items[2].split()[31:]]
    texts = [(10, " ".join(words[:20_001] + items[1].split() + words[:777])), (11, " ".join(words[:9_999] + changed + words)), (12, "Tiny  ITEM"), (13, "a tiny item"), (14, "x " + "go " * 39 + "y"), (15, None)]
    frame = spark.createDataFrame([(k, v, "clash") for k, v in items.items()] + [(1, items[1], "again")], "item_id long, text string, key string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(table(spark, texts + EDGE), frame).collect()}
    assert got == {(10, 1), (11, 2), (12, 3), (14, 6)}
    clean = decontaminate.without_contaminated(table(spark, texts + EDGE), frame)
    assert {r.doc_id for r in clean.collect()} == {13, 15, None, 1, 2, 3, 4, 5, 6, 7} and clean.count() == len(EDGE) + 2
    assert decontaminate.contamination(table(spark, texts), frame.limit(0)).count() == 0
    assert decontaminate.contamination(table(spark, texts).limit(0), frame).count() == 0


# -- language ID ---------------------------------------------------------------------------------------------

EN, DE = "the house and the garden of this town were there when they came".split(), "das haus und der garten dieser stadt waren dort als sie kamen".split()


def test_contamination_finds_repetitive_items(spark):
    """Whole copies of items that repeat a few shingles over and over, inside other text."""
    items = {i: f"r{i} " * 1004 if i % 2 else f"p{i} q{i} s{i} " * 200 for i in range(30)}
    docs = table(spark, [(i, " ".join(f"a{i}x{j}" for j in range(500)) + f" {t} " + " ".join(f"b{i}x{j}" for j in range(700))) for i, t in items.items()])
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.containment) for r in decontaminate.contamination(docs, bench).collect())
    assert got == [(i, i, 1.0) for i in items]


def mixed_docs(spark, n=40):
    rng = np.random.default_rng(0)
    texts, langs = [], {}
    for i in range(n):
        langs[i] = "en" if i % 2 else "de"
        texts.append((i, " ".join(rng.choice(EN if i % 2 else DE, 30))))
    return table(spark, texts, langs)


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(0)
    em, steps, start = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    want = np.zeros((4, 3))
    best = (-1e9, None)
    for path in np.ndindex(3, 3, 3, 3):
        s = start[path[0]] + sum(em[t, y] for t, y in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:], strict=False))
        best = max(best, (s, path))
        for t, y in enumerate(path):
            want[t, y] += math.exp(s)
    want /= want.sum(axis=1, keepdims=True)
    both = np.concatenate([em, em[:2]])
    assert np.allclose(crf.forward_backward(both, np.array([0, 4]), np.array([4, 2]), steps, start)[:4], want)
    assert tuple(crf.viterbi(em[None], steps, start)[0]) == best[1]


def test_slopes_are_the_derivative_of_the_likelihood():
    rng = np.random.default_rng(0)
    em, steps, start, gold = rng.normal(size=(2, 5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3), rng.integers(0, 3, (2, 5))

    def loss():
        total = 0.0
        for e, y in zip(em, gold, strict=True):
            a = start + e[0]
            for t in range(1, 5):
                a = np.log(np.exp(a[:, None] + steps).sum(axis=0)) + e[t]
            total += np.log(np.exp(a).sum()) - start[y[0]] - e[range(5), y].sum() - sum(steps[p, q] for p, q in zip(y, y[1:], strict=False))
        return total

    slope, pairs, starts = crf.slopes(em, gold, steps, start)
    for arr, grad in ((em, slope), (steps, pairs), (start, starts)):
        flat, g = arr.reshape(-1), grad.reshape(-1)
        for i in range(0, len(flat), 3):
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            down = loss()
            flat[i] += 1e-5
            assert abs((up - down) / 2e-5 - g[i]) < 1e-4


def test_language_id_labels_and_edges(spark):
    docs = mixed_docs(spark)
    model = langid.train(docs, F.lit(True))
    more = table(spark, [*EDGE, (20, " ".join(EN)), (21, " ".join(DE))])
    got = {r.doc_id: r for r in langid.predict(more, model, ["doc_id", "source"]).collect()}
    assert got[20].lang_pred == "en" and got[21].lang_pred == "de"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 7))
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5].n_words == 30_000
    owner, post = langid.Labeller(model).posteriors([" ".join(EN + DE)])
    labels = [model.labels[i] for i in post.argmax(axis=1)]
    assert labels[:len(EN) - 1] == ["en"] * (len(EN) - 1) and labels[len(EN) + 1:] == ["de"] * (len(DE) - 1)
    kept = langid.recognised(more.withColumn("score", F.lit(1)).withColumn("lang_pred", F.lit("?")), model)
    assert "score" in kept.columns and not {1, 2, 3, 7} & {r.doc_id for r in kept.collect()}


def test_language_id_without_labels_or_rows(spark):
    docs = mixed_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert langid.train(docs, F.lit(True)) is None
    assert {r.lang_pred for r in langid.predict(docs, None, ["doc_id"]).collect()} == {"und"}
    assert langid.train(docs.limit(0), F.lit(True)) is None


def test_blocks_agree_with_one_long_chain(spark):
    model = langid.train(mixed_docs(spark), F.lit(True))
    words = list(np.random.default_rng(3).choice(EN + DE, 1500))
    _, post = langid.Labeller(model).posteriors([" ".join(words)])
    em = model.emissions([langid.core(w.encode()) for w in words])
    whole = crf.forward_backward(em, np.array([0]), np.array([1500]), model.steps, model.start)
    assert np.abs(post - whole).max() < 1e-6


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, ~_fold("doc_id", 4, 2))
    held = langid.predict(docs.where(_fold("doc_id", 4, 2)), model, ["lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_every_character_of_a_text_without_spaces_counts():
    rng = np.random.default_rng(1)
    line = lambda first, n: "".join(chr(first + i) for i in rng.integers(0, 60, n))
    model = langid.fit([(lang, line(first, 900)) for lang, first in (("aa", 0x4E00), ("bb", 0x3040)) for _ in range(20)], [], sequences=200, rounds=4)
    text = line(0x4E00, 20) + line(0x3040, 400)
    assert b"".join(langid.elements(text)).decode() == text and max(map(len, langid.elements(text))) <= langid.PIECE
    (lang, score, n, switches), = langid.Labeller(model).label([text])
    assert lang == "bb" and 0.85 < score < 1 and n == len(langid.elements(text)) and switches >= 1


# -- personal data -------------------------------------------------------------------------------------------

PLAIN = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in p.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (16 <= len(digits) <= 19 and pii._luhn(digits)):
                continue
            if k == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(0)
    texts = ["a@b.c@d.ef", "x@@y.z", "a.b+c@d-e.f-g.h.", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.2.3 001.2.3.4", "4111 1111 1111 1111", "4111-1111  11111111", "+1 (988) 555-2485, +1-2", "++12345678", "ü@ä.de é1.1.1.1", "@a.b", "a@b"]
    texts += ["".join(rng.choice(list("ab1.2@+- (9"), 60)) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t


def test_base_spans_are_linear_on_long_runs():
    assert pii.base_spans("1" * 200_000 + "@" + "a" * 200_000) == []


def test_personal_data_rows(spark):
    docs = table(spark, [*EDGE, (30, "write to bob.s@mail.org or +1 (988) 555-2485 now"), (31, "LÖNG 42.144.35.254 " + LONG + " 4041894974608795?")])
    net = pii.fit(docs)
    rows = pii.find(docs, net, ["doc_id"]).collect()
    assert len(rows) == len(EDGE) + 2
    got = {r.doc_id: r for r in rows}
    assert (got[30].n_email, got[30].n_phone, got[31].n_ip) == (1, 1, 1) and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        base = plain_spans(text[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(pii.spans_text(base).encode()).hexdigest()
        assert set(pii.spans_text(base).split(",")) <= set(r.spans.split(","))
    clean = {r.doc_id: r.text for r in pii.redact(docs, net).collect()}
    assert clean[30] == "write to [EMAIL] or [PHONE] now" and clean[1] is None and clean[5] == LONG
    assert pii.find(docs.limit(0), net, ["doc_id"]).count() == 0
    assert pii.redact(docs, net).columns == docs.columns


def test_windows_left_out_could_not_give_spans():
    rng = np.random.default_rng(4)
    text = " ".join(["some plain words without anything"] * 40) + " call (988) 555-2485 today " + " ".join(["and so on"] * 60) + " mail me@x.org"
    net = pii.train([text[i:i + 300] for i in rng.integers(0, 1500, 20)], rounds=2)
    every = [s for s in pii.network_spans([text], net, every=True)[0] if re.search("[0-9@]", text[s[1][1]:s[1][2]])]
    some = [s for s in pii.network_spans([text], net)[0] if re.search("[0-9@]", text[s[1][1]:s[1][2]])]
    assert [s for _, s in every] == [s for _, s in some]


def test_network_finds_forms_that_the_patterns_miss():
    rng = np.random.default_rng(9)
    plain = "the words of a text without numbers that goes on and on for some time so that windows are full " * 3
    net = pii.train([plain])
    hit = total = false = 0
    for i in range(60):
        piece = f"({rng.integers(200, 999)}) {rng.integers(200, 999)}-{rng.integers(1000, 9999)}"
        text = plain[:100 + i] + " " + piece + " " + plain[:150]
        a = 101 + i
        found = pii.all_spans([text], net)[0][1]
        total += 1
        hit += (3, a, a + len(piece)) in found
        false += sum(s != (3, a, a + len(piece)) for s in found)
    assert hit >= 0.8 * total and false <= 0.1 * total


def test_backward_is_the_derivative():
    rng = np.random.default_rng(0)
    net = pii._new(rng)
    x, y = rng.integers(1, 60, (2, 7)).astype(np.int16), rng.integers(0, 9, (2, 7))

    def loss():
        em = net.emissions(x)
        total = 0.0
        for e, g in zip(em, y, strict=True):
            a = net.start + e[0]
            for t in range(1, 7):
                a = np.log(np.exp(a[:, None] + net.steps).sum(axis=0)) + e[t]
            total += np.log(np.exp(a).sum()) - net.start[g[0]] - e[range(7), g].sum() - sum(net.steps[p, q] for p, q in zip(g, g[1:], strict=False))
        return total

    kept = []
    slope, pairs, starts = crf.slopes(net.emissions(x, kept), y, net.steps, net.start)
    for p, g in zip(net.params(), [*net.backward(x, slope, kept), pairs, starts], strict=True):
        flat = p.reshape(-1)
        used = np.flatnonzero(np.abs(g.reshape(-1)) > 1e-3)[:6]
        for i in used:
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            down = loss()
            flat[i] += 1e-5
            assert abs((up - down) / 2e-5 - g.reshape(-1)[i]) < 1e-3


# -- language model ------------------------------------------------------------------------------------------

def plain_base(rows, held):
    c = Counter()
    for d, t in rows:
        if held(d) is False:
            c.update(gru.words_of(t))
            c[b""] += 1
    n, v = sum(c.values()), len(c)
    out = {}
    for d, t in rows:
        ws = [*gru.words_of(t), b""]
        out[d] = (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
    return out


def test_lm_scores_on_a_small_table(spark):
    import zlib
    docs = table(spark, [*EDGE[:5], (6, "the same words again"), (8, "unseen tokens here"), (9, "the cat sat on the mat"), (12, "The CAT sat")])
    got = {r.doc_id: r for r in gru.score(docs, _fold("doc_id", 5, 1)).collect()}
    fold = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 5 == 1
    want = plain_base([(r.doc_id, r.text) for r in docs.collect()], fold)
    for d, (n, known, total, base) in want.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, bool(fold(d)))
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert gru.score(docs.limit(0), _fold("doc_id", 5, 1)).count() == 0


def test_lm_without_training_rows(spark):
    rows = gru.score(table(spark, EDGE), F.lit(True)).collect()
    assert len(rows) == len(EDGE) and all(r.score == 0 and r.train_tokens == 0 for r in rows)


def small_vocabulary():
    head = {"": 20, "a": 50, "b": 30, "c": 10, "d": 5, "e": 5}
    rare_n, rare_v = np.zeros(gru.RARE), np.zeros(gru.RARE)
    rare_n[gru.rare_class("e")] += 5
    rare_v[gru.rare_class("e")] += 1
    return gru.Vocabulary(["a", "b", "", "c", "d"], head, 120, 6, rare_n, rare_v)


def test_lm_probabilities_sum_to_one_and_windows_carry_state():
    v = small_vocabulary()
    net = gru.fit(v, [("a b a b c a b a b d", True)] * 30, rounds=1)
    h = np.random.default_rng(0).normal(size=(1, gru.HIDDEN)).astype(np.float32)
    total = 0.0
    for i in range(len(v.words)):
        total += math.exp(net.log_probabilities(h, v.classes_of(np.array([i])), np.array([i % v.size]))[0])
    for k in range(gru.RARE):
        total += math.exp(net.log_probabilities(h, np.array([v.own + k]), np.array([-1]))[0])
    assert abs(total - 1) < 1e-4
    text = " ".join(["a b c e d"] * 90)  # longer than a window
    ids = np.array([v.id_of(w) for w in [*text.split(), ""]])
    state, prev, want = np.zeros((1, gru.HIDDEN), np.float32), np.array([len(v.words) + gru.RARE]), 0.0
    for i in ids:
        state = net.step(prev, state)[0]
        want += net.log_probabilities(state, v.classes_of(np.array([i])), np.array([i % v.size if i < len(v.words) else -1]))[0]
        prev = np.array([i])
    got = gru._network_scores(v, net, [ids[:3], ids, ids[:1]])[1]
    assert abs(got - want / math.log(10)) < 1e-3 * abs(got)


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in gru.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), _fold("doc_id", 5, 1)).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_learns_from_whole_texts_and_samples_distinct_ones(spark):
    """A pattern that only comes after the excerpts' characters is learned; copies do not fill the sample."""
    head = lambda i: " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(800))
    assert all(len(head(i)) > gru.FIT_CHARS for i in range(80))
    rows = [(i, head(i) + " ping pong" * 400) for i in range(80)] + [(1000, "ping pong " * 300)]
    frame = table(spark, rows).repartition(4)
    got = {r.doc_id: r for r in gru.score(frame, F.col("doc_id") == 1000).collect()}[1000]
    # the base gives each word its share, a third: half of the tokens are sure once the other is seen
    assert (got.score - got.base_score) / got.n_tokens > 0.2
    copies = table(spark, [(i, "copy " * 20) for i in range(3000)] + [(5000 + i, f"own {i}") for i in range(50)])
    assert len(gru._excerpts(copies, "text")) == 51
