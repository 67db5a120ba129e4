"""Each stage of the pipeline on odd rows (nulls, empty and long texts, repeats, clashing columns, no rows), and against brute force on a small table."""

import re

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as P
from fieldlens.llm.shared import written

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, whole int, epoch string, copies long, component_id string, score double, "
          "lang_pred string, text_key string, item_id long, domain string, n_tokens string, h string, fp string")
CLASH = ("k", 3, "e", 9, "c", 0.5, "l", "t", 4, "d", "n", "h", "f")
EN = "the quick brown fox and the lazy dog went over the old stone bridge to the market town in the morning"
DE = "der schnelle braune fuchs und der faule hund gingen am morgen ueber die alte steinerne bruecke in die stadt"
LONG = " ".join(f"{EN} number{i}" for i in range(1500))


def odd_rows():
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, " \t\n", None, None), (4, "one", "en", "s"), (5, LONG, "en", "s"), (6, EN, "en", "s"), (6, EN, "en", "s"), (None, DE, "de", None),
            (8, EN + " mail a.b@c.example now", "en", "s"), (9, "12 34 !!", None, "s"), (10, DE + " und so weiter bis zum abend", "de", "t"), (6, EN, "en", "other source")]
    rows += [(100 + i, f"{EN} extra{i * 7} words{i} here{i * 3} and there{i} again{i}", "en", "s") for i in range(40)] + [(200 + i, f"{DE} noch{i} mehr{i * 5} worte{i} hier{i}", "de", "t") for i in range(40)]
    return rows


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pipeline-sf"))
    spark.createDataFrame([(1, f"{DE} und so weiter bis zum abend"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(6, 1, 0), (6, 0, 0), (None, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *CLASH) for i, t, lang, s in rows], SCHEMA).repartition(parts)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_odd_rows_and_clashing_columns(spark, sf_dir, name, stage):
    docs = table(spark, odd_rows())
    out = written(stage(spark, docs, sf_dir), "test-stage")
    if name == "mix":
        own = {"domain", "epoch", "n_tokens"}  # columns that the stage adds itself
        assert [c for c in docs.columns if c not in own] == [c for c in out.columns if c not in own | {"tokens_taken"}]
        assert out.where("text is null or trim(text) = ''").count() == 0 and out.count() > 0
    else:
        assert out.dtypes == docs.dtypes
        rest = [c for c in docs.columns if c not in ("text", "n_chars")]
        assert out.select(*rest).exceptAll(docs.select(*rest)).count() == 0  # rows are kept whole
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
    # the same rows dealt otherwise give the same
    if name in ("near_duplicates", "decontamination", "mix"):
        assert values(stage(spark, table(spark, odd_rows()[::-1], 7), sf_dir)) == values(out)


def test_language_id_keeps_clean_rows(spark, sf_dir):
    out = {(r.doc_id, r.text) for r in P.language_id(spark, table(spark, odd_rows()), sf_dir).collect()}
    kept = {t for _, t in out}
    assert None not in kept and "" not in kept and " \t\n" not in kept and "12 34 !!" not in kept
    assert {EN, DE, LONG} <= kept and all(i in {d for d, _ in out} for i in [*range(100, 140), *range(200, 240)])


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    rows = odd_rows()
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    seen, want = [], []
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                parent[top(a)] = top(b)
    for k in order:
        if top(k) not in seen:
            seen.append(top(k))
            want.append(rows[k][0])
    got = [r.doc_id for r in P.near_duplicates(spark, table(spark, rows), sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def shingles(text, n=5):
    words = re.sub(r"[\x20\x09-\x0D]+", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).split()
    return {" ".join(words[i:i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1)))}


def test_decontamination_equals_brute_force(spark, sf_dir):
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = [(i, t) for i, t, _, _ in odd_rows() if not any(s and len(s & shingles(t)) >= 0.8 * len(s) for s in items)]
    got = [(r.doc_id, r.text) for r in P.decontamination(spark, table(spark, odd_rows()), sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) < len(odd_rows())


def test_personal_data_goes_and_rows_stay(spark, sf_dir):
    out = P.personal_data(spark, table(spark, odd_rows()), sf_dir).collect()
    assert len(out) == len(odd_rows())
    by_id = {r.doc_id: r for r in out}
    assert by_id[8].text == EN + " mail [EMAIL] now" and by_id[8].n_chars == len(by_id[8].text)
    assert by_id[1].text is None and by_id[1].n_chars is None and by_id[100].text == next(t for i, t, _, _ in odd_rows() if i == 100)


def test_mix_takes_each_document_by_its_tokens(spark, sf_dir):
    out = P.mix(spark, table(spark, odd_rows()), sf_dir)
    rows = out.collect()
    count = {}
    for i, t, _, _ in odd_rows():
        count[i] = len((t or "").split())
    assert all(int(r.n_tokens) == count[r.doc_id] and 0 < r.tokens_taken <= count[r.doc_id] for r in rows)
    assert len({(r.doc_id, r.text, r.source, r.epoch) for r in rows}) == len(rows)  # repeated rows count once
    whole = {(r.doc_id, r.source) for r in rows}
    assert {(6, "s"), (6, "other source")} <= whole  # another source is another document
