"""License scans, nearest neighbours, wrappers, revisits, mixing and the pipeline on small tables."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import ann, licenses, mixing, warc, wrappers
from fieldlens.llm.queries import MIX_LEVELS, MIX_WEIGHTS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, license string, half string"
FILL = " ".join(f"filler{i % 613}" for i in range(20_000))


def table(spark, texts):
    return spark.createDataFrame([(i, t, None if i == 3 else "en", "s" if i % 2 else None, None, "x", "y") for i, t in texts], SCHEMA)


# -- licenses ------------------------------------------------------------------------------------------------

def test_bands_make_misses_rare():
    for texts in licenses.TEMPLATES.values():
        for t in texts:
            assert licenses.miss_bound(len(licenses.words_in(t)) - 4) <= 1.1e-5


def test_license_scan_finds_notices_anywhere(spark):
    mit, long_mit = licenses.TEMPLATES["MIT"]
    words = licenses.words_in(long_mit)
    changed = " ".join([*words[:20], "other", *words[21:]])
    half = " ".join(words[:30])
    texts = [(1, None), (2, ""), (3, "one two"), (4, f"{FILL} {mit} {FILL}"), (5, f"{FILL[:9001]} {changed}"), (6, half), (7, "RELEASED under\nthe  MIT license"), (7, "RELEASED under\nthe  MIT license"),
             (8, FILL), (9, " ".join(licenses.TEMPLATES["GPL-3.0"]))]
    rows = licenses.scan(table(spark, texts)).collect()
    got = {(r.doc_id, r.license): r for r in rows}
    assert {k for k in got} == {(4, "MIT"), (5, "MIT"), (7, "MIT"), (9, "GPL-3.0")} and len(rows) == 4
    assert got[4, "MIT"].first_word == 20_000 and got[4, "MIT"].n_shingles == 1
    assert 0.8 <= got[5, "MIT"].containment < 1 and got[9, "GPL-3.0"].containment == 1
    assert licenses.scan(table(spark, texts).limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(table(spark, texts), {"x": ["too short"]})


def test_license_plan_runs_no_python(spark):
    plan = licenses.scan(table(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


# -- nearest neighbours --------------------------------------------------------------------------------------

def unit_rows(rng, n, dim):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize("cosine", [0.2, 0.35, 0.6, 0.9])
def test_prefixes_of_close_vectors_agree_as_told(cosine):
    """The share of pairs that no tree holds under a prefix is what ``missed`` tells."""
    rng = np.random.default_rng(3)
    a, b = unit_rows(rng, 1500, 40), unit_rows(rng, 1500, 40)
    b -= (a * b).sum(axis=1)[:, None] * a
    b = cosine * a + np.sqrt(1 - cosine ** 2) * b / np.linalg.norm(b, axis=1)[:, None]
    one, two = ann.hash_strings(a), ann.hash_strings(b)
    for length in (4, 8, 12, 20):
        share = ((one >> (ann.BITS - length)) != (two >> (ann.BITS - length))).all(axis=1).mean()
        assert abs(share - ann.missed(np.array(cosine), length)) < 0.06
        assert abs(ann.missed(np.array(ann.settles(length)), length) - ann.MISS) < 1e-9


def test_trees_ascend_together_to_where_a_search_settles():
    """The rows scored are those that share the prefix of the stop in any tree, and no longer prefix would have been enough."""
    rng = np.random.default_rng(4)
    x, k = unit_rows(rng, 900, 32), 5
    q = np.concatenate([unit_rows(rng, 20, 32), x[:20] + 0.02 * rng.normal(size=(20, 32))])
    q /= np.linalg.norm(q, axis=1)[:, None]
    strings, asked = ann.hash_strings(x), ann.hash_strings(q)
    order = np.argsort(strings.T, axis=1, kind="stable")
    score, stop = ann._ascend(x, np.take_along_axis(strings.T, order, axis=1), order, q, asked, np.full(40, -1.5), [[]] * 40, k)
    for i in range(40):
        def held(length):
            return ((strings >> (ann.BITS - length)) == (asked[i] >> (ann.BITS - length))).any(axis=1)

        assert (np.isfinite(score[i]) == held(stop[i])).all() and np.allclose(score[i][held(stop[i])], x[held(stop[i])] @ q[i])
        assert np.sort(score[i])[-k] >= ann.settles(stop[i])
        if stop[i] < ann.BITS:
            longer = np.where(held(stop[i] + 1), x @ q[i], -np.inf)
            assert np.sort(longer)[-k] < ann.settles(stop[i] + 1)


def brute(ids, x, k):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_forest_recall_on_clusters_and_edge_rows(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 24))
    x = np.concatenate([c + 0.15 * rng.normal(size=(20, 24)) for c in centres])
    rows = [(i, [float(v) for v in row], "c") for i, row in enumerate(x)]
    extra = [(1000, rows[0][1], "copy of 0"), (1001, rows[0][1], "another"), (0, rows[0][1], "repeat"), (1002, None, "x"), (1003, [], "x"), (1004, [0.0] * 24, "x"), (1005, [None] + [1.0] * 23, "x"),
             (1006, [float("nan")] * 24, "x"), (1050, [float("inf")] + [1.0] * 23, "x"), (None, rows[5][1], "x"), (1007, [1.0, 2.0], "two"), (1100, [2.0, 1.0], "two"), (1150, [3.0], "alone")]
    frame = spark.createDataFrame(rows + extra, "vec_id long, embedding array<double>, entry string")
    got: dict[int, list] = {}
    for r in ann.nearest(frame, F.pmod(F.col("vec_id"), F.lit(50)) == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r.prefix))
    assert got[0][0][0] == 1000 and got[0][1][0] == 1001 and abs(got[0][0][1] - 1) < 1e-12
    assert got[1100] == [(1007, pytest.approx(0.8), 0)] and 1150 not in got and 1050 not in got and 1000 in got
    ids = np.array([*range(600), 1000, 1001])
    want = brute(ids, np.concatenate([x, x[:1], x[:1]]), 5)
    hits = sum(v in {a for a, *_ in got[q]} for q, vs in want.items() for v, _ in vs)
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert any(p > 0 for vs in got.values() for *_, p in vs)  # settled above the root
    assert ann.nearest(frame.limit(0), F.col("vec_id") >= 0).count() == 0


@pytest.mark.parametrize("block_rows", [ann.BLOCK_ROWS, 300])
def test_forest_recall_on_the_table(spark, monkeypatch, block_rows):
    """Nine tenths of the nearest rows, from searches that all settle above the root."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", block_rows)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in frame.collect() if r.embedding]
    want = brute(np.array([i for i, _ in data]), np.array([v for _, v in data], dtype=float), 5)
    got, effort = {}, {}
    for r in ann.nearest(frame, F.pmod(F.col("vec_id"), F.lit(50)) == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
        effort[r.query_id] = r.prefix, r.scored
    recall = sum(v in got[q] for q, vs in want.items() for v, _ in vs) / sum(map(len, want.values()))
    share = sum(n for _, n in effort.values()) / len(effort) / len(data)
    print(block_rows, "recall", recall, "share", share, sorted(p for p, _ in effort.values()))
    assert recall >= 0.9 and share < 0.7 and min(p for p, _ in effort.values()) > 0
    assert all(abs(got[q][v] - s) < 1e-9 for q, vs in want.items() for v, s in vs if v in got[q])


def test_close_neighbours_are_sought_in_few_blocks(spark, monkeypatch):
    """Clusters lie in few rows of the blocks that the forest names; what is found is what all blocks hold."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(5)
    x = np.concatenate([c + 0.01 * rng.normal(size=(20, 24)) for c in rng.normal(size=(40, 24))])
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(np.arange(800), x, 5)
    sent = []
    routes = ann._routes

    def counted(index, own):
        out = routes(index, own)
        sent.append((out.count(), own.count() * index.select("block").distinct().count()))
        return out

    monkeypatch.setattr(ann, "_routes", counted)
    rows = ann.nearest(frame, F.pmod(F.col("vec_id"), F.lit(50)) == 0).collect()
    got = {(r.query_id, r.vec_id) for r in rows}
    assert sum((q, v) in got for q, vs in want.items() for v, _ in vs) >= 0.95 * len(got)
    (used, most), = sent
    assert used < 0.3 * most


# -- wrappers ------------------------------------------------------------------------------------------------

def test_parse_closes_tags_as_browsers_do():
    items = wrappers.parse("<!DOCTYPE html><p>a<b>b<br>c<p>d &amp; &eacute;<ul><li>x<li>y</ul>tail<script>if (a<b) '</p>'</script><!-- <p>no -->")
    assert items == [["p", [["#", "ab c", 0]]], ["p", [["#", "d & é", 0]]], ["ul", [["li", [["#", "x", 0]]], ["li", [["#", "y", 0]]]]], ["#", "tail", 0]]
    assert wrappers.parse(None) == [] and wrappers.parse("a < b <3 <") == [["#", "a < b <3 <", 0]]


def test_alignment_makes_optional_and_repeated_items():
    one, two = (wrappers.wrapper_of(h) for h in ("<h1>t</h1><p>a</p><p>b</p><footer>f</footer>", "<h1>u</h1><table></table><p>c</p><footer>f</footer>"))
    assert wrappers.expression(wrappers.align(one, two)) == '<h1>#</> (<table></>)? (<p>#</>)+ <footer>"f"</>'
    assert wrappers.expression(wrappers.wrapper_of("<h2>a</h2><p>b</p><h2>c</h2><p>d</p>")) == "(<h2>#</> <p>#</>)+"


PAGE = ("<html><head><title>{t}</title><style>p{{}}</style></head><body><header>Site</header><nav><ul><li><a href=1>{t}</a></li></ul></nav><div class='cookie notice'>We use</div>"
        "<article><h1>{t}</h1><p>{a}</p><aside>see also</aside><form>name <input></form><p>{b} <a href=x>link</a></p><div id='comments'><p>first!</p></div></article><footer>(c) {t}</footer></body></html>")


def test_extraction_keeps_the_article_alone(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(t=f"t{i}", a=f"alpha &lt;{i}&gt;\n x", b="beta"), "u") for i in range(6)]
    plain = "<div id=top>menu one</div><div class=body><p>{0} long text of this page, all its own, goes here and on and on</p><p>more of {0} and more</p></div><div id=bottom>same words</div>"
    rows += [(100 + i, f"http://plain.example/{i}", plain.format(f"page{i}"), "u") for i in range(5)]
    rows += [(50, None, None, "u"), (51, "http://h.example/x", ""), (52, None, "<p>no host"), (53, "not a url", "<p>stray</p></div>"), (0, *rows[0][1:])]
    frame = spark.createDataFrame([(r + ("u",))[:4] for r in rows], "page_id long, url string, html string, text string")
    out = wrappers.extract(frame).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert all(got[i].text == f"t{i}\nalpha <{i}> x\nbeta link" for i in range(6))
    assert got[101].text == "page1 long text of this page, all its own, goes here and on and on\nmore of page1 and more"
    assert got[50].text == got[51].text == "" and got[52].text == "no host" and got[53].text == "stray"
    assert wrappers.extract(frame.limit(0)).count() == 0


def test_extraction_equals_the_article_of_every_page(spark, root):
    import html as entities
    pages = spark.read.parquet(f"{root}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in wrappers.extract(pages).collect():
        m = re.search(r"<article>(.*?)</article>", source[r.page_id] or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
        want = "\n".join(x for x in (" ".join(entities.unescape(re.sub("<[^>]+>", " ", p)).split()) for p in parts) if x)
        assert r.text == want


def pages_of(spark, pages):
    """Texts by number of (host, html) pairs."""
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    return [r.text for r in sorted(wrappers.extract(frame).collect(), key=lambda r: r.page_id)]


def test_templates_of_a_host_keep_their_texts(spark):
    """Pages with an article, a main element, a post or a product block, and one whose article has a menu alone, on one host."""
    shapes = ["<article><p>{0}</p></article>", "<main><p>{0}</p></main>", "<div class=post><p>{0}</p><p>{0} more</p></div>", "<div class=product><h2>{0}</h2><p>{0} price</p></div>", "<article><nav>go</nav></article><div class=post><p>{0}</p></div>"]
    pages = [("mixed.example", f"<body><nav>go</nav>{shapes[0 if i < 30 else i % 5].format(f'text number {i} of the page')}</body>") for i in range(60)]
    got = pages_of(spark, pages)
    assert all(text.startswith(f"text number {i} of the page") and "go" not in text for i, text in enumerate(got))


def test_every_word_of_a_class_counts(spark):
    page = ("<body><div class='col-md-4 col-sm-12 sidebar'><p>side {0}</p></div><div class='col-md-8 col-sm-12 col-xs-12 has-sidebar post'><p>body {0}</p></div>"
            "<div class='a b c d e' role=banner><p>top {0}</p></div></body>")
    assert pages_of(spark, [("grid.example", page.format(i)) for i in range(4)]) == [f"body {i}" for i in range(4)]
    assert wrappers.parse("<div class='a b c d one'></div>")[0][0] != wrappers.parse("<div class='a b c d two'></div>")[0][0]


def test_copies_and_long_leads_are_not_fixed_texts(spark):
    """The text does not depend on the number of copies, nor on paragraphs repeated within a page; bodies that differ after 200 characters differ."""
    page = "<div id=top><p>head</p></div><div class=post><h1>title</h1><p>body of the only page</p></div>"
    assert {text for n in (1, 2, 5) for text in pages_of(spark, [("copy.example", page)] * n)} == {"title\nbody of the only page"}
    assert pages_of(spark, [("one.example", "<div class=post><p>same</p><p>same</p><p>same</p></div>")]) == ["same\nsame\nsame"]
    lead = "the same lead " * 20
    got = pages_of(spark, [("lead.example", f"<div class=post><h2>fixed</h2><p>{lead}{i}</p></div>") for i in range(4)])
    assert got == [f"{lead}{i}" for i in range(4)]


def article(i, rest=""):
    return f"<body><nav>go</nav><article><h1>title {i}</h1><p>first words of article {i}, which go on for a while and a while</p>{rest}<p>last words of {i}, which go on too</p></article></body>"


@pytest.mark.parametrize("name", ["banner-history", "notice-of-appeal", "market-share", "related-work", "form-of-government"])
def test_words_in_the_names_of_content_lose_no_text(spark, name):
    got = pages_of(spark, [("names.example", article(i, f"<section class='{name}'><p>part {i}</p></section>")) for i in range(5)])
    assert all(f"\npart {i}\n" in text for i, text in enumerate(got))


@pytest.mark.parametrize("name", ["sidebar", "ad", "ad-box", "post-comments", "acme-comments", "share-links", "entry-sidebar left", "cookie-notice"])
def test_names_of_other_parts_go_inside_an_article(spark, name):
    got = pages_of(spark, [("names.example", article(i, f"<div class='{name}'><p>part {i}</p></div>")) for i in range(5)])
    assert not any("part" in text for text in got) and all(f"last words of {i}," in text for i, text in enumerate(got))


def test_lists_of_links_are_judged_by_what_pages_share(spark):
    """An article's own sources stay; a menu or a notice that every article repeats goes, whatever its class."""
    sources = "<ul><li><a href=a>source {0} one</a></li><li><a href=b>source {0} two</a></li></ul>"
    got = pages_of(spark, [("links.example", article(i, sources.format(i))) for i in range(5)])
    assert all(f"source {i} one\nsource {i} two" in text for i, text in enumerate(got))
    menu, notice = sources.format("same"), "<div class=xq><p>call us today</p></div>"
    got = pages_of(spark, [("menu.example", article(i, menu + notice)) for i in range(5)])
    assert not any("source" in text or "call us" in text for text in got)
    assert all("source same" in text and "call us" in text for text in pages_of(spark, [("two.example", article(i, menu + notice)) for i in range(2)]))
    assert all("call us" in text for text in pages_of(spark, [("copy.example", article(7, notice + f"<p>{i}</p>")) for i in range(6)]))  # near copies of one article


def test_headings_and_paragraphs_that_articles_share_stay(spark):
    got = pages_of(spark, [("share.example", article(i, "<h2>Summary</h2><p>a passage that each article quotes</p>")) for i in range(6)])
    assert all("\nSummary\na passage that each article quotes\n" in text for text in got)
    same = "<body><article><h1>place {0}</h1><div><p>nothing is written of this place as yet, and the same is said of all</p></div></article></body>"
    assert all("nothing is written" in text for text in pages_of(spark, [("stub.example", same.format(i)) for i in range(6)]))


def test_one_differing_foot_saves_none(spark):
    page = "<body><div class=post><h1>head {0}</h1><p>body {0} with all that belongs to it, as long as it takes to be the most</p></div><div class=low><p>{1}</p></div></body>"
    got = pages_of(spark, [("foot.example", page.format(i, "other foot" if i == 3 else "our foot")) for i in range(5)])
    assert [text.split("\n")[0] for text in got] == [f"head {i}" for i in range(5)] and not any("foot" in text for text in got)


def test_depth_changes_no_decision(spark):
    for depth in (3, 199, 205, 400):
        inner = "<p>kept</p><div class=sidebar><div><p>side</p></div><p>more side</p></div><p>kept too</p>"
        text, = pages_of(spark, [("deep.example", "<body><article>" + "<div>" * depth + inner + "</div>" * depth + "<p>end</p></article><footer>foot</footer></body>")])
        assert text == ("kept\nkept too\nend" if depth < 198 else text) and "side" not in text and "foot" not in text
        assert "kept" in text and "kept too" in text and text.endswith("end")
    stray = wrappers.parse("<x>" * 30_000 + "t" + "</x>" * 30_000)
    while stray[0][0] != "#":
        stray = stray[0][1]
    assert stray == [["#", "t", 0]]


# -- revisits ------------------------------------------------------------------------------------------------

def test_canonical_urls(spark):
    cases = {"HTTP://User@WWW.Ex.org:80/a/b/?utm_source=x&b=2&a=1&ref=q#top": "ex.org/a/b?a=1&b=2", "https://ex.org": "ex.org", "https://ex.org/?": "ex.org", "ex.org/A/": "ex.org/A", None: None, "": ""}
    frame = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.c for r in frame.select("u", warc.canonical_url(F.col("u")).alias("c")).collect()} == cases


def test_revisits_resolve_as_of_their_time(spark):
    rec = "record_id long, url string, captured_at long, status int, etag string, last_modified string, headers map<string,string>, body string, base string"
    full = {"Content-Type": "text/html", "Date": "1", "X": "old"}
    rows = [(1, "http://a.org/x", 10, 200, '"v1"', "m1", full, "one", "c"), (2, "https://www.a.org/x/#f", 20, 304, 'W/"v1"', None, {"date": "2", "Content-Type": "no", "x": "new"}, None, "c"),
            (3, "http://a.org/x", 30, 200, '"v2"', "m2", None, "two", "c"), (4, "http://a.org/x", 40, 304, '"v1"', None, None, None, "c"), (5, "http://a.org/x", 5, 304, '"v1"', None, None, None, "c"),
            (6, "http://a.org/x", 30, 304, None, "m2", None, None, "c"), (7, "http://a.org/x", 50, 304, None, None, None, None, "c"), (8, None, 50, 304, None, None, None, None, "c"), (9, "http://a.org/x", None, 304, None, None, None, None, "c"),
            (2, "https://www.a.org/x/#f", 20, 304, 'W/"v1"', None, {"date": "2", "Content-Type": "no", "x": "new"}, None, "c"), (10, "http://b.org", 60, 404, None, None, None, "gone", "c")]
    got = {r.record_id: r for r in warc.resolve(spark.createDataFrame(rows, rec), ["body"]).collect()}
    assert set(got) == {2, 4, 5, 6, 7, 8, 9}
    assert (got[2].outcome, got[2].base_id, got[2].body) == ("resolved", 1, "one") and dict(got[2].headers) == {"content-type": "text/html", "date": "2", "x": "new"}
    assert (got[4].outcome, got[4].base_id, got[4].body) == ("validator_mismatch", 3, None)
    assert got[5].outcome == got[8].outcome == got[9].outcome == "no_earlier_response"
    assert (got[6].base_id, got[7].base_id, got[7].outcome) == (3, 3, "resolved")  # same time: in the order of the ids
    assert warc.resolve(spark.createDataFrame([], rec), ["body"]).count() == 0


def test_revisits_with_shared_and_null_ids_each_count(spark):
    rec = "record_id long, url string, captured_at long, status int, etag string, last_modified string, headers map<string,string>, body string"
    rows = [(None, "http://a.org/x", 10, 200, None, None, {"A": "1"}, "one"), (None, "http://b.org/x", 10, 200, None, None, {"A": "2"}, "two"), (None, "http://a.org/x", 20, 304, None, None, None, None),
            (None, "http://b.org/x", 30, 304, None, None, None, None), (7, "http://a.org/x", 40, 304, None, None, None, None), (7, "http://b.org/x", 50, 304, None, None, None, None), (7, "http://b.org/x", 50, 304, None, None, None, None)]
    got = sorted((r.captured_at, r.record_id, r.outcome, r.body) for r in warc.resolve(spark.createDataFrame(rows, rec), ["body"]).collect())
    assert got == [(20, None, "resolved", "one"), (30, None, "resolved", "two"), (40, 7, "resolved", "one"), (50, 7, "resolved", "two")]


def test_revisits_of_one_hot_url_cross_ranges(spark):
    rows = spark.range(4000).select(F.col("id").alias("record_id"), F.lit("http://hot.org/").alias("url"), F.col("id").alias("captured_at"), F.when(F.col("id") % 1000 == 0, 200).otherwise(304).alias("status"),
                                    F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("map<string,string>").alias("headers")).repartition(7)
    got = warc.resolve(rows, []).collect()
    assert len(got) == 3996 and all(r.base_id == r.record_id // 1000 * 1000 for r in got)


# -- mixing --------------------------------------------------------------------------------------------------

def plain_deal(budget, children):
    """Water filling one child at a time, by the definition."""
    out, left = {}, sorted(children, key=lambda c: (c[1] / c[2], c[0]))
    while left:
        name, can, weight = left[0]
        if can * sum(w for *_, w in left) > budget * weight:
            total = sum(w for *_, w in left)
            return out | {n: budget * w // total for n, _, w in left}
        out[name] = can
        budget -= can
        left.pop(0)
    return out


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", "1", 10), ("a", "x", "2", 100), ("a", "y", "1", 400), ("b", "x", "1", 40), ("b", "z", "9", 3000)]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    weights = [{"a": 3, "b": 1}, {"x": 1, "y": 1, "z": 2}, {}]
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(frame, ["domain", "lang", "source"], weights, 0.2, 1).collect()}
    total = int(3550 * 0.2)
    top = plain_deal(total, [("a", 510, 3), ("b", 3040, 1)])
    a, b = plain_deal(top["a"], [("x", 110, 1), ("y", 400, 1)]), plain_deal(top["b"], [("x", 40, 1), ("z", 3000, 2)])
    ax = plain_deal(a["x"], [("1", 10, 1), ("2", 100, 1)])
    assert got == {("a", "x", "1"): ax["1"], ("a", "x", "2"): ax["2"], ("a", "y", "1"): a["y"], ("b", "x", "1"): b["x"], ("b", "z", "9"): b["z"]}
    assert ax["1"] == 10 and sum(got.values()) <= total


def test_selection_meets_every_leaf_budget(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").withColumn("domain", F.lit("d"))
    chosen = mixing.select(docs, MIX_LEVELS, MIX_WEIGHTS, budget_share=1.4, epochs=3)
    leaf = docs.withColumn("tokens", mixing.token_count(F.col("text"))).where("tokens > 0").groupBy(*[F.coalesce(c, F.lit("(none)")).alias(c) for c in MIX_LEVELS]).agg(F.sum("tokens").alias("tokens"))
    want = {tuple(r[c] for c in MIX_LEVELS): r.budget for r in mixing.leaf_budgets(leaf, MIX_LEVELS, MIX_WEIGHTS, 1.4, 3).collect()}
    got: dict = {}
    for r in chosen.collect():
        key = tuple(r[c] for c in MIX_LEVELS)
        got[key] = got.get(key, 0) + r.tokens_taken
        assert 0 < r.tokens_taken <= r.n_tokens and 1 <= r.epoch <= 3
    assert got == {k: v for k, v in want.items() if v}
    again = mixing.select(docs.repartition(5), MIX_LEVELS, MIX_WEIGHTS, budget_share=1.4, epochs=3)
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, again.collect()))
    assert "Python" not in chosen._jdf.queryExecution().executedPlan().toString()


def test_mixing_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "a b c"), (4, "d e"), (4, "d e"), (5, FILL)]
    docs = table(spark, texts).withColumn("epoch", F.lit("clash")).withColumn("domain", F.lit(None).cast("string"))
    chosen = mixing.select(docs, MIX_LEVELS, MIX_WEIGHTS, budget_share=2.0, epochs=2)
    rows = chosen.collect()
    assert {r.doc_id for r in rows} == {3, 4, 5} and {r.domain for r in rows} == {"(none)"}
    out = mixing.selected(docs, chosen)
    assert sorted((r.doc_id, r.epoch) for r in out.collect()) == sorted((r.doc_id, r.epoch) for r in rows)
    assert out.columns == [*[c for c in docs.columns if c != "epoch"], "epoch", "n_tokens", "tokens_taken"]
    assert mixing.select(docs.limit(0), MIX_LEVELS, MIX_WEIGHTS).count() == 0


# -- pipeline ------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, root):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        after = P.written(stage(spark, docs, root), name)
        assert after.columns == columns and after.dtypes == docs.dtypes
        if name == "personal_data":
            assert after.count() == docs.count() and after.where(F.length("text") != F.col("n_chars")).count() == 0
            assert after.where(r"text rlike '[A-Za-z0-9]@[a-z0-9]+[.]example'").count() == 0
        else:
            assert after.select("doc_id").subtract(docs.select("doc_id")).count() == 0 and after.count() <= docs.count()
        docs = after
    final = P.STAGES[-1][1](spark, docs, root)
    assert final.count() > 0 and {"doc_id", "text", "epoch", "tokens_taken"} <= set(final.columns)
