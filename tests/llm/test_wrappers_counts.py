"""What a host's pages have in common is counted over all of them."""

from fieldlens.llm import wrappers


def test_a_slot_is_fixed_by_all_pages_and_not_by_a_few_of_them(spark):
    # 60 pages; the line is the same on the 16 with the least identities and new on every other page
    titles = sorted((f"title {i}" for i in range(60)), key=wrappers._hash)
    html = "<body><article><h1>{0}</h1><div class='x'><span>{1}</span></div><p>text of {0}, long enough to be over half of it all and more than that</p></article></body>"
    pages = [(i, "http://h/p", html.format(t, "the same line" if i < 16 else f"line of {t}")) for i, t in enumerate(titles)]
    out = wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(out) == 60
    assert all(("the same line" if r.page_id < 16 else "line of") in r.text for r in out)
