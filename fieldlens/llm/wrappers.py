"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page's token stream becomes nested sequences of block elements and text slots. Neighbours with equal keys (tag and
class), alone or as groups of two to four, are folded into repeated items. The sequences of a host's pages are then aligned one after
another: items that match are merged, those without a partner become optional, and texts that differ become slots. What
results is the host's wrapper: sequences of items, each perhaps optional or repeated, without alternatives. Items carry the characters and
the link characters seen in them.

A host has up to three wrappers: of its pages with text in an article element, of the others with text in a main element, and of
the rest, so pages of one kind do not decide what is content on those of another.

The wrapper tells content from the rest: its article or main element (or, without one, the element that most of the text lies
in, as long as every page has text there), less the items that are menus, adverts, forms and the like. Every page of the host is matched against the wrapper and its texts are
counted by slot; a slot is fixed if ``FIXED_PAGES`` pages or more, and a share of ``FIXED_SHARE`` of all that have it, have one text there.

* Outside an article fixed slots go, and so do lists of links and all that a tag or a word of a class names.
* Inside an article an element goes if its tag or the whole of a class name says so (``ad-box``, ``post-comments``). A name that merely holds such a word
  (``banner-history``) says nothing by itself. Containers and lists, of links too, go if all their slots are fixed, as menus and notices that
  every page repeats are, unless they hold over half of the article. Headings, paragraphs and repeated items never go as fixed.

Copies count once: pages of the same items outside an article, pages of the same title inside one. Each page is then matched against its host's wrapper of its kind
and the texts of content items are its main text. Elements nested deeper than ``DEPTH`` lend their texts to the one at that depth, less what is excluded by name.

Wrappers are merged within a task first, then by (host, kind, salt), then by host and kind, so no task gathers a host's pages. Defined cases:
a null or empty html has empty text; a null url or one without a host is of host ''; unclosed and stray tags close as browsers
close them; rows that repeat give a row each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterable, Iterator
from itertools import count

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.shared import batches_of, written

SALTS = 64
FIXED_PAGES, FIXED_SHARE = 3, 0.75
DEPTH, OPEN = 200, 2000
_MASK = (1 << 52) - 1
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>|<[!?/][^>]*+>|[^<]++|<", re.S | re.I)
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_HEADING = re.compile(r"h[1-6]")

# Names of HTML elements, and words of class names that mark what is not content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img".split())
CLOSES_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = frozenset("ul ol dl table tbody thead tr select div section article main aside nav body html form blockquote".split())
NOT_CONTENT_TAGS = frozenset("head nav header footer aside form button select option fieldset menu dialog noscript object".split())
NOT_CONTENT_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer form header masthead menu modal nav navbar navigation newsletter notice notices outbrain pagination popup promo promoted related replies respond share sharing sidebar signup social sponsor sponsored subscribe taboola toolbar topbar widget".split())
# Words that say where or how such an element lies and nothing of its content, and listed words that also end the names of content (market-share).
PLAIN_WORDS = frozenset("article area bar block body bottom box col column container content desktop entry float global group holder inner item items large left link links list lists main mobile module outer page panel post primary right row secondary section site slot small sticky story text title top unit wrap wrapper".split())
LOOSE_WORDS = frozenset("ad ads banner form header menu notice notices related share sharing social".split())
CONTAINERS = frozenset("div section ul ol dl table center address details".split())

# -- pages -----------------------------------------------------------------------------------------------------
# A page's item is [key, items] for a block element, or [TEXT, text, characters in links] for a run of text.
TEXT = "#"


def _key(tag: str, attributes: str) -> str:
    """The tag and every name of class, id and role. A name like has-sidebar tells of another element and is one word."""
    words: list[str] = []
    for m in _CLASS.finditer(attributes) if attributes else ():
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = _WORD.findall(name)
            if parts:
                words.append(("" if parts[0] in ("has", "no", "with", "without") else "-").join(parts))
    return ".".join([tag, *dict.fromkeys(words)])


def parse(page: str | None) -> list:
    """The page's items."""
    top: list = []
    stack: list[tuple[str, list]] = [("", top)]
    run: list[str] = []
    links = 0
    in_link = False

    def flush() -> None:
        nonlocal links
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                stack[-1][1].append([TEXT, text, min(links, len(text))])
            run.clear()
            links = 0

    def close(tags: tuple[str, ...], within: bool) -> None:
        """Closes the innermost open element of ``tags``; with ``within`` only up to the element that holds it."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if within and stack[i][0] in HOLDS:
                return

    for m in _TOKEN.finditer(page or ""):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                run.append(piece)
                if in_link:
                    links += len(piece.strip())
            elif m[1] and m[1].lower() in ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "title"):
                continue
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m[2]
            elif tag in ("br", "wbr"):
                run.append(" ")
            continue
        flush()
        in_link = False
        if m[2]:
            close((tag,), False)
            continue
        if tag in VOID:
            continue
        if tag not in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            close(("p",), True)
        elif tag == "p":
            close(("p",), True)
        else:
            close(CLOSES_ITSELF[tag], True)
        key = _key(tag, m[4])
        if len(stack) < DEPTH:
            items: list = []
            stack[-1][1].append([key, items])
            stack.append((tag, items))
        elif len(stack) < OPEN:  # texts go to the element above, or nowhere
            stack.append((tag, [] if _excluded({"k": key}, any(t == "article" for t, _ in stack)) else stack[-1][1]))
    flush()
    return top


# -- wrappers --------------------------------------------------------------------------------------------------
# A wrapper's item is a dict: k key, o optional, r repeated, n characters, l link characters, w whether all merged have text,
# t the start of its only text and h the hash of the whole (texts only, absent if they differ), s items (elements and groups). A group's key
# is "()". In a finished wrapper a text's i is the number of its slot and f whether it is fixed.


def _has_text(items: list[dict]) -> int:
    """Whether a page's items hold text that may be content."""
    return int(any(x["w"] and not _links(x) and (x["k"] == TEXT or not _excluded(x, False)) for x in items))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") & _MASK


def _folded(items: list) -> list[dict]:
    """A page's items as a wrapper of that page alone."""
    out: list[dict] = []
    for item in items:
        if item[0] == TEXT:
            node = {"k": TEXT, "o": 0, "r": 0, "n": len(item[1]), "l": item[2], "w": 1, "t": item[1][:200], "h": _hash(item[1])}
        else:
            inner = _folded(item[1])
            node = {"k": item[0], "o": 0, "r": 0, "n": sum(x["n"] for x in inner), "l": sum(x["l"] for x in inner), "w": _has_text(inner), "s": inner}
        if out and out[-1]["k"] == node["k"]:
            out[-1] = _merged(out[-1], node)
            out[-1]["r"] = 1
        else:
            out.append(node)
    for size in (2, 3, 4):
        out = _grouped(out, size)
    return out


def _grouped(items: list[dict], size: int) -> list[dict]:
    """Neighbouring runs of ``size`` items with the same keys become one repeated group."""
    out: list[dict] = []
    i = 0
    while i < len(items):
        keys = [x["k"] for x in items[i:i + size]]
        j = i + size
        if len(keys) == size and keys == [x["k"] for x in items[j:j + size]] and "()" not in keys:
            inner = items[i:j]
            while keys == [x["k"] for x in items[j:j + size]]:
                inner = [_merged(a, b) for a, b in zip(inner, items[j:j + size], strict=True)]
                j += size
            out.append({"k": "()", "o": 0, "r": 1, "n": sum(x["n"] for x in inner), "l": sum(x["l"] for x in inner), "w": _has_text(inner), "s": inner})
            i = j
        else:
            out.append(items[i])
            i += 1
    return out


def _merged(a: dict, b: dict) -> dict:
    """One item for two with the same key."""
    out = {"k": a["k"], "o": a["o"] | b["o"], "r": a["r"] | b["r"], "n": a["n"] + b["n"], "l": a["l"] + b["l"], "w": a["w"] & b["w"]}
    if a["k"] != TEXT:
        return out | {"s": align(a["s"], b["s"])}
    return out | {"t": a["t"], "h": a["h"]} if "t" in a and a["h"] == b.get("h") else out


def _may_pair(a: dict, b: dict) -> bool:
    return a["k"] == b["k"] and (a["k"] != "()" or [x["k"] for x in a["s"]] == [x["k"] for x in b["s"]])


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """One sequence for two: pairs of a longest common subsequence of keys are merged, the rest is optional."""
    if len(a) == len(b) and all(map(_may_pair, a, b)):
        return [_merged(x, y) for x, y in zip(a, b, strict=True)]
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            rows[i][j] = rows[i + 1][j + 1] + 1 if _may_pair(a[i], b[j]) else max(rows[i + 1][j], rows[i][j + 1])
    out: list[dict] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and _may_pair(a[i], b[j]) and rows[i][j] == rows[i + 1][j + 1] + 1:
            out.append(_merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and rows[i + 1][j] >= rows[i][j + 1]):
            out.append(a[i] | {"o": 1})
            i += 1
        else:
            out.append(b[j] | {"o": 1})
            j += 1
    return out


def wrapper_of(page: str | None) -> list[dict]:
    return _folded(parse(page))


def identity_of(items: list, kind: str) -> int:
    """What copies of a page share: the title in its article or main element, without one all its items."""

    def texts(xs: list, inside: bool, heading: bool) -> Iterator[tuple[bool, str]]:
        for x in xs:
            if x[0] == TEXT:
                if inside:
                    yield heading, x[1]
            elif not _excluded({"k": x[0]}, inside):
                yield from texts(x[1], inside or _is(x[0], kind), heading or _HEADING.fullmatch(x[0].split(".")[0]) is not None)

    if kind:
        found = list(texts(items, False, False))
        title = next((t for h, t in found if h), found[0][1] if found else "")
        return _hash(title)
    return _hash(json.dumps(items))


def expression(items: list[dict]) -> str:
    """The wrapper as a regular expression over tags, for people."""
    out = []
    for x in items:
        one = ("#" if "t" not in x else json.dumps(x["t"], ensure_ascii=False)) if x["k"] == TEXT else f"({expression(x['s'])})" if x["k"] == "()" else f"<{x['k']}>{expression(x['s'])}</>"
        mark = "*" if x["o"] and x["r"] else "?" if x["o"] else "+" if x["r"] else ""
        out.append(f"({one}){mark}" if mark and x["k"] != "()" else one + mark)
    return " ".join(out)


def _names(name: str, in_article: bool) -> bool:
    """Whether a class name says that an element is not content. Inside an article its other words must say nothing, or the listed one must end it."""
    parts = name.split("-")
    if NOT_CONTENT_WORDS.isdisjoint(parts):
        return False
    if not in_article:
        return True
    return all(p in NOT_CONTENT_WORDS or p in PLAIN_WORDS or len(p) <= 2 for p in parts) or (parts[-1] in NOT_CONTENT_WORDS and parts[-1] not in LOOSE_WORDS)


def _excluded(x: dict, in_article: bool) -> bool:
    tag, *names = x["k"].split(".")
    if tag == "header" and in_article:
        return any(_names(n, True) for n in names if "header" not in n.split("-"))
    return tag in NOT_CONTENT_TAGS or (tag not in ("body", "html", "article", "main") and any(_names(n, in_article) for n in names))


def _fixed(x: dict) -> bool:
    """Whether most pages have the same text in this slot, or in all slots of this element."""
    if x["k"] != TEXT:
        return x["n"] > 0 and all(_fixed(y) for y in x["s"] if y["n"])
    return bool(x.get("f"))


def numbered(items: list[dict], fixed: Iterable[int] = ()) -> list[dict]:
    """Sets the slot numbers of a wrapper's texts, in order, and which slots are fixed."""
    fixed, n = set(fixed), count()

    def number(xs: list[dict]) -> None:
        for x in xs:
            if x["k"] == TEXT:
                x["i"] = next(n)
                x["f"] = int(x["i"] in fixed)
            else:
                number(x["s"])

    number(items)
    return items


def _links(x: dict) -> bool:
    """Whether the item is a list of links."""
    return x["l"] > 0.6 * max(1, x["n"])


def _is(key: str, tag: str) -> bool:
    tag_of, *names = key.split(".")
    return tag_of == tag or (tag == "main" and any("main" in n.split("-") for n in names))


def kind_of(page: list) -> str:
    """Which of a host's wrappers a page's items belong to: that of ``article``, ``main`` or neither."""

    def has_text(items: list) -> bool:
        return any(x[0] == TEXT or (not _excluded({"k": x[0]}, True) and has_text(x[1])) for x in items)

    def found(items: list, tag: str) -> bool:
        return any(has_text(x[1]) if _is(x[0], tag) else found(x[1], tag) for x in items if x[0] != TEXT and not _excluded({"k": x[0]}, False))

    return next((tag for tag in ("article", "main") if found(page, tag)), "")


def mark_content(items: list[dict], kind: str) -> list[dict]:
    """Sets ``m`` on the items whose texts are content, in a wrapper of pages of one kind."""

    def roots(tag: str) -> list[dict]:
        found: list[dict] = []

        def look(xs: list[dict]) -> None:
            for x in xs:
                if x["k"] == TEXT or _excluded(x, False):
                    continue
                if _is(x["k"], tag):
                    found.append(x)
                else:
                    look(x["s"])

        look(items)
        return found

    def mark(x: dict, whole: int) -> None:
        """``whole`` is the article's characters, 0 outside one."""
        for y in x["s"]:
            if y["k"] == TEXT:
                y["m"] = int(bool(whole) or not _fixed(y))
            elif _excluded(y, bool(whole)):
                continue
            elif whole:
                if not (y["k"].split(".")[0] in CONTAINERS and not y["r"] and y["n"] <= 0.5 * whole and _fixed(y)):
                    mark(y, whole)
            elif not _links(y):
                mark(y, 0)

    if kind:
        for x in roots(kind):
            mark(x, x["n"])
        return items
    at = {"s": items, "n": 0, "l": 0, "k": ""}
    kept = lambda x: sum(y["n"] for y in x["s"] if (y["k"] == TEXT or not _excluded(y, False)) and not (y["k"] != TEXT and _links(y)))
    while True:
        most = max((y for y in at["s"] if y["k"] != TEXT and not _excluded(y, False) and not _links(y) and not y["r"] and not y["o"] and y["w"]), key=lambda y: y["n"], default=None)
        if most is None or most["n"] <= 0.6 * kept(at) or not any(y["k"] != TEXT for y in most["s"]):
            break
        at = most
    mark(at, 0)
    return items


class Matcher:
    """Matches pages against a marked wrapper."""

    def __init__(self, items: list[dict]):
        self.flat: list[tuple[dict, int]] = []  # item, where its group begins
        for x in items:
            if x["k"] == "()":
                begin = len(self.flat)
                self.flat += [(y, begin) for y in x["s"]]
            else:
                self.flat.append((x, len(self.flat)))
        self.at: dict[str, list[int]] = {}
        for i, (x, _) in enumerate(self.flat):
            self.at.setdefault(x["k"], []).append(i)
        self.inner: dict[int, Matcher] = {}

    def texts(self, items: list) -> Iterator[tuple[dict, str]]:
        """A page's texts that have a slot, each with it."""
        place = 0
        for item in items:
            options = self.at.get(item[0])
            if not options:
                continue
            i = next((j for j in options if j >= place), None)
            if i is None:  # once more through a group, else the last of its kind
                back = self.flat[min(place, len(self.flat) - 1)][1]
                i = next((j for j in options if j >= back), options[-1])
            node = self.flat[i][0]
            place = i
            if item[0] == TEXT:
                yield node, item[1]
            else:
                if i not in self.inner:
                    self.inner[i] = Matcher(node["s"])
                yield from self.inner[i].texts(item[1])

    def blocks(self, items: list) -> list[str]:
        """The content texts of a page's items."""
        return [text for node, text in self.texts(items) if node.get("m")]

    def slots(self, items: list) -> dict[int, int]:
        """The hash of a page's text in each slot; hashes of texts in one slot are added up."""
        out: dict[int, int] = {}
        for node, text in self.texts(items):
            out[node["i"]] = (out.get(node["i"], 0) + _hash(text)) & _MASK
        return out


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def infer(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``(host, kind, wrapper)`` with the wrapper as JSON, from all pages."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], list[dict]] = {}
        salt = TaskContext.get().partitionId() % SALTS

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pydict({"host": pa.array([h for h, _ in found], pa.string()), "kind": pa.array([k for _, k in found], pa.string()), "salt": pa.array([salt] * len(found), pa.int32()), "wrapper": pa.array([json.dumps(w) for w in found.values()], pa.string())})
            found.clear()
            return rows

        for b in batches_of(batches, 500):
            for host, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                items = parse(text)
                at = host, kind_of(items)
                own = _folded(items)
                found[at] = align(found[at], own) if at in found else own
            if len(found) > 2000:
                yield out()
        yield out()

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        total: list[dict] | None = None
        for w in sorted(pdf["wrapper"]):
            total = json.loads(w) if total is None else align(total, json.loads(w))
        return pdf[["host", "kind", "salt"]].iloc[:1].assign(wrapper=json.dumps(total))

    schema = "host string, kind string, salt int, wrapper string"
    rows = pages.where(F.col(page).isNotNull()).select(host_of(F.col(url)).alias("host"), F.col(page).cast("string").alias("page"))
    salted = rows.mapInArrow(first, schema).groupBy("host", "kind", "salt").applyInPandas(join, schema)
    return salted.groupBy("host", "kind").applyInPandas(join, schema).select("host", "kind", "wrapper")


def _with_wrappers(rows: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Rows with the wrappers of their host: of each kind (at most three) its number, text and fixed slots."""
    of = wrappers.groupBy(F.col("host").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("kind", F.struct("w", "wrapper", "fixed")))).alias("wrappers"))
    return rows.join(of, F.col("host") == F.col("of"), "left").drop("host", "of")


class _Known:
    """Matchers by the number of their wrapper."""

    def __init__(self) -> None:
        self.by: dict[int, Matcher] = {}

    def of(self, own: list, kind: str, marked: bool) -> tuple[int, Matcher]:
        w = dict(own)[kind]
        if w["w"] not in self.by:
            if len(self.by) >= 500:
                self.by.clear()
            items = numbered(json.loads(w["wrapper"]), w["fixed"])
            self.by[w["w"]] = Matcher(mark_content(items, kind) if marked else items)
        return w["w"], self.by[w["w"]]


def fixed_slots(rows: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``(w, fixed)``: a wrapper's number and its fixed slots, counted over all pages. Copies count once, with the least of their texts in a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for b in batches_of(batches, 500):
            out: list[tuple[int, int, int, int]] = []
            for text, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                items = parse(text)
                kind = kind_of(items)
                w, matcher = known.of(own, kind, False)
                page = identity_of(items, kind)
                out += [(w, slot, page, h) for slot, h in matcher.slots(items).items()]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["w", "slot", "page", "text"])

    seen = _with_wrappers(rows.where("page is not null").select("page", "host"), wrappers).select("page", "wrappers").mapInArrow(run, "w long, slot int, page long, text long")
    texts = seen.groupBy("w", "slot", "page").agg(F.min("text").alias("text")).groupBy("w", "slot", "text").agg(F.count(F.lit(1)).alias("n"))
    slots = texts.groupBy("w", "slot").agg(F.max("n").alias("most"), F.sum("n").alias("pages"))
    return slots.where((F.col("most") >= FIXED_PAGES) & (F.col("most") >= FIXED_SHARE * F.col("pages"))).groupBy("w").agg(F.collect_list("slot").alias("fixed"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    none = F.array().cast("array<int>")
    bare = written(infer(pages, url, page).withColumn("w", F.monotonically_increasing_id()), "wrappers")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).cast("string").alias("page"), host_of(F.col(url)).alias("host"))
    fixed = fixed_slots(rows, bare.withColumn("fixed", none))
    wrappers = written(bare.join(fixed, "w", "left").withColumn("fixed", F.coalesce("fixed", none)), "marked-wrappers")
    joined = _with_wrappers(rows, wrappers).select("page_id", "url", "page", "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for b in batches_of(batches, 500):
            texts = []
            for text, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if not text or own is None:
                    texts.append("")
                    continue
                items = parse(text)
                texts.append("\n".join(known.of(own, kind_of(items), True)[1].blocks(items)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
