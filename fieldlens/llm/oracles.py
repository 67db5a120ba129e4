"""DuckDB SQL of the queries that SQL can express; each states the result, not the way to it."""

from __future__ import annotations

from fieldlens.llm import licenses

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_SPACE}'), lambda x: x <> '')"


def _shingles(words: str) -> str:
    return f"list_transform(range(1, greatest(len({words}) - 4, least(len({words}), 1)) + 1), lambda i: array_to_string({words}[i:i + 4], ' '))"


DECONTAMINATION = f"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
dw AS (SELECT doc_id, text, {_words('text')} AS w FROM d),
ds AS (SELECT DISTINCT doc_id, text, unnest({_shingles('w')}) AS s FROM dw),
iw AS (SELECT item_id, {_words('text')} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
il AS (SELECT item_id, w, list_distinct({_shingles('w')}) AS l FROM iw),
si AS (SELECT item_id, w, len(l) AS n, unnest(l) AS s FROM il),
hit AS (SELECT doc_id, text, item_id, w, n, count(*) AS found FROM ds JOIN si USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, found / n::DOUBLE AS containment FROM hit WHERE found >= 0.8 * n
"""


def license_scan() -> str:
    quote = lambda x: x.replace("'", "''")
    rows = ", ".join(f"('{name}', {i}, {licenses.half_of(len(licenses.words_in(t)) - 4)}, '{quote(t)}')" for name, texts in licenses.TEMPLATES.items() for i, t in enumerate(texts))
    sizes = [len(licenses.words_in(t)) - 4 for texts in licenses.TEMPLATES.values() for t in texts]
    widest = max(n for n in sizes if not licenses.half_of(n))
    words = lambda t: f"list_filter(string_split_regex(lower(coalesce({t}, '')), '{licenses.SEPARATORS}'), lambda x: x <> '')"
    return f"""
WITH t(license, variant, half, text) AS (VALUES {rows}),
tw AS (SELECT license, variant, half, {words('text')} AS w FROM t),
tl AS (SELECT license, variant, half, list_distinct({_shingles('w')}) AS l FROM tw),
ts AS (SELECT license, variant, half, len(l) AS n, unnest(l) AS s FROM tl),
d AS (SELECT doc_id, text, {words('text')} AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
p AS (SELECT doc_id, text, w, unnest(range(0, greatest(len(w) - 4, least(len(w), 1)))) AS i FROM d),
ps AS (SELECT doc_id, text, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM p),
h AS (SELECT doc_id, text, license, variant, half, n, i, ps.s FROM ps JOIN ts USING (s)),
single AS (SELECT DISTINCT doc_id, text, greatest(i - {widest} + 1, 0) AS start FROM h WHERE half = 0),
win AS (SELECT h.*, greatest(i // half - b, 0) * half AS start FROM h, range(0, 3) AS r(b) WHERE half > 0
  UNION ALL SELECT h.*, start FROM h JOIN single x ON x.doc_id IS NOT DISTINCT FROM h.doc_id AND x.text = h.text AND half = 0 AND i BETWEEN start AND start + 2 * {widest} - 2),
m AS (SELECT doc_id, text, license, n, count(DISTINCT s) / n::DOUBLE AS containment, min(i) AS place FROM win GROUP BY doc_id, text, license, variant, n, start),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text, license ORDER BY containment DESC, n DESC, place) AS k FROM m WHERE containment >= 0.8 - 1e-9)
SELECT doc_id, license, n AS n_shingles, containment, place AS first_word FROM best WHERE k = 1
"""


EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents),
g AS (SELECT doc_id, sha256(plain) AS text_sha256, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        row_number() OVER (PARTITION BY plain ORDER BY doc_id) = 1 AS kept FROM n WINDOW same AS (PARTITION BY plain))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
"""


#: crc32 by its definition: the register takes a byte, then eight times shifts right, with the polynomial where a one falls out.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda ch: list_concat([ascii(ch)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS k FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, 0 AS part, t.k, r, x FROM c JOIN t ON t.conv_id = c.base AND k <= h
  UNION ALL SELECT c.conv_id, 1, t.k, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND k > h),
seq AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY part, k) AS s FROM b GROUP BY conv_id),
conv AS (SELECT conv_id, coalesce(s, []) AS s FROM c LEFT JOIN seq USING (conv_id)),
pre AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM conv),
n AS (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ends FROM pre GROUP BY ALL),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
own AS (SELECT n.p, n.d, conv_id, n_convs, ends, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * strlen(p[d].x) ELSE 0 END AS saved FROM n LEFT JOIN kids USING (p)),
ups AS (SELECT p, n_children, saved, unnest(range(d + 1)) AS a FROM own),
total AS (SELECT p[1:a] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM ups GROUP BY 1)
SELECT o.conv_id, o.d AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN total ON total.p = o.p LEFT JOIN own u ON o.d > 0 AND u.p = o.p[1:o.d - 1] AND u.d = o.d - 1
"""


REVISITS = r"""
WITH f AS (SELECT page_id, url, coalesce(html, '') AS body, unnest(range(0, 4)) AS n FROM pages),
v AS (SELECT *, n = 0 OR (n = 2 AND page_id % 3 = 0) AS fresh, CASE WHEN n >= 2 AND page_id % 3 = 0 THEN 2 ELSE 1 END AS ver FROM f),
r AS (SELECT page_id * 4 + n AS id, n, fresh, body, page_id + n * 1000000 AS seen, page_id + ver AS modified,
        CASE WHEN fresh OR contains(url, '?') THEN url ELSE regexp_replace(url, '#.*$', '') || '?utm_source=recrawl' END AS url,
        CASE WHEN fresh THEN md5(body)[1:12] || '-' || ver WHEN page_id % 5 = 1 THEN NULL WHEN page_id % 7 = 3 AND n = 3 THEN 'gone' ELSE md5(body)[1:12] || '-' || ver END AS tag FROM v),
b AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?@]*@)?', '') AS bare FROM r),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)'))) AS kept FROM b),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '') || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canon FROM q),
w AS (SELECT *, last_value(CASE WHEN fresh AND canon IS NOT NULL THEN id END IGNORE NULLS) OVER (PARTITION BY canon ORDER BY seen, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near FROM c),
j AS (SELECT x.id, x.canon, x.seen, x.n, y.id AS base_id, y.body,
        CASE WHEN y.id IS NULL THEN 'no_earlier_response' WHEN CASE WHEN x.tag IS NOT NULL THEN x.tag = y.tag ELSE x.modified = y.modified END THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
      FROM w x LEFT JOIN c y ON x.near = y.id AND x.canon IS NOT NULL WHERE NOT x.fresh)
SELECT id AS record_id, canon AS canonical_url, seen AS captured_at, base_id, outcome,
  CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=60;content-length=' || length(body) || ';content-type=text/html;date=' || n END AS headers,
  CASE WHEN outcome = 'resolved' THEN md5(body) END AS payload_md5, CASE WHEN outcome = 'resolved' THEN length(body)::INTEGER END AS payload_chars FROM j
"""


def _level(depth: int, levels: list[str], weights: dict[str, int]) -> str:
    """One level of budgets: children fill up in the order of what they can give over their weight."""
    own, up = levels[:depth + 1], levels[:depth]
    weight = "".join(f" WHEN '{k}' THEN {w}" for k, w in weights.items())
    weight = f"CASE {own[-1]}{weight} ELSE 1 END" if weight else "1"
    part = f"PARTITION BY {', '.join(up)}" if up else ""
    joined = f"JOIN b{depth - 1} USING ({', '.join(up)})" if up else ", b_root"
    keys = ", ".join(own)
    return f"""
n{depth} AS (SELECT {keys}, sum(can) AS can, any_value({weight})::HUGEINT AS weight FROM leaves GROUP BY {keys}),
o{depth} AS (SELECT n{depth}.*, budget AS above, row_number() OVER ({part} ORDER BY can::DOUBLE / weight::DOUBLE, {own[-1]}) AS place FROM n{depth} {joined}),
c{depth} AS (SELECT *, above - coalesce(sum(can) OVER ({part} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER ({part} ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM o{depth}),
f{depth} AS (SELECT *, min(CASE WHEN can * weights > rest * weight THEN place END) OVER ({part}) AS cut FROM c{depth}),
g{depth} AS (SELECT *, max(CASE WHEN place = cut THEN rest END) OVER ({part}) AS cut_rest, max(CASE WHEN place = cut THEN weights END) OVER ({part}) AS cut_weights FROM f{depth}),
b{depth} AS (SELECT {keys}, CASE WHEN cut IS NULL OR place < cut THEN can ELSE (cut_rest * weight) // cut_weights END AS budget FROM g{depth}),"""


def mix(levels: list[str], weights: list[dict[str, int]], share: float = 0.6, epochs: int = 3, seed: int = 11) -> str:
    keys = ", ".join(levels)
    return f"""
WITH rated AS (SELECT doc_id AS rated_id, max(quality) AS rating FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (SELECT DISTINCT doc_id, text, CASE WHEN rating > 0 THEN 'rated_good' WHEN rating <= 0 THEN 'rated_poor' ELSE 'unrated' END AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents LEFT JOIN rated ON doc_id = rated_id),
rows_ AS (SELECT * FROM d WHERE n_tokens > 0),
leaves AS (SELECT {keys}, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {epochs} AS can FROM rows_ GROUP BY {keys}),
b_root AS (SELECT least(trunc(sum(tokens)::DOUBLE * {share}::DOUBLE)::HUGEINT, sum(can)) AS budget FROM leaves),{''.join(_level(i, levels, w) for i, w in enumerate(weights))}
plan AS (SELECT {keys}, (budget // tokens)::INTEGER AS whole, budget % tokens AS part FROM leaves JOIN b{len(levels) - 1} USING ({keys})),
m AS (SELECT rows_.*, whole, part, md5(concat_ws(':', '{seed}', (whole + 1)::VARCHAR, coalesce(doc_id::VARCHAR, ''))) AS h FROM rows_ JOIN plan USING ({keys})),
s AS (SELECT *, part - coalesce(sum(n_tokens) OVER (PARTITION BY {keys} ORDER BY h, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_ FROM m)
SELECT doc_id, {keys}, n_tokens, unnest(range(1, whole + 1))::INTEGER AS epoch, n_tokens AS tokens_taken FROM m
UNION ALL SELECT doc_id, {keys}, n_tokens, whole + 1 AS epoch, least(left_, n_tokens)::BIGINT AS tokens_taken FROM s WHERE left_ > 0
""".replace("\\\\", "\\")
