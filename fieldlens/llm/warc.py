"""Not-modified revisits of WARC captures resolved to the full responses they stand for.

A revisit record of the server-not-modified profile holds a 304 answer without a body. It is joined as of its time to the latest
earlier full response (status 200) of the same canonical URL. The join takes if the validators agree: entity tags, compared
weakly, where the revisit has one; else the time of last modification; a revisit without validators takes what is there.
The answer that results has the response's payload, and its headers updated by those of the 304 except
the ones that describe the stored body or one connection.

The as-of join is made for URLs of any number of captures: records are dealt by ranges of (URL, time, id), a running last value is
taken within each range, and a summary of one row for each URL and range carries the last response across ranges. Bodies
take no part in it; they are joined by record id at the end.

Outcomes: ``resolved``, ``validator_mismatch`` (the latest earlier response has other validators), ``no_earlier_response``.
Defined cases: earlier means a smaller (time, id), so captures at the same time are in the order of their ids; a null URL or time never
matches; null headers count as none; rows equal in all columns that are read count once, others that share an id, or have
none, each count, and at the same time and id are in the order of a hash of the record; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.shared import written

# Query parameters that do not name a resource, and headers that a 304 must not update.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)"
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "etag", "keep-alive", "proxy-authenticate",
                "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a last slash, other than tracking parameters in order;
    no scheme, user or fragment. Null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?@]*@)?", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _tag(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Headers (maps, names in any case) of the stored response updated by a 304's; names in lower case, in order."""
    none = F.expr("cast(map() as map<string,string>)")
    low = lambda m: F.transform(F.map_entries(F.coalesce(m, none)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    new = F.filter(low(update), lambda e: ~e["key"].isin(*KEPT_HEADERS))
    names = F.transform(new, lambda e: e["key"])
    old = F.filter(low(stored), lambda e: ~F.array_contains(names, e["key"]))
    return F.map_from_entries(F.array_sort(F.concat(old, new)))


def record_key(records: DataFrame, columns: list[str]) -> Column:
    """64-bit key of a record; maps count by their entries in order."""
    kinds = dict(records.dtypes)
    parts = [F.array_sort(F.map_entries(c)) if kinds[c].startswith("map") else F.col(c) for c in columns]
    return F.xxhash64(*[x for p in parts for x in (p, p.isNull())])


def resolve(records: DataFrame, payload: list[str], record_id: str = "record_id", url: str = "url", at: str = "captured_at") -> DataFrame:
    """``records(record_id, url, captured_at, status, etag, last_modified, headers, payload...)`` ->
    ``(record_id, canonical_url, captured_at, base_id, outcome, headers, payload...)``, a row for each revisit (status 304)."""
    key = record_key(records, list(dict.fromkeys([record_id, url, at, "status", "etag", "last_modified", "headers", *payload])))
    rows = records.select(F.col(record_id).alias("id"), key.alias("key"), canonical_url(F.col(url)).alias("canonical_url"), F.col(at).alias("at"), "status", "etag", "last_modified", "headers", *payload)
    lean = rows.where(F.col("status").isin(200, 304)).select("id", "key", "canonical_url", "at", "status", _tag(F.col("etag")).alias("etag"), F.trim("last_modified").alias("modified")).dropDuplicates(["id", "key"])
    dealt = written(lean.repartitionByRange("canonical_url", "at", "id", "key").withColumn("part", F.spark_partition_id()), "warc-dealt")
    full = F.when((F.col("status") == 200) & F.col("canonical_url").isNotNull() & F.col("at").isNotNull(), F.struct("at", "id", "key", "etag", "modified"))
    dealt = dealt.withColumn("full", full)
    within = Window.partitionBy("part", "canonical_url").orderBy("at", "id", "key").rowsBetween(Window.unboundedPreceding, -1)
    near = dealt.withColumn("near", F.last("full", ignorenulls=True).over(within)).where("status = 304")
    ends = dealt.where("full is not null").groupBy("canonical_url", "part").agg(F.max("full").alias("end"))
    parts = near.select("canonical_url", "part").distinct().join(ends, ["canonical_url", "part"], "full")
    across = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("before", F.last("end", ignorenulls=True).over(across)).where("canonical_url is not null and before is not null").select(F.col("canonical_url").alias("u"), F.col("part").alias("p"), "before")
    joined = near.join(carried, (near["canonical_url"] == carried["u"]) & (near["part"] == carried["p"]), "left")
    # a null URL or time has no earlier response
    base = F.when(F.col("canonical_url").isNotNull() & F.col("at").isNotNull(), F.coalesce("near", "before"))
    agree = (F.when(F.col("etag").isNotNull(), F.coalesce(F.col("etag") == F.col("base.etag"), F.lit(False)))
             .when(F.col("modified").isNotNull(), F.coalesce(F.col("modified") == F.col("base.modified"), F.lit(False))).otherwise(True))
    found = joined.withColumn("base", base).select("id", "key", "canonical_url", "at", F.when(F.col("base").isNull(), "no_earlier_response").when(agree, "resolved").otherwise("validator_mismatch").alias("outcome"), F.col("base.id").alias("base_id"), F.col("base.key").alias("base_key"))
    found = written(found, "warc-found")
    revisits = rows.where("status = 304").select(F.col("id").alias("own_id"), F.col("key").alias("own_key"), F.col("headers").alias("own_headers")).dropDuplicates(["own_id", "own_key"])
    stored = rows.where("status = 200").select(F.col("id").alias("stored_id"), F.col("key").alias("stored_key"), F.col("headers").alias("stored_headers"), *payload).dropDuplicates(["stored_id", "stored_key"])
    out = found.join(revisits, found["id"].eqNullSafe(revisits["own_id"]) & (found["key"] == revisits["own_key"]))
    out = out.join(stored, out["base_id"].eqNullSafe(stored["stored_id"]) & (out["base_key"] == stored["stored_key"]) & (out["outcome"] == "resolved"), "left")
    merged = F.when(F.col("outcome") == "resolved", merged_headers(F.col("stored_headers"), F.col("own_headers")))
    return out.select(F.col("id").alias("record_id"), "canonical_url", F.col("at").alias("captured_at"), "base_id", "outcome", merged.alias("headers"), *payload)


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl's records made from ``pages(page_id, url, html)``: each page is fetched four times. The first and, for every third page, the third
    fetch bring a body; the others are answered with 304, some with weak or other validators, and under another form of the URL."""
    body, n = F.coalesce(F.col("html"), F.lit("")), F.col("fetch")
    fresh = (n == 0) | ((n == 2) & (F.pmod("page_id", F.lit(3)) == 0))
    version = F.when((n >= 2) & (F.pmod("page_id", F.lit(3)) == 0), 2).otherwise(1)
    tag = F.concat(F.lit('"'), F.substring(F.md5(body), 1, 12), F.lit("-"), version.cast("string"), F.lit('"'))
    changed = F.pmod("page_id", F.lit(7)) == 3
    untagged = F.pmod("page_id", F.lit(5)) == 1
    etag = (F.when(fresh, tag).when(untagged, F.lit(None).cast("string")).when(changed & (n == 3), F.lit('"gone"')).otherwise(F.concat(F.lit("W/"), tag)))
    modified = F.concat(F.lit("day "), (F.col("page_id") + version).cast("string"))
    headers = F.when(fresh, F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), n.cast("string"), F.lit("Content-Length"), F.length(body).cast("string"))).otherwise(
        F.create_map(F.lit("Date"), n.cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Content-Length"), F.lit("0")))
    rows = pages.select("page_id", "url", "html", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("fetch"))
    seen = F.when(fresh | F.col("url").contains("?"), F.col("url")).otherwise(F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("?utm_source=recrawl")))
    return rows.select((F.col("page_id") * 4 + n).alias("record_id"), seen.alias("url"), (F.col("page_id") + n * 1_000_000).alias("captured_at"), F.when(fresh, 200).otherwise(304).alias("status"),
                       etag.alias("etag"), modified.alias("last_modified"), headers.alias("headers"), F.when(fresh, F.md5(body)).alias("payload_md5"), F.when(fresh, F.length(body)).alias("payload_chars"))
