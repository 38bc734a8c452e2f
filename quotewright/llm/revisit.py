"""WARC not-modified revisits: an as-of join by canonical URL to the latest earlier full response."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields that a 304 response may update in the stored one.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not name content.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www., default port, fragment, trailing slash and tracking; sorted parameters."""
    rest = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = "^(?:[A-Za-z][A-Za-z0-9+.-]*://)?"
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, scheme + "([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, scheme + "[^/?]*([^?]*)", 1), "/+$", "")
    params = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    params = F.array_sort(F.filter(params, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def _named(headers: Column) -> Column:
    """Header names in lower case, as sorted entries."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.array_sort(F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>")))


def resolve_revisits(records: DataFrame, buckets: int | None = None) -> DataFrame:
    """The revisits of ``records`` with canonical_url, resolved_id, verdict, headers and payload.

    ``records``: record_id long, url, ts long, kind ('response' or 'revisit'), etag, last_modified, headers
    map<string,string>, payload (a digest or place of the body). The candidate is the response of the same canonical
    URL with the largest ts below the revisit's; ties go to the larger record_id. Verdicts: 'etag' and
    'last-modified' (that validator agrees; entity tags are compared weakly and come first), 'mismatch', 'no-validator'
    (none that both have), 'no-response'. Only the first two are resolved: their headers are the
    response's, updated by the revisit's permitted fields; other revisits keep their own headers.

    A URL's records are dealt to spans of time, so that no URL's history is in one task: each span's last
    response is carried to the spans after it. A null URL or time has no response; rows of other kinds and repeated
    rows of a kind are kept apart by their place in the order; other columns are dropped.
    """
    text = lambda c: F.col(c).cast("string")
    own = records.where("kind IN ('response', 'revisit')").select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(text("url")).alias("url"), F.col("ts").cast("long").alias("ts"), "kind",
        text("etag").alias("etag"), text("last_modified").alias("last_modified"), _named(F.col("headers")).alias("headers"), text("payload").alias("payload"),
    )
    n, low, high = own.agg(F.count("*"), F.min("ts"), F.max("ts")).first()
    buckets = buckets or max(16, math.isqrt(n))
    width = max(1, ((high or 0) - (low or 0)) // buckets + 1)
    own = own.withColumn("span", F.expr(f"(ts - {low or 0}L) div {width}L"))
    answer = F.struct("ts", "record_id", "etag", "last_modified", "headers", "payload")
    response = F.when((F.col("kind") == "response") & F.col("url").isNotNull() & F.col("ts").isNotNull(), answer)
    spans = own.where("kind = 'response'").groupBy("url", "span").agg(F.max(response).alias("last"))
    # spans with revisits need a row too; a span has one row, whatever it holds
    spans = spans.unionByName(own.where("kind = 'revisit'").select("url", "span", F.lit(None).cast(spans.schema["last"].dataType).alias("last")).distinct())
    spans = spans.groupBy("url", "span").agg(F.max("last").alias("last"))
    past = Window.partitionBy("url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("url", "span", F.max("last").over(past).alias("carried"))
    before = Window.partitionBy("url", "span").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    found = own.withColumn("inside", F.max(response).over(before)).where("kind = 'revisit'")
    found = found.join(carried, ["url", "span"], "left").withColumn("c", F.coalesce("inside", "carried"))
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    tags = F.col("etag").isNotNull() & F.col("c.etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("c.last_modified").isNotNull()
    verdict = (
        F.when(F.col("c").isNull(), "no-response")
        .when(tags, F.when(weak("etag") == weak("c.etag"), "etag").otherwise("mismatch"))
        .when(dates, F.when(F.col("last_modified") == F.col("c.last_modified"), "last-modified").otherwise("mismatch"))
        .otherwise("no-validator")
    )
    permitted = F.array(*map(F.lit, PERMITTED))
    fresh = F.filter("headers", lambda e: F.array_contains(permitted, e["key"]))
    stored = F.filter("c.headers", lambda e: ~F.array_contains(F.transform(fresh, lambda x: x["key"]), e["key"]))
    ok = F.col("verdict").isin("etag", "last-modified")
    return found.withColumn("verdict", verdict).select(
        "record_id",
        F.col("url").alias("canonical_url"),
        "ts",
        F.when(ok, F.col("c.record_id")).alias("resolved_id"),
        "verdict",
        F.when(ok, F.array_sort(F.concat(stored, fresh))).otherwise(F.col("headers")).alias("headers"),
        F.when(ok, F.col("c.payload")).alias("payload"),
    )
