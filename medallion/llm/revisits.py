"""Resolution of not-modified revisits in web captures.

Method: an as-of join by canonical URL gives each revisit the latest earlier full response of
its URL. The revisit holds if its validators agree: entity tags where both have one, else last
modification, else payload digests. Then the response's headers are updated by those that a
304 answer may carry.

A URL may have any share of the captures: rows are windowed by URL and time bucket, so a hot
URL is spread over its buckets, and what a bucket takes over from earlier ones comes from a
second window over one row per URL and bucket. Bodies are never moved; a resolved revisit
names the record that has it. Built-in expressions only.

Defined cases: "earlier" is strictly earlier, and of several responses at one time the one with
the largest id counts; a null URL or time is never resolved; null validators do not compare; a
repeated revisit row is resolved each time; null headers are empty; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header fields of a 304 answer that update the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
BUCKET_SECONDS = 3600


def canonical_url(url: Column) -> Column:
    """Host in lower case without user, ``www.`` and default port, then path without trailing
    slashes, then the query sorted and without tracking parameters; no scheme or fragment."""
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(whole, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", "")
    host = F.regexp_replace(host, "^www\\.", "")
    rest = F.regexp_replace(whole, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(F.regexp_replace(rest, "\\?.*$", ""), "/+$", "")
    query = F.regexp_extract(rest, "\\?(.*)$", 1)
    fields = F.array_sort(
        F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike("^(utm_[a-z]+|ref|fbclid|gclid)="))
    )
    return F.concat(
        host, path, F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise("")
    )


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` with the permitted fields of ``update`` put in their place."""
    empty = F.create_map().cast("map<string,string>")
    stored, update = F.coalesce(stored, empty), F.coalesce(update, empty)
    allowed = F.map_filter(update, lambda name, _: F.lower(name).isin(*PERMITTED))
    names = F.transform(F.map_keys(allowed), F.lower)
    rest = F.map_filter(stored, lambda name, _: ~F.array_contains(names, F.lower(name)))
    return F.map_concat(rest, allowed)


def resolve_revisits(captures: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """A row per revisit: its ``record_id``, ``url`` (canonical), ``ts``, ``refers_to`` (the
    response, null if there is none), ``outcome`` and, where resolved, ``payload_digest`` and
    ``headers``.

    ``captures``: record_id, url, ts (seconds), is_revisit, etag, last_modified, payload_digest
    and headers (a map).
    """
    full = F.when(
        ~F.col("is_revisit"),
        F.struct("record_id", "etag", "last_modified", "payload_digest", "headers"),
    )
    rows = captures.select(
        "record_id",
        canonical_url(F.col("url")).alias("url"),
        F.col("ts").cast("long").alias("ts"),
        F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"),
        "etag",
        "last_modified",
        "payload_digest",
        "headers",
    )
    known = rows.where("url is not null and ts is not null").select(
        "*", F.floor(F.col("ts") / bucket_seconds).alias("bucket"), full.alias("full")
    )
    # at one time revisits come first, so that they see strictly earlier responses only
    within = (
        Window.partitionBy("url", "bucket")
        .orderBy("ts", F.col("is_revisit").desc(), "record_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = known.select("*", F.last("full", ignorenulls=True).over(within).alias("near")).where("is_revisit")
    latest = known.groupBy("url", "bucket").agg(
        F.max_by("full", F.when(~F.col("is_revisit"), F.struct("ts", "record_id"))).alias("latest")
    )
    earlier = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("url", "bucket", F.last("latest", ignorenulls=True).over(earlier).alias("far"))
    found = seen.join(carried, ["url", "bucket"], "left").select(
        *rows.columns, F.coalesce("near", "far").alias("full")
    )
    unplaced = rows.where("is_revisit and (url is null or ts is null)")
    found = found.unionByName(unplaced, allowMissingColumns=True)

    same = (
        F.when(F.col("etag").isNotNull() & F.col("full.etag").isNotNull(), F.col("etag") == F.col("full.etag"))
        .when(
            F.col("last_modified").isNotNull() & F.col("full.last_modified").isNotNull(),
            F.col("last_modified") == F.col("full.last_modified"),
        )
        .otherwise(F.coalesce(F.col("payload_digest") == F.col("full.payload_digest"), F.lit(False)))
    )
    outcome = (
        F.when(F.col("full").isNull(), "no_earlier_response").when(same, "resolved").otherwise("validator_mismatch")
    )
    resolved = outcome == "resolved"
    return found.select(
        "record_id",
        "url",
        "ts",
        F.col("full.record_id").alias("refers_to"),
        outcome.alias("outcome"),
        F.when(resolved, F.col("full.payload_digest")).alias("payload_digest"),
        F.when(resolved, merged_headers(F.col("full.headers"), F.col("headers"))).alias("headers"),
    )


def header_lines(headers: Column) -> Column:
    """Headers as sorted ``name: value`` lines."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(F.lower(e["key"]), F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")
