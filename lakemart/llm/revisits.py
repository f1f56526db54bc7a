"""Operator 3 — resolve not-modified WARC revisits.

Native DataFrame code.  A revisit record (``304``) has no body; it stands for the
latest full response to the same canonical URL that is strictly earlier.

As-of join without collecting a URL's captures in one task: the records are
range-partitioned on (canonical URL, time) and written once; inside each
(URL, partition) a running maximum finds the latest earlier response, and one
carried maximum per (URL, partition) supplies it across partition bounds.  A
URL with a third of all captures therefore spreads over many partitions.

The found response counts when the validators agree: strong comparison is not needed for a
304, so ``W/`` is ignored in entity tags; tags decide if both have one, else
``last_modified`` if both have one.  Then the permitted headers of the
revisit replace those of the response (the header list is a parameter).

``status``: ``resolved``, ``mismatch`` (validators differ), ``unverified`` (no
validator on both sides), ``no_base`` (no earlier response).

Defined cases: a null url or time has no base; responses at the same time: the
largest ``record_id`` counts; repeated rows each get their own result; null headers
count as none; an empty table gives an empty result.  Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import ascii_lower
from lakemart.llm.prefix import PART, range_parts
from lakemart.llm.reputation import url_host, url_path

#: Header fields that a 304 response may update (RFC 9110, 15.4.5, with Last-Modified).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not change the resource.
TRACKING = r"^(utm_[a-z]*|gclid|fbclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host (lower-case, without ``www.`` and default port), path without trailing slash, query without
    tracking parameters and in sorted order; no scheme, no fragment."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~ascii_lower(x).rlike(TRACKING)))
    return F.when(F.instr(url, "://") > 0,
                  F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """``records``: ``record_id``, ``url``, ``ts`` (long), ``kind`` (``response``/``revisit``), ``etag``,
    ``last_modified``, ``headers`` (map, lower-case names).  One row per revisit: ``record_id``, ``canonical_url``,
    ``ts``, ``status``, ``base_record_id``, ``base_ts``, ``headers`` (merged map; null unless resolved)."""
    entries = F.array_sort(F.map_entries(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>"))))
    r = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"),
                       "kind", "etag", "last_modified", entries.alias("headers"))
    parts = range_parts(r, [F.col("canonical_url"), F.col("ts")], "revisits")
    full = F.when((F.col("kind") == "response") & F.col("ts").isNotNull() & F.col("canonical_url").isNotNull(),
                  F.struct("ts", "record_id", "etag", "last_modified", "headers"))
    # the maximum of the structs is the latest response, the largest id first among equals
    earlier = Window.partitionBy("canonical_url", PART).orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    carried = Window.partitionBy("canonical_url").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    lasts = parts.where("canonical_url is not null").groupBy("canonical_url", PART).agg(F.max(full).alias("_last"))
    base = lasts.select("canonical_url", PART, F.max("_last").over(carried).alias("_carried"))
    found = (parts.withColumn("_near", F.max(full).over(earlier)).where("kind = 'revisit'")
             .join(base, ["canonical_url", PART], "left")
             .withColumn("base", F.when(F.col("ts").isNotNull() & F.col("canonical_url").isNotNull(),
                                        F.coalesce("_near", "_carried"))))
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    status = (F.when(F.col("base").isNull(), "no_base")
              .when(F.col("etag").isNotNull() & F.col("base.etag").isNotNull(),
                    F.when(tag(F.col("etag")) == tag(F.col("base.etag")), "resolved").otherwise("mismatch"))
              .when(F.col("last_modified").isNotNull() & F.col("base.last_modified").isNotNull(),
                    F.when(F.col("last_modified") == F.col("base.last_modified"), "resolved").otherwise("mismatch"))
              .otherwise("unverified"))
    allowed = F.array(*(F.lit(x) for x in permitted)).cast("array<string>")
    news = F.map_filter(F.map_from_entries("headers"), lambda k, _: F.array_contains(allowed, k))
    merged = F.map_concat(F.map_filter(F.map_from_entries("base.headers"), lambda k, _: ~F.map_contains_key(news, k)), news)
    return (found.withColumn("status", status)
            .select("record_id", "canonical_url", "ts", "status", F.col("base.record_id").alias("base_record_id"),
                    F.col("base.ts").alias("base_ts"),
                    F.when(F.col("status") == "resolved", merged).alias("headers")))
