"""WARC not-modified revisits resolved against the latest earlier full response.

A revisit record says "not modified" and carries no body. It belongs to the latest full
response of the same canonical URL whose time is earlier; it is resolved when one of its
validators (ETag, else Last-Modified) equals the response's, and it then takes over the
response's body digest and headers, where only the headers that such an answer may
update are replaced by its own.

The as-of join runs in two steps so that a URL with a third of all records is never sorted
in one place: times are cut into spans; the last response of each (URL, span) is found by
an aggregation that starts before the exchange; a window over these few rows carries it into later spans; within a
(URL, span) a window finds the latest response before each revisit. Bodies stay where they
are: a resolved revisit names the record that holds its body.

Canonical URL: lower-case scheme and host, ``http`` as ``https``, without ``www.``, default port,
fragment, tracking parameters (``utm_*``, ``ref``), trailing slash and ``.html``.

Defined results: records with a null URL or time are never resolved (``no_url`` or ``no_time``);
of several responses at one time the greatest record id counts, and a response at the
revisit's own time is not earlier; a null validator equals nothing; repeated records are
resolved one by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer may update (a fixed list of the HTTP standard).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), r"(?i)^https?://(www\.)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"(\.html)?/?$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref)(=|$)")
    )), "&")
    return F.concat(F.lit("https://"), host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def merged_headers(old: Column, new: Column) -> Column:
    """The response's headers, the permitted ones replaced by those of the revisit."""
    mine = F.map_filter(new, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(mine), k)), mine)


def resolve(records: DataFrame, span: int) -> DataFrame:
    """``records``: record_id, type (``response`` or ``revisit``), url, time (long), headers
    (map of lower-case names), body_digest. ``span``: the length of a time span, in the unit
    of ``time``; any length gives the same result, a span should hold few enough records of
    one URL for one task.

    Per revisit: record_id, canonical_url, time, refers_to, status (``resolved``, ``changed``,
    ``no_earlier``, ``no_url``, ``no_time``), body_digest and headers (null unless resolved)."""
    rows = records.select(
        "record_id", (F.col("type") == "response").alias("full"), F.col("time").cast("long").alias("time"),
        canonical_url(F.col("url")).alias("url"), "headers", "body_digest",
        F.array_sort(F.map_entries("headers")).alias("entries"),
    )
    usable = rows.filter("url IS NOT NULL AND time IS NOT NULL").withColumn("span", F.floor(F.col("time") / span))
    state = F.struct("time", "record_id", "body_digest", "entries")  # a map has no order, its entries have
    lasts = usable.filter("full").groupBy("url", "span").agg(F.max(state).alias("state"))
    wanted = usable.filter("NOT full").select("url", "span").distinct()
    marks = lasts.unionByName(wanted.withColumn("state", F.lit(None).cast(lasts.schema["state"].dataType)))
    by_span = Window.partitionBy("url").orderBy("span").rangeBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("before", F.max("state").over(by_span)).filter("state IS NULL").select(
        "url", "span", "before"
    )
    inside = Window.partitionBy("url", "span").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    found = usable.withColumn("own", F.max(F.when(F.col("full"), state)).over(inside)).filter("NOT full")
    joined = found.join(carried, ["url", "span"], "left").withColumn("source", F.coalesce("own", "before")).withColumn(
        "old", F.map_from_entries("source.entries")
    )
    tag, old_tag = F.col("headers")["etag"], F.col("old")["etag"]
    date, old_date = F.col("headers")["last-modified"], F.col("old")["last-modified"]
    same = F.when(tag.isNotNull(), tag == old_tag).otherwise(date == old_date)
    ok = F.coalesce(same, F.lit(False))
    resolved = joined.select(
        "record_id", F.col("url").alias("canonical_url"), "time",
        F.col("source.record_id").alias("refers_to"),
        F.when(F.col("source").isNull(), "no_earlier").when(ok, "resolved").otherwise("changed").alias("status"),
        F.when(ok, F.col("source.body_digest")).alias("body_digest"),
        F.when(ok, merged_headers(F.col("old"), F.coalesce("headers", F.create_map().cast("map<string,string>")))).alias("headers"),
    )
    unusable = rows.filter("NOT full AND (url IS NULL OR time IS NULL)").select(
        "record_id", F.col("url").alias("canonical_url"), "time",
        F.lit(None).cast(rows.schema["record_id"].dataType).alias("refers_to"),
        F.when(F.col("url").isNull(), "no_url").otherwise("no_time").alias("status"),
        F.lit(None).cast(rows.schema["body_digest"].dataType).alias("body_digest"),
        F.lit(None).cast("map<string,string>").alias("headers"),
    )
    return resolved.unionByName(unusable)
