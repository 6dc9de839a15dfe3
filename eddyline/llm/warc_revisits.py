"""WARC not-modified revisits resolved to the response they stand for.

A revisit has no body: the server said 304. Its original is the latest earlier full
response of the same canonical URL, found by an as-of join, if the validators agree; the
stored headers are then updated with those that a 304 may change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that describe the stored body, which a 304 must not change.
BODY_HEADERS = ("content-length", "content-encoding", "content-type", "content-range", "transfer-encoding")
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
DAY = 86_400


def canonical_url(url: Column) -> Column:
    """One form for addresses of one resource: no scheme, user, ``www.``, default port,
    fragment, tracking parameters, ``.html`` or final slash; host in lower case, other
    parameters in order. NULL for NULL and for what has no host."""
    bare = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\d*\.", "")
    path = F.regexp_extract(bare, r"(?s)^[^:/?]+://[^/?]*([^?]*)", 1)
    path = F.regexp_replace(path, r"(\.html?)?/*$", "")
    query = F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    full = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(host != "", full)


def _header(name: str) -> Column:
    return F.try_element_at(F.col("headers"), F.lit(name))


def _weak(tag: Column) -> Column:
    """Entity tags compare weakly here: a leading W/ does not count."""
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(captures: DataFrame, span: int = DAY) -> DataFrame:
    """``record_id, url_key, ts, original_id, outcome, headers`` for every revisit.

    ``captures(record_id, warc_type, status, url, ts, headers)``: ``ts`` in seconds,
    ``headers`` a map with names in lower case. Full responses are of type response and
    status 200; revisits are of type revisit.

    * ``resolved``: the original's validators agree. ETags decide where the revisit has
      one, else Last-Modified; a revisit without either trusts the latest response.
    * ``stale``: they do not agree; ``original_id`` says which response was the latest.
    * ``no_original``: no earlier response, or the url or time is missing.

    Strictly earlier counts; of responses at one second the largest record_id. Headers
    are the original's, with those of the revisit over them but for the ones that
    describe the body; NULL unless resolved. Record ids are unique; a repeated capture
    gives a repeated row.

    A busy URL is cut by time: the search inside a span of ``span`` seconds is one
    window, and each span's last response is handed on to later spans of that URL, one
    row for a span, so no task orders all captures of a URL.
    """
    full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    keyed = captures.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("bigint").alias("ts"),
        F.coalesce(full, F.lit(False)).alias("full"), (F.col("warc_type") == "revisit").alias("revisit"), "headers",
        _header("etag").alias("etag"), _header("last-modified").alias("modified"),
    ).filter("full OR revisit")
    usable = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    rows = keyed.filter(usable).withColumn("span", F.floor(F.col("ts") / span)).drop("headers")
    found = F.when(F.col("full"), F.struct("ts", "record_id", "etag", "modified"))
    inside = Window.partitionBy("url_key", "span").orderBy("ts", "full", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumn("here", F.last(found, ignorenulls=True).over(inside)).filter("revisit")
    earlier = Window.partitionBy("url_key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    handed = rows.groupBy("url_key", "span").agg(F.max(found).alias("newest")).select(
        "url_key", "span", F.last("newest", ignorenulls=True).over(earlier).alias("before")
    )
    met = here.join(handed, ["url_key", "span"], "left").withColumn("original", F.coalesce("here", "before"))
    agree = (
        F.when(F.col("etag").isNotNull(), F.coalesce(_weak(F.col("etag")) == _weak(F.col("original.etag")), F.lit(False)))
        .when(F.col("modified").isNotNull(), F.coalesce(F.col("modified") == F.col("original.modified"), F.lit(False)))
        .otherwise(F.lit(True))
    )
    outcome = F.when(F.col("original").isNull(), F.lit("no_original")).when(agree, F.lit("resolved")).otherwise(F.lit("stale"))
    judged = met.select("record_id", "url_key", "ts", F.col("original.record_id").alias("original_id"), outcome.alias("outcome"))
    lost = keyed.filter("revisit").filter(~usable).select(
        "record_id", "url_key", "ts", F.lit(None).cast(captures.schema["record_id"].dataType).alias("original_id"), F.lit("no_original").alias("outcome"),
    )
    # Headers travel once the pairs are known.
    stored = keyed.filter("full").select(F.col("record_id").alias("original_id"), F.col("headers").alias("old")).dropDuplicates(["original_id"])
    fresh = keyed.filter("revisit").select("record_id", F.col("headers").alias("new")).dropDuplicates(["record_id"])
    good = judged.filter("outcome = 'resolved'").join(stored, "original_id").join(fresh, "record_id", "left")
    empty = F.create_map().cast("map<string,string>")
    allowed = F.map_filter(F.coalesce("new", empty), lambda k, v: ~k.isin(*BODY_HEADERS))
    kept = F.map_filter(F.coalesce("old", empty), lambda k, v: ~F.map_contains_key(allowed, k))
    columns = ["record_id", "url_key", "ts", "original_id", "outcome"]
    resolved = good.select(*columns, F.map_concat(kept, allowed).alias("headers"))
    rest = judged.filter("outcome <> 'resolved'").unionByName(lost)
    return resolved.unionByName(rest.withColumn("headers", F.lit(None).cast("map<string,string>")))
