"""WARC: resolution of not-modified revisits.

A revisit (status 304) stands for the body of an earlier full response of the same canonical URL. It is joined as of its time to
the latest earlier full response; validators are checked (entity tags by weak comparison, else modification dates), and the
stored headers are updated by those of the revisit that may be.

Scale. The join works on narrow rows cut into ranges of (URL, time): a URL with a third of all captures is spread over
many tasks. Bodies stay where they are: a result names the record that holds the body, with its digest.

Defined cases. Without an earlier full response the outcome is ``orphan``; with validators that differ ``mismatch``; with
none to compare ``unvalidated``; only ``resolved`` takes over body and headers. A null or malformed URL has no canonical form
and meets nothing. At equal times the smaller record id is earlier. Repeated rows are equal records; a full response is not its
own source. Null headers are none; a line without a colon is a name without value. Names are compared in lower case,
repeated names are joined by a comma. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.asof import latest_earlier

NOT_MODIFIED = 304
# Header fields that a not-modified response does not update.
NOT_UPDATED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)([^?#]*)([?]([^#]*))?(#.*)?$"


def canonical_url(url: Column) -> Column:
    """Host, path and sorted query without scheme, fragment, default port, trailing slash and tracking parameters."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, ADDRESS, 1)), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, ADDRESS, 2), "/+$", "")
    kept = F.filter(F.split(F.regexp_extract(url, ADDRESS, 4), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(url.rlike(ADDRESS), F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def parsed(headers: Column) -> Column:
    """Header lines as an array of (name, value)."""
    lines = F.filter(F.split(F.coalesce(headers, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    return F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
        F.trim(F.regexp_replace(x, "^[^:]*:?", "")).alias("value"),
    ))


def joined_lines(pairs: Column) -> Column:
    """One line per name, in order of the names."""
    names = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["name"])))
    return F.array_join(F.transform(names, lambda n: F.concat(n, F.lit(": "), F.array_join(F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", "))), "\n")


def merged_headers(stored: Column, revisit: Column) -> Column:
    """Stored headers, updated by those of the revisit that may be."""
    update = F.filter(parsed(revisit), lambda p: ~p["name"].isin(NOT_UPDATED))
    kept = F.filter(parsed(stored), lambda p: ~F.exists(update, lambda u: u["name"] == p["name"]))
    return joined_lines(F.concat(kept, update))


def weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolved(records: DataFrame) -> DataFrame:
    """record_id, url_key, ts, outcome, source_id, digest, body_bytes, headers of every record.

    ``records``: record_id, url, ts (long), status, etag, last_modified, headers (text), digest and body_bytes of the body.
    """
    is_full = F.col("status").between(200, 299)
    narrow = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "status", "etag", "last_modified", "headers", "digest", "body_bytes")
    found = latest_earlier(narrow, "url_key", ["ts", "record_id"], is_full, ["record_id", "etag", "last_modified", "headers", "digest", "body_bytes"], "source")
    source = F.col("source")
    same_tag = weak(F.col("etag")) == weak(source["etag"])
    same_date = F.col("last_modified") == source["last_modified"]
    outcome = (
        F.when(is_full, F.lit("response")).when(F.coalesce(F.col("status"), F.lit(0)) != NOT_MODIFIED, F.lit("other"))
        .when(source.isNull(), F.lit("orphan"))
        .when(F.coalesce(same_tag, same_date).isNull(), F.lit("unvalidated"))
        .when(F.coalesce(same_tag, same_date), F.lit("resolved")).otherwise(F.lit("mismatch"))
    )
    told = found.withColumn("outcome", outcome)
    taken = F.col("outcome") == "resolved"

    def own_or_source(name: str) -> Column:
        return F.when(taken, source[name]).when(is_full, F.col(name))

    return told.select(
        "record_id", "url_key", "ts", "outcome",
        F.when(F.col("outcome").isin("resolved", "mismatch", "unvalidated"), source["record_id"]).alias("source_id"),
        own_or_source("digest").alias("digest"), own_or_source("body_bytes").alias("body_bytes"),
        F.when(taken, merged_headers(source["headers"], F.col("headers"))).otherwise(joined_lines(parsed(F.col("headers")))).alias("headers"),
    )
