"""Not-modified revisits of a web archive, resolved by an as-of join.

A revisit takes the payload of the latest earlier full response of its canonical URL, if the validators agree, and that
response's headers with those of its own that a not-modified answer may update.  The as-of join moves record names and
validators only: rows get a time bucket of even size, a window finds the last response within (URL, bucket), and the last
responses of earlier buckets are carried over, so one URL that holds much of the archive is spread over the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions.ranking import quantile_buckets
from cohortlift.session import materialise

BUCKET_ROWS = 500_000
#: Fields that a not-modified answer must not change (hop by hop, or describing the stored payload).
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query arguments that name a visit and not a page.
VISIT_ARGUMENTS = r"^(utm_[a-z]+|ref|gclid|fbclid|sessionid|phpsessid|jsessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, user, ``www.``, default port, fragment and closing slash; other arguments sorted."""
    text = F.regexp_replace(F.trim(url.cast("string")), "#.*$", "")
    text = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    before = F.regexp_extract(text, r"^([^?]*)", 1)
    host = F.lower(F.regexp_extract(before, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(before, r"^[^/]*(/.*)$", 1), "/+$", "")
    query = F.regexp_extract(text, r"\?(.*)$", 1)
    arguments = F.array_sort(F.filter(F.split(query, "&"), lambda a: (a != "") & ~F.lower(a).rlike(VISIT_ARGUMENTS)))
    tail = F.when(F.size(arguments) > 0, F.concat(F.lit("?"), F.array_join(arguments, "&"))).otherwise("")
    return F.when(url.isNotNull() & (host != ""), F.concat(host, path, tail))


def _fields(headers: Column) -> Column:
    """Headers by lower-case name; of a name that is given twice the last value."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("k"), F.trim(e["value"]).alias("v")))
    names = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    last = F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: e["k"] == n), -1)["v"])
    return F.coalesce(F.map_from_arrays(names, last), F.create_map().cast("map<string,string>"))


def merged(stored: Column, update: Column) -> Column:
    """Stored headers, updated by the permitted ones."""
    allowed = F.map_filter(update, lambda k, v: v.isNotNull() & ~k.isin(*KEPT_FIELDS))
    rest = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(rest, allowed)


def _etag(headers: Column) -> Column:
    """Entity tag for weak comparison."""
    return F.nullif(F.regexp_replace(F.element_at(headers, "etag"), "^W/", ""), F.lit(""))


def _agrees(stored_etag: Column, stored_date: Column, etag: Column, date: Column) -> Column:
    """Both have a tag: equal tags.  Otherwise: equal dates of last modification.  Nothing to compare: no agreement."""
    by_tag = etag.isNotNull() & stored_etag.isNotNull()
    return F.coalesce(F.when(by_tag, etag == stored_etag).otherwise(date == stored_date), F.lit(False))


def resolve_revisits(
    records: DataFrame,
    id_col: str = "record_id",
    type_col: str = "record_type",
    url_col: str = "url",
    time_col: str = "ts",
    headers_col: str = "headers",
    payload_col: str = "payload",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(record_id, url_key, state, source_id, headers, payload)``, a row per record.

    Types are ``response`` and ``revisit``; others pass as ``other``.  A response's source is itself.  A revisit is
    ``resolved``, or without source, headers as they are and a null payload: ``mismatch`` if validators disagree,
    ``missing`` if no earlier response has its URL (or URL or time is null).  Earlier means a smaller time; of responses at
    one time the largest id counts.  Ids must be unique among responses.  Other columns are not looked at.
    """
    rows = records.select(
        F.col(id_col).alias("id"), F.col(type_col).alias("type"), canonical_url(F.col(url_col)).alias("key"),
        F.col(time_col).cast("double").alias("ts"), _fields(F.col(headers_col)).alias("headers"), F.col(payload_col).alias("payload"),
    )
    narrow = rows.select(
        "id", "type", "key", "ts", _etag(F.col("headers")).alias("etag"),
        F.nullif(F.element_at(F.col("headers"), "last-modified"), F.lit("")).alias("modified"),
    )
    known = materialise(narrow.where("key IS NOT NULL AND ts IS NOT NULL AND NOT isnan(ts) AND type IN ('response', 'revisit')"), "captures")
    buckets = -(-known.count() // bucket_rows)
    known = quantile_buckets(known, {"ts": "b"}, buckets) if buckets > 1 else known.withColumn("b", F.lit(0))
    response = F.when(F.col("type") == "response", F.struct("id", "etag", "modified"))
    known = known.withColumn("response", response)
    inside = Window.partitionBy("key", "b").orderBy("ts", F.col("type") == "response", "id").rowsBetween(Window.unboundedPreceding, 0)
    found = known.withColumn("last", F.last("response", ignorenulls=True).over(inside)).where("type = 'revisit'")
    ends = known.groupBy("key", "b").agg(F.max_by("response", F.when(F.col("type") == "response", F.struct("ts", "id"))).alias("end"))
    earlier = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "b", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    found = found.join(carried, ["key", "b"]).withColumn("source", F.coalesce("last", "carried"))
    agrees = _agrees(F.col("source.etag"), F.col("source.modified"), F.col("etag"), F.col("modified"))
    state = F.when(F.col("source").isNull(), "missing").when(agrees, "resolved").otherwise("mismatch")
    found = found.select(F.col("id").alias("_id"), state.alias("_state"), F.when(agrees, F.col("source.id")).alias("_source"))

    revisits = rows.where("type = 'revisit'").join(found, F.col("id") == F.col("_id"), "left")
    stored = rows.where("type = 'response'").select(F.col("id").alias("_from"), F.col("headers").alias("_headers"), F.col("payload").alias("_payload"))
    revisits = revisits.join(stored, F.col("_source") == F.col("_from"), "left")
    resolved = revisits.select(
        "id", "key", F.coalesce("_state", F.lit("missing")).alias("state"), F.col("_from").alias("source"),
        F.when(F.col("_from").isNotNull(), merged(F.col("_headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
        F.col("_payload").alias("payload"),
    )
    others = rows.where("type IS NULL OR type <> 'revisit'").select(
        "id", "key", F.when(F.col("type") == "response", "response").otherwise("other").alias("state"),
        F.when(F.col("type") == "response", F.col("id")).alias("source"), "headers", "payload",
    )
    out = resolved.union(others)
    return out.toDF(id_col, "url_key", "state", "source_id", headers_col, payload_col)


def records_of_pages(pages: DataFrame) -> DataFrame:
    """An archive out of ``pages``: a full response of every page, and a later revisit of it.

    Tags and dates follow the page; a quarter of the revisits holds a stale tag, an eighth a date only.
    """
    n, i = F.length("html"), F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html").cast("binary")), 1, 16), F.lit('"'))
    text = lambda c: c.cast("string")
    response = F.struct(
        (i * 2).alias("record_id"), F.lit("response").alias("record_type"), F.col("url").alias("url"), (i * 60).alias("ts"),
        F.create_map(
            F.lit("ETag"), F.when(i % 5 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag), F.lit("Last-Modified"), text(i),
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), text(n), F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.col("html").alias("payload"),
    )
    at = i * 60 + 30 + 60 * (i % 7)
    revisit = F.struct(
        (i * 2 + 1).alias("record_id"), F.lit("revisit").alias("record_type"), F.concat("url", F.lit("#again")).alias("url"), at.alias("ts"),
        F.create_map(
            F.lit("etag"), F.when(i % 8 == 1, F.lit(None)).when(i % 4 == 3, F.lit('"stale"')).otherwise(tag), F.lit("last-modified"), text(i),
            F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-length"), F.lit("0"), F.lit("connection"), F.lit("close"), F.lit("date"), text(at),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")
