"""Not-modified revisits of a web archive, resolved to the response they confirm.

An as-of join by canonical URL finds the latest earlier full response; validators
are checked, and the stored headers are updated with those a 304 may change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.llm.url_filter import canonical
from litsieve.session import stored

# Header fields that describe the body or the connection; a 304 does not update them (fixed values).
KEPT_HEADERS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
HEADERS = "array<struct<name: string, value: string>>"


def header(headers: Column, name: str) -> Column:
    """First value of a header, names compared without case; null if it is absent."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def merged_headers(stored_headers: Column, fresh: Column) -> Column:
    """Stored headers, those that ``fresh`` may replace replaced by all of its values."""
    may = F.filter(F.coalesce(fresh, F.array().cast(HEADERS)), lambda h: ~F.lower(h["name"]).isin(*KEPT_HEADERS))
    names = F.transform(may, lambda h: F.lower(h["name"]))
    stay = F.filter(F.coalesce(stored_headers, F.array().cast(HEADERS)), lambda h: ~F.array_contains(names, F.lower(h["name"])))
    return F.concat(stay, may)


def latest_earlier(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """``record_id, response_id``: the last full row of the same key before each row.

    ``rows`` has key, captured_at, record_id and full.  Rows are range-partitioned
    and sorted by key and time, and stored with the number of their range.  Inside a
    range a window carries the last full row forward.  Only the first key of a range
    can go on from earlier ranges; the last full rows of those keys, a row per range
    and key, are carried over the ranges.  A URL with a third of all captures is thus
    spread over a third of the ranges.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "captured_at", "record_id"]
    placed = stored(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range", "key").orderBy("captured_at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.last(F.when(F.col("full"), F.col("record_id")), ignorenulls=True).over(inside))
    # At most one key per range.
    heads = placed.groupBy("range").agg(F.min("key").alias("key")).select("key").distinct()
    last = (
        placed.join(F.broadcast(heads), "key", "left_semi")
        .groupBy("key", "range")
        .agg(F.max_by(F.when(F.col("full"), F.col("record_id")), F.when(F.col("full"), F.struct("captured_at", "record_id"))).alias("last"))
    )
    over = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("key", "range", F.last("last", ignorenulls=True).over(over).alias("carried"))
    return near.join(carried, ["key", "range"], "left").select("record_id", F.coalesce("near", "carried").alias("response_id"), "full")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``record_id, response_id, outcome, headers, body`` for every revisit.

    ``records`` has record_id, url, captured_at, kind (response or revisit), status,
    headers (name and value) and body.  Full responses are responses of status 200.
    The outcome is ``resolved``, ``mismatch`` (the validators differ: entity tags are
    compared weakly, dates of last modification where a tag is missing), ``unvalidated``
    (the revisit has no validator to compare, the response is used all the same) or
    ``missing`` (no earlier response).  Only resolved and unvalidated revisits get the
    response's body and the merged headers; others keep their own headers.

    Responses are compared by time, then record_id, so ties have one answer.  Null
    URLs and URLs without ``://`` match nothing, nor do rows without a time.  Repeated
    record_ids are one record.  Empty tables give no rows.
    """
    chosen = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        F.col("url").cast("string").alias("url"),
        F.col("captured_at").cast("timestamp").alias("captured_at"),
        F.col("kind").cast("string").alias("kind"),
        F.col("status").cast("int").alias("status"),
        F.col("headers").cast(HEADERS).alias("headers"),
        F.col("body").cast("string").alias("body"),
    )
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))
    narrow = chosen.select(canonical(F.col("url")).alias("key"), "captured_at", "record_id", full.alias("full"))
    timed = narrow.where("key is not null and captured_at is not null").dropDuplicates(["record_id"])
    found = stored(latest_earlier(timed).where("not full and response_id is not null").select("record_id", "response_id"))
    revisits = chosen.where(F.col("kind") == "revisit").dropDuplicates(["record_id"]).select("record_id", F.col("headers").alias("fresh"))
    named = revisits.join(found, "record_id", "left")
    responses = chosen.where(full).select(F.col("record_id").alias("response_id"), F.col("headers").alias("held"), "body").dropDuplicates(["response_id"])
    # Revisits without a response stay out of the join, where they would all be one null key.
    alone = named.where("response_id is null").select("response_id", "record_id", "fresh")
    alone = alone.withColumns({"held": F.lit(None).cast(HEADERS), "body": F.lit(None).cast("string")})
    both = named.where("response_id is not null").join(responses, "response_id").unionByName(alone)

    def tag(headers: str) -> Column:
        return F.regexp_replace(header(F.col(headers), "etag"), "^W/", "")

    old_tag, new_tag = tag("held"), tag("fresh")
    old_date, new_date = header(F.col("held"), "last-modified"), header(F.col("fresh"), "last-modified")
    outcome = (
        F.when(F.col("response_id").isNull(), "missing")
        .when(old_tag.isNotNull() & new_tag.isNotNull(), F.when(old_tag == new_tag, "resolved").otherwise("mismatch"))
        .when(old_date.isNotNull() & new_date.isNotNull(), F.when(old_date == new_date, "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    judged = both.withColumn("outcome", outcome)
    used = F.col("outcome").isin("resolved", "unvalidated")
    return judged.select(
        "record_id",
        "response_id",
        "outcome",
        F.when(used, merged_headers(F.col("held"), F.col("fresh"))).otherwise(F.col("fresh")).alias("headers"),
        F.when(used, F.col("body")).alias("body"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Pages as an archive: a response each, and revisits before, after and with other validators.

    Pages whose URLs differ in tracking parameters, fragments or closing slashes are
    captures of one canonical URL.
    """
    base = F.col("page_id") * 60
    field = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    digest = F.md5(F.coalesce("html", F.lit("")))
    tag = F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("W/")).otherwise(F.lit("")), F.lit('"'), digest, F.lit('"'))
    date = F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    length = F.char_length(F.coalesce("html", F.lit(""))).cast("string")
    age = (F.col("page_id") % 100).cast("string")

    def record(step: int, seconds: int, kind: str, status: int, headers: Column, body: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 4 + step).alias("record_id"),
            F.timestamp_seconds(base + seconds).alias("captured_at"),
            F.lit(kind).alias("kind"),
            F.lit(status).alias("status"),
            headers.alias("headers"),
            body.alias("body"),
        )

    none = F.lit(None).cast("string")
    rows = F.array(
        record(0, 0, "response", 200, F.array(field("ETag", tag), field("Last-Modified", date), field("Content-Length", length), field("Age", F.lit("0"))), F.col("html")),
        record(1, -30, "revisit", 304, F.array(field("Age", age)), none),
        record(2, 1, "revisit", 304, F.array(field("etag", F.concat(F.lit('"'), digest, F.lit('"'))), field("content-length", F.lit("0")), field("age", age)), none),
        record(3, 2, "revisit", 304, F.array(field("last-modified", F.concat(F.lit("day "), (F.col("page_id") % 27).cast("string")))), none),
    )
    return pages.select("page_id", "url", "html").select("url", F.inline(rows))


def revisit_digest(resolved: DataFrame) -> DataFrame:
    text = F.array_join(F.transform("headers", lambda h: F.concat_ws("=", h["name"], h["value"])), ";")
    return resolved.select("record_id", "response_id", "outcome", text.alias("headers"), F.md5("body").alias("body_md5"))


ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id, url, html,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1, 's') AS query
  FROM pages
), keyed AS (
  SELECT page_id, coalesce(html, '') AS text, html, CASE WHEN contains(url, '://') THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(query, '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '&+', '&', 'g'), '\?&', '?', 'g'), '[?&]+$', '') END AS key
  FROM parts
), responses AS (
  SELECT key, page_id * 4 AS response_id, page_id * 60 AS at, html, md5(text) AS digest, page_id % 28 AS day, length(text) AS n,
    (CASE WHEN page_id % 2 = 0 THEN 'W/' ELSE '' END) || '"' || md5(text) || '"' AS tag
  FROM keyed
), revisits AS (
  SELECT key, page_id * 4 + 1 AS record_id, page_id * 60 - 30 AS at, NULL AS digest, NULL AS day, page_id % 100 AS age FROM keyed
  UNION ALL SELECT key, page_id * 4 + 2, page_id * 60 + 1, md5(text), NULL, page_id % 100 FROM keyed
  UNION ALL SELECT key, page_id * 4 + 3, page_id * 60 + 2, NULL, page_id % 27, NULL FROM keyed
), matched AS (
  SELECT v.*, r.response_id, r.html, r.digest AS held_digest, r.day AS held_day, r.n, r.tag,
    CASE WHEN r.response_id IS NULL THEN 'missing'
         WHEN v.digest IS NOT NULL THEN CASE WHEN v.digest = r.digest THEN 'resolved' ELSE 'mismatch' END
         WHEN v.day IS NOT NULL THEN CASE WHEN v.day = r.day THEN 'resolved' ELSE 'mismatch' END
         ELSE 'unvalidated' END AS outcome
  FROM revisits v ASOF LEFT JOIN responses r ON v.key = r.key AND v.at >= r.at
)
SELECT record_id, response_id, outcome,
  CASE WHEN outcome IN ('missing', 'mismatch') THEN
         CASE WHEN digest IS NOT NULL THEN 'etag="' || digest || '";content-length=0;age=' || age
              WHEN day IS NOT NULL THEN 'last-modified=day ' || day
              ELSE 'Age=' || age END
       WHEN digest IS NOT NULL THEN 'Last-Modified=day ' || held_day || ';Content-Length=' || n || ';etag="' || digest || '";age=' || age
       WHEN day IS NOT NULL THEN 'ETag=' || tag || ';Content-Length=' || n || ';Age=0;last-modified=day ' || day
       ELSE 'ETag=' || tag || ';Last-Modified=day ' || held_day || ';Content-Length=' || n || ';Age=' || age END AS headers,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN md5(html) END AS body_md5
FROM matched
"""
