"""URL filter: rules for hosts and paths, then a list of canonical URLs.

A blocked Bloom filter of the listed URLs passes possible hits to an exact hash
join that removes false positives.  Most URLs are settled by the filter, without
a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.llm.bloom import build_filter, may_be_listed
from litsieve.llm.common import columns

# verdict, host, path
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, and the query without tracking parameters.

    Null for null and for strings without ``://``.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(query, r"([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(query, "&+", "&"), r"\?&", "?")
    query = F.regexp_replace(query, "[?&]+$", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(host, path, query))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value) -> Column:
    """``value`` of the longest rule that fits, else null; among equally long ones the first."""
    found = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        _, name, start = rule
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, listed, verdict`` for every row of ``pages``.

    ``listed`` holds URLs in a column ``url``; they are compared in canonical form.
    A rule decides where one fits, the longest first; else listed URLs are blocked
    and others allowed.  Null URLs and strings without ``://`` have an empty host and
    path and are allowed.  Repeated rows are judged one by one; an empty list blocks
    nothing.
    """
    keys = columns(listed, url="string").select(canonical(F.col("url")).alias("key")).where("key is not null").distinct()
    probe = may_be_listed(pages.sparkSession, build_filter(keys, "key"))
    split = columns(pages, page_id="long", url="string").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("key")
    )
    probed = split.withColumn("maybe", probe(F.xxhash64("key")) & F.col("key").isNotNull())
    hits = probed.where("maybe").join(keys.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "key", "left")
    others = probed.where("not maybe").withColumn("listed", F.lit(False))
    both = hits.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(others)
    verdict = fitting_rule(F.col("host"), F.col("path"), rules, lambda r: r[0])
    rule = fitting_rule(F.col("host"), F.col("path"), rules, lambda r: r[1] + r[2])
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return both.select("page_id", "host", "path", rule.alias("rule"), "listed", F.coalesce(verdict, method).alias("verdict"))


# Words by which the example list picks hosts (fixed values).
LISTED_HOST_WORDS = ("casino", "poker", "pills", "lottery")


def gambling_list(pages: DataFrame) -> DataFrame:
    """URLs of a crawl whose host holds a listed word: the block list of the query."""
    return columns(pages, url="string").where(host_of(F.col("url")).rlike("|".join(LISTED_HOST_WORDS)))


ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1, 's') AS query
  FROM pages
), keyed AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(query, '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '&+', '&', 'g'), '\?&', '?', 'g'), '[?&]+$', '') END AS key
  FROM parts
), listed AS (
  SELECT DISTINCT key FROM keyed WHERE key IS NOT NULL AND regexp_matches(host, 'casino|poker|pills|lottery')
), ruled AS (
  SELECT page_id, host, path, key IS NOT NULL AND key IN (SELECT key FROM listed) AS listed,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM keyed
)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
