"""Article links from HTML listing pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.functions.identifiers import resolve_url
from litsieve.functions.text import decode_entities, strip_ends, text_or_empty
from litsieve.schemas import FEED_COLUMNS
from litsieve.sources.feeds import SOURCE_COLUMNS

_IGNORED = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
_ATTRIBUTES = r"""^((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
_HREF = r"""(?is)(?:^|[\s"'/])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# Stands for the gap between two text parts while they are still joined.
_GAP = "\x01"


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor: ``link_pos``, ``href`` and ``link_text``.

    The page is cut at each anchor start, so an anchor inside another one
    restarts the text and an anchor that never closes gives no row.  Text parts
    between inner tags are trimmed and joined by a blank.
    """
    body = F.regexp_replace(F.col(html), _IGNORED, "")
    cuts = F.split(body, r"(?i)<a(?=[\s>/])")
    anchors = F.slice(cuts, F.lit(2), F.greatest(F.size(cuts) - 1, F.lit(0)))
    parsed = F.transform(anchors, _anchor)
    rows = pages.select("*", F.posexplode(parsed).alias("link_pos", "anchor")).where(
        F.col("anchor.closed") & F.col("anchor.href").isNotNull()
    )
    decoded = rows.withColumns(
        {
            "href": decode_entities("anchor.href"),
            "link_text": decode_entities("anchor.inner"),
        }
    )
    parts = F.filter(F.transform(F.split("link_text", _GAP), strip_ends), lambda part: part != "")
    return decoded.withColumn("link_text", F.array_join(parts, " ")).drop("anchor")


def _anchor(cut: Column) -> Column:
    attributes = F.regexp_extract(cut, _ATTRIBUTES, 1)
    inner = F.regexp_replace(F.regexp_replace(cut, _ATTRIBUTES, ""), r"(?is)</a\s*>.*$", "")
    href = F.concat(*(F.regexp_extract(attributes, _HREF, group) for group in (1, 2, 3)))
    return F.struct(
        F.when(attributes.rlike(_HREF), href).alias("href"),
        F.regexp_replace(inner, "<[^>]*>", _GAP).alias("inner"),
        cut.rlike(r"(?i)</a\s*>").alias("closed"),
    )


def listing_links(
    pages: DataFrame,
    href_contains: str,
    min_chars: int = 20,
    stop_texts: Sequence[str] = (),
    page_key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Article links of a listing page: one row per page and resolved link.

    Of several anchors to the same link the first text wins.  A page is a
    bounded group, and the minimum is combined before the shuffle.
    """
    links = page_links(pages.select(page_key, url, html), html).drop(html)
    wanted = F.col("href").contains(href_contains) & (F.length("link_text") >= min_chars)
    if stop_texts:
        wanted = wanted & ~F.lower("link_text").isin(*stop_texts)
    resolved = links.where(wanted).withColumn("link", resolve_url(url, "href"))
    return resolved.groupBy(page_key, url, "link").agg(
        F.min_by("link_text", "link_pos").alias("title"), F.min("link_pos").alias("link_pos")
    )


def read_listings(
    payloads: DataFrame, href_contains: str, min_chars: int = 20, stop_texts: Sequence[str] = ()
) -> DataFrame:
    """Listing payloads as raw records, in the layout of the feed readers."""
    links = listing_links(
        payloads, href_contains, min_chars, stop_texts, page_key="source_id", url="url", html="payload"
    )
    meta = payloads.select(*SOURCE_COLUMNS, "url").distinct()
    blank = F.lit("")
    return links.join(meta, ["source_id", "url"]).select(
        *SOURCE_COLUMNS,
        F.col("url").alias("source_url"),
        F.col("link_pos").alias("item_pos"),
        text_or_empty("title").alias("title"),
        "link",
        blank.alias("published"),
        blank.alias("abstract"),
        blank.alias("article_type"),
        blank.alias("doi"),
        F.array().cast("array<string>").alias("tags"),
        F.array().cast("array<string>").alias("authors"),
    ).select(*FEED_COLUMNS)
