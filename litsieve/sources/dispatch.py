"""Acquire step: payload table to windowed, limited raw records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.functions.dates import iso_utc, parse_datetime
from litsieve.functions.text import text_or_empty
from litsieve.operators.windows import ingest_filter
from litsieve.schemas import FEED_COLUMNS
from litsieve.session import small_batches, stored
from litsieve.sources.feeds import feed_items, parse_feed, skip_front_matter
from litsieve.sources.listings import read_listings
from litsieve.sources.registry import source_locators


@dataclass(frozen=True)
class ListingRule:
    """Which pages a listing form covers, and which of their links count."""

    url_parts: tuple[str, ...]
    href_contains: str
    min_chars: int = 20
    stop_texts: tuple[str, ...] = ()

    def covers(self) -> Column:
        return reduce(lambda a, b: a & b, (F.col("url").contains(p) for p in self.url_parts))


# Listing forms by page address.
LISTING_RULES = (
    ListingRule(("academic.oup.com", "advance-articles"), "/advance-article/"),
    ListingRule(("pnas.org/toc/",), "/doi/", 20, ("abstract", "full text", "pdf")),
)
LISTING_STRATEGY = "official_toc"


def read_payloads(
    payloads: DataFrame, rules: Sequence[ListingRule] = LISTING_RULES
) -> tuple[DataFrame, DataFrame]:
    """Records, and the payloads nothing could read: broken ones and pages no rule covers.

    Listing sources go to the listing reader.  All others are read as XML, and
    those that are not well-formed fall back to the listing reader of their
    address.  Payloads are parsed once: records and rest are read from one stored table.
    It has a row per record, not per feed: readers hold thousands of rows at a time.
    """
    is_listing = F.coalesce(F.col("source_strategy") == LISTING_STRATEGY, F.lit(False))
    xml = F.when(~is_listing, F.col("payload"))
    # What parsed needs its payload no more; the others have nothing but that.
    items = stored(feed_items(small_batches(payloads).withColumn("feed", parse_feed(xml))), "zstd")
    pages = items.where("root IS NULL").select(*payloads.columns)
    records = items.where("item_pos IS NOT NULL").select(*FEED_COLUMNS)
    taken = F.lit(False)
    for rule in rules:
        chosen = pages.where(rule.covers() & ~taken)
        records = records.unionByName(
            read_listings(chosen, rule.href_contains, rule.min_chars, rule.stop_texts)
        )
        taken = taken | rule.covers()
    return records, pages.where(~taken)


def limit_per_source(
    records: DataFrame, limit: int = 50, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """First ``limit`` records of each source in feed order.

    The rank filter is pushed into a group limit before the shuffle, so a source
    that holds much of the data sends only ``limit`` rows per task.
    """
    window = Window.partitionBy("source_id").orderBy(*order)
    return (
        records.withColumn("source_rank", F.row_number().over(window))
        .where(F.col("source_rank") <= limit)
        .drop("source_rank")
    )


def stamp(records: DataFrame, fetched_at: Column) -> DataFrame:
    """Add the ingest time and the parsed publish time as ISO text."""
    return records.withColumns(
        {
            "fetched_at": text_or_empty(fetched_at),
            "published_at": iso_utc(parse_datetime("published")),
        }
    )


# Digits of a position in a feed, and of an address of a source, in ``seq``.
ITEM_DIGITS, LOCATOR_DIGITS = 8, 4


def with_locators(payloads: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Payloads of the selected sources with ``source_pos`` and ``locator_pos``, addresses without payload, and all addresses.

    ``payloads`` has url and payload.  Sources carry ``position`` and a list of
    addresses; an address that several sources list is read for each of them.
    The addresses are stored, so Spark knows their bytes and sends them to the payloads
    below its own threshold, instead of shuffling payloads.
    """
    wanted = stored(source_locators(sources).withColumnRenamed("position", "source_pos").drop("source_locator", "enabled"))
    found = wanted.join(payloads.select("url", "payload"), "url")
    missing = wanted.join(payloads.select("url").distinct(), "url", "left_anti")
    return found, missing.select("source_id", "locator_pos", "url"), wanted


@dataclass(frozen=True)
class Acquired:
    """``records`` with ``seq``; ``quarantine``: payloads nothing could read; ``missing``: addresses without payload."""

    records: DataFrame
    quarantine: DataFrame
    missing: DataFrame | None = None


def acquire(
    payloads: DataFrame,
    start: Column | None,
    end: Column | None,
    fetched_at: Column,
    limit: int = 50,
    rules: Sequence[ListingRule] = LISTING_RULES,
    sources: DataFrame | None = None,
) -> Acquired:
    """Parse, drop front matter, apply the ingest window, stamp and limit.

    With ``sources`` the payloads are joined to the selected sources and their
    addresses.  Records are in the order of sources, listed addresses and items,
    which also decides the first ``limit`` of a source; ``seq`` numbers that order.
    """
    missing = addresses = None
    if sources is not None:
        payloads, missing, addresses = with_locators(payloads, sources)
    for name in ("source_pos", "locator_pos"):
        if name not in payloads.columns:
            payloads = payloads.withColumn(name, F.lit(0))
    records, quarantine = read_payloads(payloads, rules)
    # One narrow row per address; the feed readers keep the address of every item.
    places = (payloads if addresses is None else addresses).groupBy("source_id", F.col("url").alias("source_url")).agg(
        F.min("source_pos").alias("source_pos"), F.min("locator_pos").alias("locator_pos")
    )
    kept = ingest_filter(skip_front_matter(records), parse_datetime("published"), start, end)
    seq = (F.col("source_pos").cast("long") * 10**LOCATOR_DIGITS + F.col("locator_pos")) * 10**ITEM_DIGITS + F.col("item_pos")
    numbered = stamp(kept, fetched_at).join(places, ["source_id", "source_url"]).withColumn("seq", seq)
    ordered = limit_per_source(numbered, limit, ("locator_pos", "item_pos"))
    return Acquired(ordered.drop("source_pos", "locator_pos"), quarantine, missing)
