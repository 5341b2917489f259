"""Duplicate resolution over several keys.

Records that share a canonical URL, a DOI or a journal-and-title key belong
together, also through a chain of others.  The clusters are the connected
components of the record-key graph, so the result does not depend on the order
of the records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.operators.components import connected_components
from litsieve.operators.normalize import completeness
from litsieve.session import release, stored


def title_key() -> Column:
    return F.concat(F.lit("title:"), F.lower("journal"), F.lit("::"), F.col("title_norm"))


def url_key() -> Column:
    return F.when(F.col("canonical_url") != "", F.concat(F.lit("url:"), "canonical_url"))


def doi_key() -> Column:
    return F.when(F.col("doi") != "", F.concat(F.lit("doi:"), "doi"))


def dedupe_key() -> Column:
    """Name of a record: DOI, else URL, else journal and title."""
    return F.coalesce(doi_key(), url_key(), title_key())


def dedupe_candidates(skip_empty_title: bool = False) -> Column:
    """All keys a record can be found by, in lookup order.

    The title key exists even when the title is empty, which joins all untitled
    records of a journal; ``skip_empty_title`` leaves it out for those.
    """
    title = F.when(F.col("title_norm") != "", title_key()) if skip_empty_title else title_key()
    return F.array_compact(F.array(url_key(), doi_key(), title))


def key_table(records: DataFrame, skip_empty_title: bool = False) -> DataFrame:
    """The narrow facts resolution needs; the wide record stays behind."""
    return records.select(
        "seq",
        "published_at",
        completeness(records).alias("score"),
        dedupe_key().alias("dedupe_key"),
        dedupe_candidates(skip_empty_title).alias("candidates"),
    )


def _links(keys: DataFrame) -> DataFrame:
    """Edges from each record to the first record of every key it shares."""
    pairs = keys.select("seq", F.explode("candidates").alias("key"))
    # Minima combine before the shuffle; a hot key is split by the adaptive join.
    first = pairs.groupBy("key").agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = pairs.join(first, "key")
    return joined.where("seq > first_seq").select(F.col("seq").alias("a"), F.col("first_seq").alias("b"))


def _clustered(keys: DataFrame) -> DataFrame:
    """``seq`` and ``cluster`` of the records that share a key with another one."""
    found = connected_components(_links(keys))
    return found.select(F.col("node").alias("seq"), F.col("component").alias("cluster"))


def clusters(keys: DataFrame) -> DataFrame:
    """``seq`` and ``cluster`` for every record; a record without partner is its own cluster."""
    linked = _clustered(keys)
    return keys.select("seq").join(linked, "seq", "left").select(
        "seq", F.coalesce("cluster", "seq").alias("cluster")
    )


@dataclass(frozen=True)
class Resolution:
    """``survivors`` and ``duplicates`` split the records; duplicates carry ``duplicate_of``."""

    survivors: DataFrame
    duplicates: DataFrame


def losers(keys: DataFrame) -> DataFrame:
    """Records that give way, with the name of the first record of their cluster.

    The best record has most filled columns, then the earliest publish text
    (undated sorts first), then the lowest position.
    """
    members = stored(_clustered(keys).join(keys.drop("candidates"), "seq"))
    best = members.groupBy("cluster").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "published_at", "seq"))["seq"].alias("best_seq"),
        F.min_by("dedupe_key", "seq").alias("duplicate_of"),
    )
    return (
        members.select("seq", "cluster")
        .join(best, "cluster")
        .where(F.col("seq") != F.col("best_seq"))
        .select("seq", "duplicate_of")
    )


def resolve_duplicates(records: DataFrame, skip_empty_title: bool = False) -> Resolution:
    """Split records into survivors and duplicates.

    Only the narrow key table takes part in the iteration.  The wide records are
    read twice: once for their keys, once for the final joins on ``seq``.  The
    duplicates are stored, so Spark knows their bytes and broadcasts them only
    below its own threshold; the anti join reads their ``seq`` alone.
    """
    keys = stored(key_table(records, skip_empty_title))
    gone = stored(losers(keys))
    release(keys)
    return Resolution(
        survivors=records.join(gone.select("seq"), "seq", "left_anti"),
        duplicates=records.join(gone, "seq"),
    )
