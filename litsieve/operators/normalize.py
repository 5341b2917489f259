"""Raw records to the normalized layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from litsieve.functions.dates import iso_utc, parse_datetime
from litsieve.functions.identifiers import canonical_doi, canonical_url
from litsieve.functions.text import (
    as_column,
    clean_list,
    clean_text,
    first_filled,
    normalize_title,
    text_or_empty,
)
from litsieve.operators.skew import rank_rows
from litsieve.schemas import NORMALIZED_COLUMNS
from litsieve.session import small_batches, stored


def _optional(df: DataFrame, *names: str) -> Column:
    """First filled of the columns that exist; ``''`` when none does."""
    known = [n for n in names if n in df.columns]
    return text_or_empty(first_filled(*known)) if known else F.lit("")


def _optional_list(df: DataFrame, name: str) -> Column:
    empty = F.array().cast("array<string>")
    if name not in df.columns:
        return empty
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(_optional(df, name) == "", empty).otherwise(F.array(name))
    return F.coalesce(F.col(name), empty)


def publish_time(raw: DataFrame) -> Column:
    """Parsed publish time; use it to filter before the rest is cleaned."""
    return parse_datetime(_optional(raw, "published_at", "published", "date"))


def normalize_records(raw: DataFrame) -> DataFrame:
    """``seq`` plus the 17 normalized columns; one narrow projection."""
    link = _optional(raw, "link", "article_url", "url")
    cleaned = small_batches(raw).select(
        "seq",
        _optional(raw, "source_id").alias("source_id"),
        clean_text(_optional(raw, "journal")).alias("journal"),
        _optional(raw, "publisher_family").alias("publisher_family"),
        _optional(raw, "group").alias("group"),
        text_or_empty(first_filled(clean_text(_optional(raw, "publication_stage")), F.lit("journal"))).alias(
            "publication_stage"
        ),
        clean_text(_optional(raw, "article_type")).alias("article_type"),
        clean_text(_optional(raw, "title", "title_en")).alias("title_en"),
        canonical_doi(_optional(raw, "doi")).alias("doi"),
        link.alias("article_url"),
        canonical_url(link).alias("canonical_url"),
        iso_utc(publish_time(raw)).alias("published_at"),
        clean_text(_optional(raw, "abstract", "summary", "description")).alias("abstract"),
        clean_list(_optional_list(raw, "tags")).alias("tags"),
        _optional_list(raw, "authors").alias("authors"),
        _optional(raw, "source_url").alias("source_url"),
        _optional(raw, "fetched_at").alias("fetched_at"),
    )
    return cleaned.withColumn("title_norm", normalize_title("title_en")).select("seq", *NORMALIZED_COLUMNS)


def normalized_order(records: DataFrame) -> DataFrame:
    """``seq`` and ``rank``: newest first, then journal and title from the end; equal rows keep their order.

    Text sorts in rising order only, so ranks are counted from the bottom, with ``-seq``
    for ties, and turned round.
    """
    keys = stored(
        records.select(
            "seq", "journal", "title_en",
            (-F.coalesce(F.unix_seconds(parse_datetime("published_at")), F.lit(-(2**40)))).alias("newest"),
        )
    )
    total = keys.count()
    rising = rank_rows(keys, [-F.col("newest"), F.col("journal"), F.col("title_en"), -F.col("seq")], name="rising", keep=False)
    return rising.select("seq", (F.lit(total) + 1 - F.col("rising")).alias("rank"))


def completeness(df: DataFrame, columns: tuple[str, ...] = NORMALIZED_COLUMNS) -> Column:
    """Number of filled columns: non-blank text, non-empty lists, other non-null values."""
    score = F.lit(0)
    for name in columns:
        kind = df.schema[name].dataType
        value = as_column(name)
        if isinstance(kind, T.StringType):
            filled = value.rlike(r"(?U)\S")
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            filled = F.size(value) > 0
        else:
            filled = value.isNotNull()
        score = score + F.when(filled, 1).otherwise(0)
    return score
