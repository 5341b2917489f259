"""Record layouts of each stage.

``seq`` is the stable row position that breaks ties; every source supplies it.
"""

from __future__ import annotations

RAW = (
    "seq bigint, source_id string, journal string, publisher_family string, `group` string, "
    "publication_stage string, source_url string, title string, title_en string, link string, "
    "article_url string, url string, published_at string, published string, date string, "
    "abstract string, summary string, description string, article_type string, doi string, "
    "tags string, authors string, fetched_at string"
)

NORMALIZED_COLUMNS = (
    "source_id",
    "journal",
    "publisher_family",
    "group",
    "publication_stage",
    "article_type",
    "title_en",
    "title_norm",
    "doi",
    "article_url",
    "canonical_url",
    "published_at",
    "abstract",
    "tags",
    "authors",
    "source_url",
    "fetched_at",
)

LIST_COLUMNS = ("tags", "authors")

FEED_COLUMNS = (
    "source_id",
    "journal",
    "publisher_family",
    "group",
    "publication_stage",
    "source_url",
    "item_pos",
    "title",
    "link",
    "published",
    "abstract",
    "article_type",
    "doi",
    "tags",
    "authors",
)

REVIEW_RESULT = "decision string, confidence double, reason string, category_override string"
LOCALIZED_RESULT = "title_zh string, summary_zh string"
