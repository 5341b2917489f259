"""Rule sets, source registry and glossary as plain configuration objects.

They are read once on the driver from YAML or JSON and turned into literals or
small dimension tables.  Spark knows the bytes of such a table and broadcasts it
below its own threshold; a larger registry is joined by shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from litsieve import defaults as d

SOURCE_SCHEMA = (
    "source_id string, enabled boolean, publisher_family string, journal string, "
    "`group` string, publication_stage string, source_strategy string, source_locator array<string>, "
    "position int"
)


def read_config(path: str | Path) -> dict[str, Any]:
    """Load a YAML or JSON mapping."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text) or {}
    import yaml

    return yaml.safe_load(text) or {}


def _texts(values: Any) -> tuple[str, ...]:
    return tuple(str(v) for v in values or ())


@dataclass(frozen=True)
class RelevanceRules:
    keep_keywords: tuple[str, ...] = d.KEEP_KEYWORDS
    ai_keep_keywords: tuple[str, ...] = d.AI_KEEP_KEYWORDS
    reject_keywords: tuple[str, ...] = d.REJECT_KEYWORDS
    hard_reject_keywords: tuple[str, ...] = d.HARD_REJECT_KEYWORDS
    title_prefixes: tuple[str, ...] = d.EDITORIAL_TITLE_PREFIXES
    doi_prefixes: tuple[str, ...] = d.EDITORIAL_DOI_PREFIXES
    strict_source_ids: tuple[str, ...] = d.STRICT_SOURCE_IDS
    conditional_journals: tuple[str, ...] = d.CONDITIONAL_JOURNALS
    conditional_group: str = "ai-conditional"


@dataclass(frozen=True)
class ReviewRules:
    editorial_prefixes: tuple[str, ...] = d.REVIEW_EDITORIAL_PREFIXES
    editorial_tags: tuple[str, ...] = d.REVIEW_EDITORIAL_TAGS
    hard_reject_hints: tuple[str, ...] = d.REVIEW_HARD_REJECT_HINTS
    strong_hints: tuple[str, ...] = d.REVIEW_STRONG_HINTS
    keep_threshold: float = 0.85
    review_threshold: float = 0.60


@dataclass(frozen=True)
class DisplayRules:
    grouping_mode: str = "journal"
    top_source_ids: tuple[str, ...] = d.TOP_SOURCE_IDS
    source_order: tuple[str, ...] = d.SOURCE_ORDER
    plant_groups: tuple[str, ...] = ("plant-core",)
    plant_tokens: tuple[str, ...] = d.PLANT_TOKENS
    deferred_categories: tuple[str, ...] = ("gene-function-regulation",)
    non_deferred_categories: tuple[str, ...] = ("ai-computational-biology",)
    hidden_source_ids: tuple[str, ...] = d.HIDDEN_SOURCE_IDS
    hidden_keywords: tuple[str, ...] = d.HIDDEN_KEYWORDS
    never_hidden_category: str = "ai-computational-biology"


@dataclass(frozen=True)
class DigestRules:
    relevance: RelevanceRules = field(default_factory=RelevanceRules)
    review: ReviewRules = field(default_factory=ReviewRules)
    display: DisplayRules = field(default_factory=DisplayRules)
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(d.CATEGORIES))
    fallback_category: str = "other"
    digest_columns: tuple[str, ...] = d.DIGEST_COLUMNS
    review_columns: tuple[str, ...] = d.REVIEW_COLUMNS
    max_sentences: int = 4

    @classmethod
    def from_mapping(cls, data: Mapping[str, Any]) -> "DigestRules":
        """Build from a rule file; a missing section means empty lists."""
        relevance = data.get("relevance_filter") or {}
        policy = data.get("classification_policy") or {}
        display = data.get("display_priority") or {}
        visual = data.get("visual_filters") or {}
        output = data.get("output_schema") or {}
        queue = data.get("review_queue_schema") or {}
        return cls(
            relevance=RelevanceRules(
                keep_keywords=_texts(relevance.get("keep_keywords")),
                ai_keep_keywords=_texts(relevance.get("ai_keep_keywords")),
                reject_keywords=_texts(relevance.get("reject_keywords")),
                hard_reject_keywords=_texts(relevance.get("hard_reject_keywords")),
                title_prefixes=_texts(relevance.get("editorial_reject_title_prefixes")),
                doi_prefixes=_texts(relevance.get("editorial_reject_doi_prefixes")),
                strict_source_ids=_texts(relevance.get("strict_bio_source_ids")),
                conditional_journals=_texts(relevance.get("conditional_journals")),
            ),
            display=DisplayRules(
                grouping_mode=str(display.get("default_grouping_mode") or "journal"),
                top_source_ids=_texts(display.get("top_journal_source_ids")),
                source_order=_texts(display.get("journal_order_source_ids")),
                plant_groups=_texts(display.get("plant_priority_groups")),
                deferred_categories=_texts(display.get("deferred_category_ids")),
                non_deferred_categories=_texts(display.get("non_deferred_category_ids")),
                hidden_source_ids=_texts(visual.get("attachment_only_source_ids")),
                hidden_keywords=_texts(visual.get("attachment_only_keywords")),
            ),
            categories={
                str(c["id"]): _texts(c.get("keywords"))
                for c in data.get("categories") or ()
                if c.get("id") not in (None, "other")
            },
            fallback_category=str(policy.get("fallback_category") or "other"),
            digest_columns=_texts(output.get("required_columns")) or d.DIGEST_COLUMNS,
            review_columns=_texts(queue.get("required_columns")) or d.REVIEW_COLUMNS,
            max_sentences=int((output.get("summary_requirements") or {}).get("max_sentences", 4)),
        )

    @classmethod
    def load(cls, path: str | Path) -> "DigestRules":
        return cls.from_mapping(read_config(path))


@dataclass(frozen=True)
class Glossary:
    replacements: tuple[tuple[str, str], ...] = d.GLOSSARY_REPLACEMENTS
    seed_terms: tuple[str, ...] = d.GLOSSARY_SEED_TERMS

    @classmethod
    def from_mapping(cls, data: Mapping[str, Any]) -> "Glossary":
        return cls(
            replacements=tuple(
                (str(p.get("source", "")), str(p.get("target", ""))) for p in data.get("replacements") or ()
            ),
            seed_terms=_texts(data.get("candidate_seed_terms")),
        )

    @classmethod
    def load(cls, path: str | Path) -> "Glossary":
        return cls.from_mapping(read_config(path))

    def known_terms(self) -> list[str]:
        """Every source, target and seed term in its normal form, each once."""
        terms = [t for pair in self.replacements for t in pair] + list(self.seed_terms)
        return [t for t in dict.fromkeys(" ".join(t.lower().split()) for t in terms) if t]


def sources_from_watchlist(spark: SparkSession, watchlist: Mapping[str, Any]) -> DataFrame:
    """Source registry table from a watchlist mapping; ``position`` is file order."""
    rows = []
    for position, item in enumerate(watchlist.get("journals") or ()):
        if "id" not in item:
            continue
        locator = item.get("source_locator")
        locators = locator if isinstance(locator, list) else [locator] if locator else []
        rows.append(
            (
                str(item["id"]),
                bool(item.get("enabled")),
                item.get("publisher_family", ""),
                item.get("journal_name", ""),
                item.get("group", ""),
                item.get("publication_stage", "journal"),
                item.get("source_strategy", "official_feed_or_toc"),
                [str(x) for x in locators],
                position,
            )
        )
    return spark.createDataFrame(rows, SOURCE_SCHEMA)


def load_sources(spark: SparkSession, path: str | Path) -> DataFrame:
    return sources_from_watchlist(spark, read_config(path))
