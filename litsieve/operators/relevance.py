"""Rule filter: searchable text, keyword hits and the first-match cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.config import DigestRules, RelevanceRules
from litsieve.functions.keywords import found_terms, hits_among, present_runs, starts_with_any
from litsieve.functions.text import clean_text, strip_ends, text_or_empty
from litsieve.session import evaluate_once
from litsieve.sources.registry import enrich


def with_search_text(records: DataFrame) -> DataFrame:
    """Add ``search_text``: journal, title, abstract and tags as one lower-case text.

    The journal name is part of the text, so it counts as evidence.  The parts are
    joined once; else each reading of the joined text would clean the parts anew.
    """
    joined = F.concat_ws(" ", "journal", "title_en", "abstract", F.array_join("tags", " "))
    with_joined = evaluate_once(records, joined_parts=joined)
    return with_joined.withColumn("search_text", F.lower(clean_text("joined_parts"))).drop("joined_parts")


def match_keywords(records: DataFrame, keywords: tuple[str, ...], text: Column | None = None) -> DataFrame:
    """Add ``found``: every keyword that occurs, for all rule lists at once."""
    with_text = with_search_text(records) if text is None else records.withColumn("search_text", text)
    with_runs = evaluate_once(with_text, present=present_runs("search_text", keywords))
    return evaluate_once(with_runs, found=found_terms("search_text", "present", keywords)).drop(
        "search_text", "present"
    )


def all_keywords(rules: DigestRules) -> tuple[str, ...]:
    r = rules.relevance
    lists = [r.keep_keywords, r.ai_keep_keywords, r.reject_keywords, r.hard_reject_keywords]
    return tuple(dict.fromkeys(k for group in [*lists, *rules.categories.values()] for k in group))


def _reason(label: str, hits: str) -> Column:
    return F.concat(F.lit(f"{label}: "), F.array_join(F.slice(hits, 1, 3), ", "))


def conditional_source(rules: RelevanceRules, registry_group: str = "registry_group") -> Column:
    """Sources that need direct evidence: by journal name or by registry group."""
    by_group = F.coalesce(F.col(registry_group) == rules.conditional_group, F.lit(False))
    return F.col("journal").isin(*rules.conditional_journals) | by_group if rules.conditional_journals else by_group


def apply_relevance(found: DataFrame, rules: RelevanceRules, registry_group: str = "registry_group") -> DataFrame:
    """Add hits, status and reason to records that carry ``found``.

    The first matching branch decides.  Status and reason are two readings of
    one branch number, so they cannot disagree.
    """
    hits = found.withColumns(
        {
            "relevance_keep_hits": hits_among("found", rules.keep_keywords),
            "relevance_ai_keep_hits": hits_among("found", rules.ai_keep_keywords),
            "relevance_reject_hits": hits_among("found", rules.reject_keywords),
            "relevance_hard_reject_hits": hits_among("found", rules.hard_reject_keywords),
        }
    )
    n_keep = F.size("relevance_keep_hits")
    n_ai = F.size("relevance_ai_keep_hits")
    n_reject = F.size("relevance_reject_hits")
    n_hard = F.size("relevance_hard_reject_hits")
    title = strip_ends(text_or_empty("title_en"))
    doi = F.lower(strip_ends(text_or_empty("doi")))
    strict = F.col("source_id").isin(*rules.strict_source_ids) if rules.strict_source_ids else F.lit(False)
    branch = (
        F.when(starts_with_any(title, rules.title_prefixes), 1)
        .when(starts_with_any(doi, [p.lower() for p in rules.doi_prefixes]), 2)
        .when(n_hard > 0, 3)
        .when(n_ai > 0, 4)
        .when(conditional_source(rules, registry_group) & (n_keep == 0), 5)
        .when(F.coalesce(strict, F.lit(False)) & (n_keep == 0), 6)
        .when((n_reject > 0) & (n_keep == 0), 7)
        .when(n_reject > n_keep + 1, 8)
        .when(n_keep > 0, 9)
        .otherwise(10)
    )
    b = F.col("branch")
    judged = evaluate_once(hits, branch=branch)
    return judged.withColumns(
        {
            "relevance_status": F.when(b.isin(4, 9, 10), "keep").otherwise("reject"),
            "relevance_reason": F.when(b == 1, "matched editorial title prefix")
            .when(b == 2, "matched editorial DOI prefix")
            .when(b == 3, _reason("matched hard reject keywords", "relevance_hard_reject_hits"))
            .when(b == 4, _reason("matched AI keep keywords", "relevance_ai_keep_hits"))
            .when(b == 5, "conditional journal without biology-specific signal")
            .when(b == 6, "strict bio source without biology-specific keyword match")
            .when(b == 7, _reason("matched reject keywords", "relevance_reject_hits"))
            .when(b == 8, _reason("reject signals outweigh keep signals", "relevance_reject_hits"))
            .when(b == 9, _reason("matched keep keywords", "relevance_keep_hits"))
            .otherwise("kept by default source scope"),
        }
    ).drop("branch")


def with_registry_group(records: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Add ``registry_group``; records of unknown sources get null."""
    if sources is None:
        return records.withColumn("registry_group", F.lit(None).cast("string"))
    return enrich(records, sources.withColumnRenamed("group", "registry_group"), ["registry_group"])


def filter_relevance(records: DataFrame, rules: DigestRules, sources: DataFrame | None = None) -> DataFrame:
    """Annotate every record; rejected ones stay, marked by ``relevance_status``.

    ``found`` stays on the rows so that classification needs no second pass.
    """
    matched = match_keywords(with_registry_group(records, sources), all_keywords(rules))
    return apply_relevance(matched, rules.relevance).drop("registry_group")
