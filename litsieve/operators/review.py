"""Second reading of classified records: built-in reviewer, providers, decisions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.config import DigestRules, ReviewRules
from litsieve.functions.identifiers import canonical_doi, canonical_url
from litsieve.functions.keywords import contains_any, starts_with_any
from litsieve.functions.numbers import round_decimals
from litsieve.functions.payloads import json_path
from litsieve.functions.text import first_filled, normalize_title, strip_ends, text_or_empty
from litsieve.operators.journal import ReplyJournal, call_journalled
from litsieve.operators.providers import CallPolicy, call_records
from litsieve.schemas import REVIEW_RESULT
from litsieve.session import evaluate_once

DECISIONS = ("keep", "review", "reject")

# Confidence and reason of each branch of the built-in reviewer.
OUTCOMES = {
    1: ("reject", 0.95, "editorial or correction item is outside the digest scope"),
    2: ("reject", 0.9, "profile, viewpoint, or Q&A item is outside the digest scope"),
    3: ("reject", 0.88, "topic appears outside the intended biology scope"),
    4: ("keep", 0.83, "biology relevance is clear even though rule-based category remained other"),
    5: ("review", 0.62, "relevance or category remains ambiguous after rule-based classification"),
    6: ("keep", 0.82, "preprint is biology-relevant but should remain marked as preprint"),
    7: ("keep", 0.92, "rule-based filtering and category assignment are consistent with biology scope"),
}


def heuristic_review(records: DataFrame, rules: ReviewRules) -> DataFrame:
    """Add ``payload`` (decision, confidence, reason, category_override).

    Hints are plain substrings, so ``peat`` also fires inside ``repeat``.
    """
    text = F.lower(
        F.concat_ws(
            " ",
            first_filled("title_en"),
            first_filled("abstract"),
            first_filled(F.array_join("tags", " ")),
        )
    )
    tags = F.transform("tags", lambda tag: F.lower(strip_ends(tag)))
    title = strip_ends(text_or_empty("title_en"))
    is_other = F.coalesce(F.col("category"), F.lit("other")) == "other"
    editorial_tags = F.array(*(F.lit(t) for t in rules.editorial_tags)).cast("array<string>")
    branch = (
        F.when(starts_with_any(title, rules.editorial_prefixes), 1)
        .when(F.arrays_overlap(tags, editorial_tags), 2)
        .when(contains_any(text, rules.hard_reject_hints), 3)
        .when(is_other & contains_any(text, rules.strong_hints), 4)
        .when(is_other, 5)
        .when(F.col("publication_stage") == "preprint", 6)
        .otherwise(7)
    )
    outcomes = F.array(
        *(
            F.struct(
                F.lit(decision).alias("decision"),
                F.lit(confidence).alias("confidence"),
                F.lit(reason).alias("reason"),
                F.lit(None).cast("string").alias("category_override"),
            )
            for decision, confidence, reason in OUTCOMES.values()
        )
    )
    judged = evaluate_once(records, review_branch=branch)
    return judged.withColumn("payload", F.element_at(outcomes, F.col("review_branch"))).drop("review_branch")


def payload_from_json(response: Column | str, path: str = "") -> Column:
    """Review payload out of a stored JSON response, null-safe.

    A ``path`` that does not lead to an object falls back to the whole response.
    """
    whole = F.col(response) if isinstance(response, str) else response
    inner = json_path(whole, path) if path else whole
    base = F.when(F.coalesce(inner, F.lit("")).startswith("{"), inner).otherwise(whole)
    return F.struct(
        json_path(base, "decision").alias("decision"),
        json_path(base, "confidence").try_cast("double").alias("confidence"),
        json_path(base, "reason").alias("reason"),
        json_path(base, "category_override").alias("category_override"),
    )


def review_with(
    records: DataFrame,
    call: Callable[[dict], dict],
    columns: list[str],
    policy: CallPolicy = CallPolicy(),
    journal: ReplyJournal | None = None,
) -> DataFrame:
    """Add ``payload`` from a user callable ``record -> {decision, confidence, …}``.

    With a ``journal`` every different request is asked for once, also over lost tasks
    and later runs; the callable then sees ``columns`` only.
    """
    if journal:
        return call_journalled(records, "payload", columns, REVIEW_RESULT, call, journal, policy)
    return call_records(records, "payload", columns, REVIEW_RESULT, call, policy)


def finalize_review(records: DataFrame, rules: ReviewRules) -> DataFrame:
    """Turn ``payload`` into the review columns.

    Missing fields get defaults, a decision outside keep/review/reject is
    replaced by what the confidence says, and an override keeps the original
    category.
    """
    decision = F.lower(F.coalesce("payload.decision", F.lit("review")))
    confidence = F.coalesce("payload.confidence", F.lit(0.5))
    override = first_filled("payload.category_override")
    settled = (
        F.when(decision.isin(*DECISIONS), decision)
        .when(confidence >= rules.keep_threshold, "keep")
        .when(confidence >= rules.review_threshold, "review")
        .otherwise("reject")
    )
    status = F.col("relevance_status") if "relevance_status" in records.columns else F.lit(None)
    return records.withColumns(
        {
            "rule_decision": F.coalesce(status.cast("string"), F.lit("keep")),
            "llm_decision": settled,
            "llm_confidence": round_decimals(confidence, 3),
            "llm_reason": F.coalesce("payload.reason", F.lit("no review reason provided")),
            "category_original": F.when(override.isNotNull(), F.col("category")),
            "llm_category_override": override,
            "category": F.coalesce(override, F.col("category")),
            "final_decision": settled,
        }
    ).drop("payload")


def review(
    records: DataFrame,
    rules: DigestRules,
    call: Callable[[dict], dict] | None = None,
    columns: list[str] | None = None,
    policy: CallPolicy = CallPolicy(),
    journal: ReplyJournal | None = None,
) -> DataFrame:
    """Review with the built-in rules or, when given, a user callable."""
    if call is None:
        return finalize_review(heuristic_review(records, rules.review), rules.review)
    wanted = columns or ["title_en", "abstract", "journal", "publication_stage", "category", "tags"]
    return finalize_review(review_with(records, call, wanted, policy, journal), rules.review)


def decision_key(*urls: str) -> Column:
    """Key that matches a record with a human decision: DOI, else URL, else journal and title."""
    doi = canonical_doi("doi")
    url = canonical_url(text_or_empty(first_filled(*urls)))
    return (
        F.when(doi != "", F.concat(F.lit("doi:"), doi))
        .when(url != "", F.concat(F.lit("url:"), url))
        .otherwise(
            F.concat(F.lit("title:"), F.lower(text_or_empty("journal")), F.lit("::"), normalize_title("title_en"))
        )
    )


def apply_decisions(reviewed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Left join of human decisions; the last decision row of a key wins.

    Decisions are reduced to one row per key with a partial aggregate.  The join
    carries no hint: Spark broadcasts the decisions when their measured size
    allows it and shuffles otherwise.
    """
    latest = (
        decisions.withColumn("decision_key", decision_key("article_url"))
        .groupBy("decision_key")
        .agg(
            F.max(
                F.struct("seq", "review_final_decision", "review_final_category", "reviewer_notes")
            ).alias("d")
        )
    )
    keyed = reviewed.withColumn("decision_key", decision_key("article_url", "canonical_url"))
    joined = keyed.join(latest, "decision_key", "left").drop("decision_key")
    found = F.col("d").isNotNull()
    wanted = F.when(F.col("d.review_final_decision").isin(*DECISIONS), F.col("d.review_final_decision"))
    final = F.coalesce(wanted, F.col("final_decision"), F.lit("review"))
    category = first_filled("d.review_final_category")
    earlier = F.col("category_original") if "category_original" in reviewed.columns else F.lit(None).cast("string")
    return joined.withColumns(
        {
            "manual_review_applied": found,
            "manual_review_decision": F.when(found, final),
            "reviewer_notes": F.when(found, F.col("d.reviewer_notes")),
            "category_original": F.when(category.isNotNull(), F.col("category")).otherwise(earlier),
            "category": F.coalesce(category, F.col("category")),
            "final_decision": F.when(found, final).otherwise(F.col("final_decision")),
        }
    ).drop("d")
