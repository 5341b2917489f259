"""One category per record by keyword count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.config import DigestRules
from litsieve.functions.keywords import hits_among
from litsieve.operators.relevance import match_keywords
from litsieve.session import evaluate_once


def category_hits(rules: DigestRules, found: str = "found") -> Column:
    """Array of (score, category, hits), one per category."""
    scored = []
    for category, keywords in rules.categories.items():
        hits = hits_among(found, keywords)
        scored.append(
            F.struct(F.size(hits).alias("score"), F.lit(category).alias("category"), hits.alias("hits"))
        )
    return F.array(*scored)


def classify(records: DataFrame, rules: DigestRules) -> DataFrame:
    """Add category, reason and hits to records that carry ``found``.

    Most hits win and a tie goes to the larger category id, which is the order
    of the (score, category) struct.  No hit gives the fallback category.
    """
    best = evaluate_once(records, best=F.array_max(category_hits(rules)))
    matched = F.col("best.score") > 0
    return best.withColumns(
        {
            "category": F.when(matched, F.col("best.category")).otherwise(rules.fallback_category),
            "category_reason": F.when(
                matched,
                F.concat(F.lit("matched category keywords: "), F.array_join(F.slice("best.hits", 1, 4), ", ")),
            ).otherwise("no category keyword matched"),
            "category_hits": F.when(matched, F.col("best.hits")).otherwise(F.array().cast("array<string>")),
        }
    ).drop("best")


def category_scores(records: DataFrame, rules: DigestRules) -> DataFrame:
    """Long form: one row per record and category with at least one hit."""
    keywords = tuple(dict.fromkeys(k for group in rules.categories.values() for k in group))
    matched = match_keywords(records, keywords)
    scored = matched.select("seq", F.explode(category_hits(rules)).alias("s"))
    return scored.select("seq", "s.category", "s.score").where("score > 0")


def classify_records(records: DataFrame, rules: DigestRules) -> DataFrame:
    """Match the category keywords and classify; use when the rule filter did not run."""
    keywords = tuple(dict.fromkeys(k for group in rules.categories.values() for k in group))
    return classify(match_keywords(records, keywords), rules).drop("found")
