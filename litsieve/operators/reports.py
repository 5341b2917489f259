"""Feedback reports: counts, disagreements, suggestions and examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from litsieve.defaults import SUGGESTION_TOKENS
from litsieve.functions.text import text_or_empty
from litsieve.operators.skew import counts_with_first, first_rows, top_counts
from litsieve.session import stored


def decision_counts(reviewed: DataFrame) -> DataFrame:
    """One row: total and the count of each decision."""
    decision = F.col("final_decision")
    return reviewed.agg(
        F.count(F.lit(1)).alias("n_total"),
        *(F.count_if(decision == name).alias(f"n_{name}") for name in ("keep", "review", "reject")),
    )


def nonkeep_sources(reviewed: DataFrame, limit: int = 10) -> DataFrame:
    """Sources with most records that were not kept."""
    rows = reviewed.where(F.coalesce(F.col("final_decision"), F.lit("unknown")) != "keep")
    return _by_source(rows, limit)


def _by_source(rows: DataFrame, limit: int) -> DataFrame:
    narrow = rows.select(text_or_empty("source_id").alias("source_id"), "seq")
    return top_counts(narrow, "source_id", ["seq"], limit).select("source_id", "n")


def rule_feedback(reviewed: DataFrame, limit: int = 10) -> DataFrame:
    """First records the rules kept but the reviewer sent to review or reject."""
    kinds = reviewed.where(
        (F.col("rule_decision") == "keep") & F.col("llm_decision").isin("review", "reject")
    ).withColumn("kind", F.col("llm_decision"))
    narrow = kinds.select("kind", "seq", "source_id", "category", "title_en", "llm_reason")
    return first_rows(narrow, ["seq"], limit, ["kind"])


def category_overrides(reviewed: DataFrame, limit: int = 10) -> DataFrame:
    """First records whose category the reviewer replaced."""
    changed = reviewed.where(text_or_empty("llm_category_override") != "")
    narrow = changed.select("seq", "source_id", "category_original", "llm_category_override", "title_en")
    return first_rows(narrow, ["seq"], limit)


def other_sources(classified: DataFrame, limit: int = 20) -> DataFrame:
    return _by_source(classified.where("category = 'other'"), limit)


def review_sources(reviewed: DataFrame, limit: int = 20) -> DataFrame:
    return _by_source(reviewed.where("final_decision = 'review'"), limit)


def token_suggestions(
    classified: DataFrame,
    reviewed: DataFrame,
    tokens: Sequence[str] = SUGGESTION_TOKENS,
    limit: int = 30,
    examples: int = 3,
) -> DataFrame:
    """Suggested tokens over uncategorised and review records, with example titles.

    A record in both sets counts twice.  Tokens are substrings.  Counts and first
    titles combine in the tasks, in one pass over the records.
    """
    return _top_tokens(_with_tokens(classified, reviewed, tokens), limit, examples)


def _with_tokens(classified: DataFrame, reviewed: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Uncategorised (part 0) and review records (part 1) with the tokens found in them, without their texts."""
    columns = ["seq", "source_id", "title_en", "abstract"]
    rows = (
        classified.where("category = 'other'").select(F.lit(0).alias("part"), *columns)
        .unionByName(reviewed.where("final_decision = 'review'").select(F.lit(1).alias("part"), *columns))
    )
    text = F.lower(F.concat(text_or_empty("title_en"), F.lit(" "), text_or_empty("abstract")))
    numbered = F.array(*(F.struct(F.lit(i).alias("token_pos"), F.lit(t).alias("token")) for i, t in enumerate(tokens)))
    return rows.withColumn("text", text).select(
        "part", "seq", "source_id", "title_en",
        F.filter(numbered, lambda entry: F.col("text").contains(entry["token"])).alias("found"),
    )


def _top_tokens(rows: DataFrame, limit: int = 30, examples: int = 3) -> DataFrame:
    seen = rows.select("part", "seq", "title_en", F.explode("found").alias("t")).select(
        "part", "seq", "title_en", "t.token", "t.token_pos"
    )
    counted = counts_with_first(seen, "token", ["part", "seq", "token_pos"], examples, "title_en")
    top = counted.orderBy(F.desc("n"), "first").limit(limit)
    return top.select("token", "n", F.transform("first", lambda e: F.coalesce(e["shown"], F.lit(""))).alias("examples"))


def decision_examples(reviewed: DataFrame, decisions: Sequence[str] = ("review", "reject"), limit: int = 20) -> DataFrame:
    """First records of each decision with the reviewer's reason."""
    chosen = reviewed.where(F.col("final_decision").isin(*decisions))
    narrow = chosen.select(F.col("final_decision").alias("kind"), "seq", "source_id", "title_en", "llm_reason")
    return first_rows(narrow, ["seq"], limit, ["kind"])


def suggestions_report(classified: DataFrame, reviewed: DataFrame, tokens: Sequence[str] = SUGGESTION_TOKENS) -> DataFrame:
    """The suggestions as one JSON text: sources without class, sources under review, tokens.

    Each part is a top list of a fixed length, so the one row stays small.  Entries
    are listed by count, then by name.  Each input is computed once, into one narrow
    stored table that all three lists are made from.
    """
    rows = stored(_with_tokens(classified, reviewed, tokens))
    parts = {
        "other_sources": _by_source(rows.where("part = 0"), 20).withColumnRenamed("source_id", "name"),
        "review_sources": _by_source(rows.where("part = 1"), 20).withColumnRenamed("source_id", "name"),
        "tokens": _top_tokens(rows).select(F.col("token").alias("name"), "n"),
    }
    lists = None
    for part, df in parts.items():
        listed = df.select(F.lit(part).alias("part"), (-F.col("n")).alias("k"), "name")
        lists = listed if lists is None else lists.unionByName(listed)
    gathered = lists.agg(
        *(F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("k", "name")))).alias(part) for part in parts)
    )
    entries = [
        F.transform(part, lambda e: F.struct(e["name"].alias("name"), (-e["k"]).alias("n"))).alias(part) for part in parts
    ]
    return gathered.select(F.to_json(F.struct(*entries)).alias("report"))
