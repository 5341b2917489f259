"""The daily digest as one chain of lazy tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation

from litsieve.config import DigestRules, Glossary
from litsieve.operators.classify import classify
from litsieve.operators.dedupe import resolve_duplicates
from litsieve.operators.display import in_digest_order, with_publish_date
from litsieve.operators.localization import localize, localize_by_template
from litsieve.operators.normalize import normalize_records, normalized_order, publish_time
from litsieve.operators.providers import CallPolicy
from litsieve.operators.relevance import filter_relevance
from litsieve.operators.review import apply_decisions, review
from litsieve.operators.routing import delivery_blocked, digest_input, route
from litsieve.operators.sinks import export_rows, write_archive, write_csv, write_routes
from litsieve.operators.windows import lookback_filter, observed_window, window_filter


@dataclass(frozen=True)
class DigestRun:
    """Tables of one run; each is lazy unless a work folder was given."""

    normalized: DataFrame
    duplicates: DataFrame
    filtered: DataFrame
    reviewed: DataFrame
    final: DataFrame
    localized: DataFrame
    window_counts: Observation | None = None

    def normalized_order(self) -> DataFrame:
        """``seq`` and ``rank`` of the normalized records, newest first."""
        return normalized_order(self.normalized)


def _stage(df: DataFrame, folder: str | None, name: str, partition: str | None = None) -> DataFrame:
    """Keep a stage as a table when there is a work folder.

    A stage that several outputs read is then computed once and scanned with
    column pruning and partition pruning.
    """
    if folder is None:
        return df
    path = f"{folder}/{name}"
    if partition:
        write_routes(df, path, partition)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_digest(
    raw: DataFrame,
    rules: DigestRules,
    glossary: Glossary = Glossary(),
    sources: DataFrame | None = None,
    start: Column | None = None,
    end: Column | None = None,
    as_of: Column | None = None,
    lookback_hours: int | None = None,
    decisions: DataFrame | None = None,
    reviewer: Callable[[dict], dict] | None = None,
    translate: Callable[[str], str] | None = None,
    secondary: Callable[[str], str] | None = None,
    policy: CallPolicy = CallPolicy(),
    include_review: bool = True,
    work_folder: str | None = None,
    count_window: bool = False,
) -> DigestRun:
    """Window, normalize, resolve, filter, classify, review, decide, localize.

    The window applies to the parsed publish time alone, so it runs before any
    text is cleaned.  ``count_window`` counts what it lets through and drops, in the same
    pass: ``window_counts`` holds the numbers once the normalized stage is written.
    """
    inside, window_counts = raw, None
    if count_window:
        inside, window_counts = observed_window(raw, publish_time(raw), start, end)
    elif start is not None or end is not None:
        inside = window_filter(raw, publish_time(raw), start, end)
    elif lookback_hours is not None and as_of is not None:
        inside = lookback_filter(raw, publish_time(raw), as_of, lookback_hours)
    normalized = _stage(normalize_records(inside), work_folder, "normalized")
    resolution = resolve_duplicates(normalized)
    filtered = filter_relevance(resolution.survivors, rules, sources)
    kept = classify(filtered.where("relevance_status = 'keep'"), rules).drop("found")
    reviewed = _stage(review(kept, rules, reviewer, policy=policy), work_folder, "reviewed", "final_decision")
    final = apply_decisions(reviewed, decisions) if decisions is not None else reviewed
    chosen = digest_input(final, include_review)
    if translate is None:
        localized = localize_by_template(chosen, rules.max_sentences)
    else:
        localized = localize(chosen, translate, glossary, secondary, policy, rules.max_sentences)
    return DigestRun(
        normalized=resolution.survivors,
        duplicates=resolution.duplicates,
        filtered=filtered.drop("found"),
        reviewed=reviewed,
        final=final,
        localized=_stage(localized, work_folder, "localized"),
        window_counts=window_counts,
    )


def digest_table(run: DigestRun, rules: DigestRules, grouping: str | None = None) -> DataFrame:
    """Export rows of the digest with ``digest_rank``."""
    records = with_publish_date(run.localized)
    return export_rows(in_digest_order(records, rules.display, grouping), rules.digest_columns, ["digest_rank"])


def review_table(run: DigestRun, rules: DigestRules, grouping: str | None = None) -> DataFrame:
    """Export rows of the review queue with ``digest_rank``."""
    queue = with_publish_date(run.final.where(route() == "review"))
    return export_rows(in_digest_order(queue, rules.display, grouping), rules.review_columns, ["digest_rank"])


def write_digest(
    run: DigestRun,
    rules: DigestRules,
    folder: str,
    digest_date: Column,
    allow_review_pending: bool = True,
) -> bool:
    """Write digest, review queue and the dated archive; False when review blocks delivery."""
    digest = digest_table(run, rules)
    write_csv(digest, f"{folder}/digest", "digest_rank", rules.digest_columns)
    write_csv(review_table(run, rules), f"{folder}/review_queue", "digest_rank", rules.review_columns)
    write_archive(digest.withColumn("digest_date", digest_date), f"{folder}/archive")
    return not delivery_blocked(run.final, allow_review_pending)


