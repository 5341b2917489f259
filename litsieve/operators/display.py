"""Display order, grouping and card fields of a digest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litsieve import defaults as d
from litsieve.config import DisplayRules
from litsieve.functions.dates import date_label, parse_datetime
from litsieve.functions.keywords import contains_any, found_terms, hits_among, present_runs
from litsieve.functions.text import author_line, constant_map, first_filled, label_for, list_text, snippet, text_or_empty
from litsieve.operators.positions import with_rank
from litsieve.operators.skew import rank_rows
from litsieve.session import durable, evaluate_once

BUCKETS = tuple(d.DISPLAY_BUCKETS)
NOT_LISTED = 2**31 - 1


def _isin(column: Column, values: Sequence[str]) -> Column:
    return F.coalesce(column.isin(*values), F.lit(False)) if values else F.lit(False)


def plant_priority(rules: DisplayRules) -> Column:
    """By source group, or by a substring of journal, title and tags (not the abstract)."""
    text = F.lower(F.concat_ws(" ", text_or_empty("journal"), text_or_empty("title_en"), list_text("tags")))
    return _isin(F.col("group"), rules.plant_groups) | contains_any(text, rules.plant_tokens)


def category_or_other() -> Column:
    return F.coalesce(first_filled("category"), F.lit("other"))


def stage_or_journal() -> Column:
    return F.coalesce(first_filled("publication_stage"), F.lit("journal"))


def visually_hidden(records: DataFrame, rules: DisplayRules) -> DataFrame:
    """Add ``hidden``: broad-scope source, no plant priority, not the exempt category, keyword hit."""
    text = F.lower(
        F.concat_ws(
            " ", text_or_empty("journal"), text_or_empty("title_en"), text_or_empty("abstract"), list_text("tags")
        )
    )
    candidate = (
        _isin(F.col("source_id"), rules.hidden_source_ids)
        & ~plant_priority(rules)
        & (F.coalesce(F.col("category"), F.lit("")) != rules.never_hidden_category)
    )
    # Other records keep no text, so only candidates are split into words.
    prepared = records.withColumn("hide_text", F.when(candidate, text))
    runs = evaluate_once(prepared, hide_runs=present_runs("hide_text", rules.hidden_keywords))
    found = evaluate_once(
        runs, hidden=F.size(hits_among(found_terms("hide_text", "hide_runs", rules.hidden_keywords), rules.hidden_keywords)) > 0
    )
    return found.withColumn("hidden", F.coalesce(F.col("hide_text").isNotNull() & F.col("hidden"), F.lit(False))).drop(
        "hide_text", "hide_runs"
    )


def display_bucket(rules: DisplayRules) -> Column:
    top = _isin(F.col("source_id"), rules.top_source_ids)
    plant = plant_priority(rules)
    category = category_or_other()
    return (
        F.when(top & plant, "top-plant")
        .when(top, "top-journals")
        .when(plant, "plant-priority")
        .when(_isin(category, rules.non_deferred_categories), "ai-priority")
        .when(_isin(category, rules.deferred_categories), "deferred-gene-function")
        .otherwise("other-biology")
    )


def _publish_text(records: DataFrame) -> Column:
    names = [n for n in ("publish_date", "published_at") if n in records.columns]
    return text_or_empty(first_filled(*names))


def with_display_keys(records: DataFrame, rules: DisplayRules) -> DataFrame:
    """Add the sort keys of a record.

    ``k_plant`` plant first; ``k_decision`` keep, review, reject; ``k_confidence``
    most certain first among kept records, least certain first otherwise;
    ``k_time`` newest first with undated records last; ``k_title``.
    """
    decision = F.lower(F.coalesce(first_filled("final_decision"), first_filled("llm_decision"), F.lit("keep")))
    time = F.unix_micros(parse_datetime(_publish_text(records)))
    confidence = F.coalesce(F.col("llm_confidence").cast("double"), F.when(decision == "keep", 1.0).otherwise(0.0))
    rank = F.when(decision == "review", 1).when(decision == "reject", 2).otherwise(0)
    return records.withColumns(
        {
            "k_plant": F.when(plant_priority(rules), 0).otherwise(1),
            "k_decision": rank,
            "k_confidence": F.when(rank == 0, -confidence).otherwise(confidence),
            "k_time": -F.coalesce(time, F.lit(0)),
            "k_title": F.lower(text_or_empty("title_en")),
        }
    )


DISPLAY_KEYS = ("k_plant", "k_decision", "k_confidence", "k_time", "k_title", "seq")


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def display_order(keyed: DataFrame, groups: Sequence[str] = (), name: str = "display_rank", **options) -> DataFrame:
    """``seq`` and the position in display order, over all records or per group."""
    return rank_rows(keyed, _columns(DISPLAY_KEYS), groups, name=name, **options)


def _source_position(rules: DisplayRules) -> Column:
    if not rules.source_order:
        return F.lit(None).cast("int")
    order = constant_map({s: str(i) for i, s in enumerate(rules.source_order)})
    return F.try_element_at(order, F.col("source_id")).cast("int")


def _tier(rules: DisplayRules, any_plant: Column, all_deferred: Column) -> Column:
    return (
        F.when(_source_position(rules).isNotNull(), 0).when(any_plant, 1).when(all_deferred, 3).otherwise(2)
    )


def journal_groups(keyed: DataFrame, rules: DisplayRules, stage: Sequence[str] = ()) -> DataFrame:
    """One row per source (and stage) with its sort keys and size.

    Groups with only review or reject records sort last, then the listed
    sources, then groups with a plant record, the rest, and groups that hold
    nothing but deferred non-plant records.
    """
    deferred = _isin(F.col("category"), rules.deferred_categories) & (F.col("k_plant") == 1)
    grouped = keyed.groupBy(*stage, "source_id").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min(F.when(F.col("k_decision") > 0, 1).otherwise(0)).alias("all_review"),
        F.bool_or(F.col("k_plant") == 0).alias("any_plant"),
        F.bool_and(deferred).alias("all_deferred"),
        F.min_by("journal", F.struct(*DISPLAY_KEYS)).alias("best_journal"),
        F.max_by("journal", F.struct(*DISPLAY_KEYS)).alias("group_label"),
    )
    return grouped.select(
        *stage,
        "source_id",
        "n_records",
        "group_label",
        "all_review",
        _tier(rules, F.col("any_plant"), F.col("all_deferred")).alias("tier"),
        F.coalesce(_source_position(rules), F.lit(0)).alias("tier_position"),
        F.lower(text_or_empty("best_journal")).alias("group_name"),
    )


GROUP_KEYS = ("all_review", "tier", "tier_position", "group_name", "source_id")


def rank_groups(groups: DataFrame, stage: Sequence[str] = (), **options) -> DataFrame:
    """Add ``group_rank`` to the group table."""
    ranks = rank_rows(groups, _columns(GROUP_KEYS), stage, row_id="source_id", name="group_rank", **options)
    return groups.join(ranks, [*stage, "source_id"])


def stage_rank() -> Column:
    """Journal papers first, then preprints, then the rest by name."""
    stage = stage_or_journal()
    return F.when(stage == "journal", 0).when(stage == "preprint", 1).otherwise(2)


def _digest_keys(rules: DisplayRules, grouping: str | None) -> list[Column]:
    """Sort keys of the exported digest for records with display keys.

    The group key is computed on the single record, so records under review come
    after all kept records of their stage, whatever their source.
    """
    stage = F.coalesce(F.col("publication_stage"), F.lit("journal"))
    stage_key = F.when(stage == "journal", 0).when(stage == "preprint", 1).otherwise(9)
    if (grouping or rules.grouping_mode) == "journal":
        deferred = _isin(F.col("category"), rules.deferred_categories) & (F.col("k_plant") == 1)
        group_key = [
            F.when(F.col("k_decision") > 0, 1).otherwise(0),
            _tier(rules, F.col("k_plant") == 0, deferred),
            F.coalesce(_source_position(rules), F.lit(0)),
        ]
    else:
        order = F.array(*(F.lit(b) for b in BUCKETS))
        group_key = [F.array_position(order, display_bucket(rules)).cast("int"), F.lit(0), F.lit(0)]
    journal = F.lower(text_or_empty("journal"))
    return [stage_key, *group_key, journal, *_columns(DISPLAY_KEYS)]


def digest_order(records: DataFrame, rules: DisplayRules, grouping: str | None = None, **options) -> DataFrame:
    """``seq`` and ``digest_rank``: the row order of the exported digest."""
    keyed = with_display_keys(records, rules)
    return rank_rows(keyed, _digest_keys(rules, grouping), name="digest_rank", **options)


def in_digest_order(records: DataFrame, rules: DisplayRules, grouping: str | None = None) -> DataFrame:
    """``records`` with their ``digest_rank``, in one sorted pass that carries all columns."""
    keyed = with_display_keys(records, rules)
    added = [c for c in keyed.columns if c not in records.columns]
    return with_rank(keyed, _digest_keys(rules, grouping), name="digest_rank", keep=True).drop(*added)


def priority_groups(records: DataFrame, rules: DisplayRules, **options) -> DataFrame:
    """``seq``, bucket and the position inside the bucket."""
    keyed = with_display_keys(records, rules).withColumn("bucket", display_bucket(rules))
    return display_order(keyed, ["bucket"], "bucket_rank", **options)


def card_fields(records: DataFrame) -> DataFrame:
    """What a card shows, as columns."""
    doi = text_or_empty("doi")
    abstract = text_or_empty("abstract")
    return records.select(
        "seq",
        text_or_empty(
            first_filled("article_url", F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)))
        ).alias("href"),
        date_label(parse_datetime(_publish_text(records))).alias("date_label"),
        F.when(abstract == "", F.lit("No abstract captured.")).otherwise(snippet(abstract, 220)).alias("preview"),
        author_line("authors").alias("author_line"),
        label_for(stage_or_journal(), d.STAGE_LABELS).alias("stage_label"),
        label_for(category_or_other(), d.CATEGORY_LABELS).alias("category_label"),
        text_or_empty("title_en").alias("title_en"),
        text_or_empty("journal").alias("journal"),
        list_text("tags").alias("tags"),
    )


def with_publish_date(records: DataFrame) -> DataFrame:
    """Fill ``publish_date`` from ``published_at`` where it is missing."""
    known = first_filled("publish_date") if "publish_date" in records.columns else F.lit(None).cast("string")
    return records.withColumn("publish_date", F.coalesce(known, F.col("published_at")))


def digest_sections(
    records: DataFrame, rules: DisplayRules, grouping: str | None = None, labels: Mapping[str, str] = d.DISPLAY_BUCKETS, **options
) -> DataFrame:
    """Cards of the digest body with their place: stage, group and rank in group.

    One row per card, so a group of any size stays spread over tasks; sort by
    ``stage_rank, stage, group_rank, card_rank`` to read the digest.
    """
    shown = visually_hidden(records, rules).where(~F.col("hidden")).drop("hidden")
    keyed = with_display_keys(shown, rules).withColumns(
        {"stage": stage_or_journal(), "stage_rank": stage_rank(), "bucket": display_bucket(rules)}
    )
    # Groups, ranks and sizes all start from these few columns.
    keyed = durable(
        keyed.select("source_id", "journal", "category", "stage", "stage_rank", "bucket", *DISPLAY_KEYS)
    )
    if (grouping or rules.grouping_mode) == "journal":
        groups = rank_groups(journal_groups(keyed, rules, ["stage"]), ["stage"], **options)
        placed = display_order(keyed, ["stage_rank", "stage", "source_id"], "card_rank", keep=False, **options)
        rows = placed.join(groups, ["stage", "source_id"])
    else:
        order = F.array(*(F.lit(b) for b in BUCKETS))
        placed = display_order(keyed, ["stage_rank", "stage", "bucket"], "card_rank", keep=False, **options)
        sizes = placed.groupBy("stage", "bucket").agg(F.count(F.lit(1)).alias("n_records"))
        rows = placed.join(sizes, ["stage", "bucket"]).withColumns(
            {
                "group_rank": F.array_position(order, F.col("bucket")),
                "group_label": label_for(F.col("bucket"), dict(labels)),
            }
        )
    return rows.select(
        "seq", "stage_rank", "stage", label_for("stage", d.STAGE_LABELS).alias("stage_label"),
        "group_rank", "group_label", "n_records", "card_rank",
    )


def review_sections(records: DataFrame, order: Sequence[Column], **options) -> DataFrame:
    """Review table rows with their place: stage, category by name, row in category."""
    placed = records.withColumns(
        {"stage": stage_or_journal(), "stage_rank": stage_rank(), "section": category_or_other()}
    )
    return rank_rows(placed, order, ["stage_rank", "stage", "section"], name="row_rank", **options)
