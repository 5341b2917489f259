"""One query per operator over the given tables.

Arrays are shown as joined text and times as ISO text, so that results compare
across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.functions.dates import iso_utc, parse_datetime
from litsieve.functions.identifiers import canonical_doi, canonical_url
from litsieve.functions.keywords import found_terms, hits_among, present_runs
from litsieve.functions.payloads import json_path
from litsieve.functions.rewriting import apply_glossary, cap_sentences, leading_sentences, trace_glossary
from litsieve.functions.text import author_line, clean_text, normalize_title, snippet
from litsieve.operators import dedupe, display, normalize, reports, review as reviews, routing, sinks, terms, windows
from litsieve.operators.classify import category_scores, classify, classify_records
from litsieve.operators.journal import ReplyJournal, ask_once
from litsieve.operators.localization import (
    localize,
    localize_from_memory,
    template_summary,
)
from litsieve.operators.normalize import completeness, normalize_records, publish_time
from litsieve.operators.providers import CallPolicy
from litsieve.operators.relevance import filter_relevance
from litsieve.plans.tables import (
    PROSE_GLOSSARY,
    PROSE_RULES,
    PROSE_TOKENS,
    decisions,
    feed_payloads,
    raw_records,
    registry,
    table,
    records_from,
)
from litsieve.schemas import NORMALIZED_COLUMNS
from litsieve.session import durable, shared_folder, stored
from litsieve.sources.dispatch import Acquired, acquire, limit_per_source
from litsieve.sources.feeds import read_feeds, skip_front_matter
from litsieve.sources.listings import listing_links, page_links
from litsieve.sources.records import filled_decisions, read_decisions, scan_records as scan_json
from litsieve.sources.registry import enrich, select_sources as choose_sources, source_locators
from litsieve.streaming import resolution, runs

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_START = "2024-01-05 00:00:00"
WINDOW_END = "2024-01-12 12:00:00"
AS_OF = "2024-01-15 00:00:00"


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _joined(*names: str) -> list[Column]:
    return [F.array_join(n, "|").alias(n) for n in names]


# --- shared chains -----------------------------------------------------------


def _normalized(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_records(raw_records(spark, sf))


def _filtered(spark: SparkSession, sf: str) -> DataFrame:
    return filter_relevance(_normalized(spark, sf), PROSE_RULES, registry(spark, sf))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify(_filtered(spark, sf), PROSE_RULES)


def _reviewed(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.review(_classified(spark, sf).drop("found"), PROSE_RULES)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a stored reviewer response from ``labels``.

    The label table is joined on the document id, one row per id.
    """
    response = F.to_json(
        F.struct(
            F.struct(
                F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "Keep").otherwise("unsure").alias("decision"),
                F.concat(F.lit("0."), (F.col("doc_id") * 7919 % 9000 + 1000).cast("string")).alias("confidence"),
                F.when(F.col("toxic") == 1, "toxic").alias("reason"),
                F.when((F.col("toxic") == 0) & (F.col("quality") == 0), "iberic").alias("category_override"),
            ).alias("result")
        )
    )
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("seq"), response.alias("response"))
    classified = _classified(spark, sf).drop("found")
    return classified.join(labels, "seq", "left")


def _provided(spark: SparkSession, sf: str) -> DataFrame:
    records = _labelled(spark, sf).withColumn("payload", reviews.payload_from_json("response", "result"))
    return reviews.finalize_review(records.drop("response"), PROSE_RULES.review)


def _final(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.apply_decisions(_reviewed(spark, sf), filled_decisions(decisions(spark, sf)))


# --- sources -----------------------------------------------------------------


def scan_records(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    sinks.write_records(raw_records(spark, sf), path)
    scanned = scan_json(spark, path)
    return scanned.select("seq", "source_id", "group", "title", "link", "published", "abstract", "doi", *_joined("tags", "authors"))


def _feed(form: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        records = read_feeds(feed_payloads(spark, sf, form))
        return records.select(
            "source_id", "journal", "group", "source_url", "item_pos", "title", "link", "published", "abstract", "doi",
            *_joined("tags", "authors"),
        )

    return query


def _acquired(spark: SparkSession, sf: str) -> Acquired:
    """First 30 records of each enabled source from its two addresses, in listed order.

    The second address is listed first for every other source, each source has one
    address without a payload, and one payload in seven is cut off.
    """
    feeds = feed_payloads(spark, sf, "rss").select("source_id", "url", F.col("payload").alias("whole"))
    number = F.col("source_id").substr(4, 9).cast("int")
    half = F.floor(F.length("whole") / 2).cast("int")
    sides = feeds.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("side"))
    # Where only addresses are asked for, no text takes part.
    two = sides.select(
        "source_id", F.concat_ws("/", "url", "side").alias("url"),
        F.when((F.col("side") == "a") & (number % 7 == 3), F.left("whole", half)).otherwise(F.col("whole")).alias("payload"),
    )
    known = two.groupBy("source_id").agg(F.array_sort(F.collect_set("url")).alias("urls"))
    listed = F.when(number % 2 == 1, F.reverse("urls")).otherwise(F.col("urls"))
    sources = known.select(
        "source_id", (number != 10).alias("enabled"), F.concat(F.lit("Journal "), "source_id").alias("journal"),
        F.lit("family").alias("publisher_family"), F.lit("general").alias("group"), F.lit("journal").alias("publication_stage"),
        F.lit("official_feed_or_toc").alias("source_strategy"),
        F.concat(listed, F.array(F.lit("https://nowhere.example.org/"))).alias("source_locator"), number.alias("position"),
    )
    return acquire(two.select("url", "payload"), None, None, F.lit("2024-06-01T00:00:00Z"), 30, sources=choose_sources(sources))


def acquire_rest(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads that nothing could read, and listed addresses without one."""
    got = _acquired(spark, sf)
    rest = got.quarantine.select(F.lit("quarantine").alias("kind"), "source_id", "url")
    return rest.unionByName(got.missing.select(F.lit("missing").alias("kind"), "source_id", "url"))


def acquire_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records that the acquire step lets through."""
    return _acquired(spark, sf).records.select("seq", "source_id", "source_url", "title", "fetched_at")


def html_links(spark: SparkSession, sf: str) -> DataFrame:
    links = page_links(table(spark, sf, "pages"))
    return links.select("page_id", "link_pos", "href", "link_text")


def html_listing(spark: SparkSession, sf: str) -> DataFrame:
    links = listing_links(table(spark, sf, "pages"), "/", 4, ("that", "aulich"))
    return links.select("page_id", "link", "title", "link_pos")


def select_sources(spark: SparkSession, sf: str) -> DataFrame:
    chosen = choose_sources(registry(spark, sf), ("src1", "src2", "src5", "src10", "src14"))
    return source_locators(chosen).select("source_id", "journal", "group", "locator_pos", "url")


def skip_front_matter_query(spark: SparkSession, sf: str) -> DataFrame:
    # Titles are cut to their first word, so that listed ones occur.
    raw = raw_records(spark, sf).withColumn("title", F.substring_index("title", " ", 1))
    return skip_front_matter(raw, ("the", "on", "de", "der", "la")).select("seq", "title")


# --- filters and windows -----------------------------------------------------


def _ingested(spark: SparkSession, sf: str) -> str:
    """Folder of the records, laid out by publish day."""
    path, raw = f"{shared_folder(spark)}/ingested-{uuid.uuid4().hex}", raw_records(spark, sf)
    sinks.write_ingested(raw, path, publish_time(raw))
    return path


def ingest_window(spark: SparkSession, sf: str) -> DataFrame:
    kept = windows.scan_window(spark, _ingested(spark, sf), _time(WINDOW_START), _time(WINDOW_END), undated=True)
    return kept.select("seq", "published")


def window_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = windows.scan_window(spark, _ingested(spark, sf), _time(WINDOW_START), _time(WINDOW_END))
    return kept.select("seq", iso_utc("published_ts").alias("published_at"))


def window_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the window, taken while the filtered records are written."""
    raw = raw_records(spark, sf)
    kept, seen = windows.observed_window(raw, publish_time(raw), _time(WINDOW_START), _time(WINDOW_END))
    normalize_records(kept).write.parquet(f"{shared_folder(spark)}/observed-{uuid.uuid4().hex}")
    return spark.createDataFrame([seen.get], "n_total long, n_inside long, n_undated long, n_outside long")


def window_stats(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf)
    return windows.window_stats(raw, publish_time(raw), _time(WINDOW_START), _time(WINDOW_END))


def lookback_filter(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf)
    return windows.lookback_filter(raw, publish_time(raw), _time(AS_OF), 96).select("seq", "published")


def digest_window(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    start, end = windows.scheduled_window("ts", "Asia/Shanghai", "08:00")
    return events.select(
        "event_id", iso_utc(start).alias("window_start"), iso_utc(end).alias("window_end"),
        F.date_format(windows.archive_date(end, "Asia/Shanghai"), "yyyy-MM-dd").alias("digest_date"),
    )


def digest_windows(spark: SparkSession, sf: str) -> DataFrame:
    events = windows.digest_windows(table(spark, sf, "events"), "ts")
    return events.groupBy(
        iso_utc("window_start").alias("window_start"), iso_utc("window_end").alias("window_end"), "event_type"
    ).agg(F.count(F.lit(1)).alias("n"))


def limit_per_source_query(spark: SparkSession, sf: str) -> DataFrame:
    return limit_per_source(raw_records(spark, sf), 20).select("source_id", "seq")


# --- scalar functions --------------------------------------------------------


def clean_text_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", clean_text("html").alias("cleaned"))


def normalize_title_query(spark: SparkSession, sf: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf, "pages").select("page_id", normalize_title(title).alias("title_norm"))


def canonical_doi_query(spark: SparkSession, sf: str) -> DataFrame:
    return raw_records(spark, sf).select("seq", canonical_doi("doi").alias("doi"))


def canonical_url_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", canonical_url("url").alias("canonical_url"))


def parse_datetime_query(spark: SparkSession, sf: str) -> DataFrame:
    return raw_records(spark, sf).select("seq", iso_utc(parse_datetime("published")).alias("published_at"))


def snippet_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", snippet("text", 120).alias("snippet"))


def author_line_query(spark: SparkSession, sf: str) -> DataFrame:
    return raw_records(spark, sf).select("seq", author_line("authors").alias("author_line"))


def glossary_apply(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", apply_glossary("text", PROSE_GLOSSARY.replacements).alias("rewritten")
    )


def glossary_trace(spark: SparkSession, sf: str) -> DataFrame:
    traced = table(spark, sf, "conversations").select(
        "conv_id", "turn", trace_glossary("text", PROSE_GLOSSARY.replacements).alias("t")
    )
    return traced.select(
        "conv_id", "turn", F.col("t.text").alias("rewritten"),
        F.array_join(F.transform("t.changes", lambda c: F.concat(c["source"], F.lit(">"), c["target"])), "|").alias("changes"),
    )


def summary_text(spark: SparkSession, sf: str) -> DataFrame:
    text = F.replace(F.replace("text", F.lit(". "), F.lit("。")), F.lit(", "), F.lit("! "))
    return table(spark, sf, "documents").select("doc_id", leading_sentences(text).alias("summary"))


def sentence_cap(spark: SparkSession, sf: str) -> DataFrame:
    text = F.replace(F.replace("text", F.lit(". "), F.lit("。")), F.lit(", "), F.lit("? "))
    return table(spark, sf, "conversations").select("conv_id", "turn", cap_sentences(text, 4).alias("capped"))


def template_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    # Preprints come without an abstract here, so that both forms of the summary occur.
    shown = records.withColumn("abstract", F.when(F.col("publication_stage") == "preprint", "").otherwise(F.col("abstract")))
    labels = {"romance": "罗曼", "germanic": "日耳曼", "other": "其他"}
    return shown.select("seq", template_summary(labels).alias("summary_zh"))


def review_payload(spark: SparkSession, sf: str) -> DataFrame:
    wrapped = F.concat(F.lit('{"data":[{"value":'), "props", F.lit("}]}"))
    return table(spark, sf, "events").select(
        "event_id", json_path("props", "k").alias("k"), json_path(wrapped, "data.0.value.k").alias("deep"),
        json_path("props", "missing.x").alias("missing"),
    )


# --- normalization and duplicates -------------------------------------------


def normalize_query(spark: SparkSession, sf: str) -> DataFrame:
    rest = [c for c in NORMALIZED_COLUMNS if c not in ("tags", "authors")]
    return _normalized(spark, sf).select("seq", *rest, *_joined("tags", "authors"))


def normalized_order(spark: SparkSession, sf: str) -> DataFrame:
    """Newest first; equal rows keep their input order."""
    return normalize.normalized_order(_normalized(spark, sf))


def dedupe_key(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).select("seq", dedupe.dedupe_key().alias("dedupe_key"))


def dedupe_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).select("seq", F.posexplode(dedupe.dedupe_candidates()).alias("pos", "candidate"))


def dedupe_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.clusters(durable(dedupe.key_table(_normalized(spark, sf))))


def completeness_query(spark: SparkSession, sf: str) -> DataFrame:
    records = _normalized(spark, sf)
    return records.select("seq", completeness(records).alias("score"))


def dedupe_survivors(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.resolve_duplicates(_normalized(spark, sf)).survivors.select("seq", "title_en", "doi")


def dedupe_audit(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.resolve_duplicates(_normalized(spark, sf)).duplicates.select("seq", "title_en", "duplicate_of")


# --- relevance, classes, review ---------------------------------------------


def keyword_hits(spark: SparkSession, sf: str) -> DataFrame:
    keywords = PROSE_RULES.relevance.keep_keywords + PROSE_RULES.relevance.reject_keywords
    lowered = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("lowered"))
    runs_found = lowered.withColumn("present", present_runs("lowered", keywords))
    found = runs_found.withColumn("found", found_terms("lowered", "present", keywords))
    return found.select("doc_id", F.array_join(hits_among("found", keywords), "|").alias("hits"))


def source_enrich(spark: SparkSession, sf: str) -> DataFrame:
    records = raw_records(spark, sf).select("seq", "source_id")
    enabled = choose_sources(registry(spark, sf)).withColumnRenamed("group", "registry_group")
    return enrich(records, enabled, ["registry_group"]).select("seq", "source_id", "registry_group")


def relevance_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf).select(
        "seq", "relevance_status", "relevance_reason",
        *_joined("relevance_keep_hits", "relevance_ai_keep_hits", "relevance_reject_hits", "relevance_hard_reject_hits"),
    )


def category_scores_query(spark: SparkSession, sf: str) -> DataFrame:
    return category_scores(_normalized(spark, sf), PROSE_RULES)


def classify_query(spark: SparkSession, sf: str) -> DataFrame:
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    return records.select("seq", "category", "category_reason", *_joined("category_hits"))


def heuristic_review(spark: SparkSession, sf: str) -> DataFrame:
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    # Records of one class count as unclassified, so that every branch is taken.
    opened = records.withColumn("category", F.when(F.col("category") == "romance", "other").otherwise(F.col("category")))
    return reviews.heuristic_review(opened, PROSE_RULES.review).select(
        "seq", "payload.decision", "payload.confidence", "payload.reason"
    )


def finalize_review(spark: SparkSession, sf: str) -> DataFrame:
    return _provided(spark, sf).select(
        "seq", "rule_decision", "llm_decision", "llm_confidence", "llm_reason", "category_original",
        "llm_category_override", "category", "final_decision",
    )


def _by_length(record: dict) -> dict:
    length = len(record["abstract"] or "")
    return {
        "decision": "keep" if length > 2000 else "unsure",
        "confidence": 0.9 if length > 1000 else 0.7 if length > 300 else 0.2,
        "reason": f"{length} characters",
        "category_override": "long-read" if length > 8000 else None,
    }


def review_provider(spark: SparkSession, sf: str) -> DataFrame:
    """A callable that decides by length; it sees every record once."""
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    done = reviews.review(records, PROSE_RULES, _by_length, ["abstract"])
    return done.select("seq", "llm_decision", "llm_confidence", "llm_reason", "category")


def review_journal(spark: SparkSession, sf: str) -> DataFrame:
    """The same callable behind a journal: equal abstracts are asked for once, and a second run asks for none."""

    def refuses(record: dict) -> dict:
        raise AssertionError("this reply is in the journal")

    records = stored(classify_records(_normalized(spark, sf), PROSE_RULES))
    journal = ReplyJournal(f"{shared_folder(spark)}/replies-{uuid.uuid4().hex}")
    ask_once(records, ["abstract"], _by_length, journal, CallPolicy(concurrency=8))
    done = reviews.review(records, PROSE_RULES, refuses, ["abstract"], journal=journal)
    return done.select("seq", "llm_decision", "llm_confidence", "llm_reason", "category")


def manual_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return _final(spark, sf).select(
        "seq", "final_decision", "manual_review_applied", "manual_review_decision", "reviewer_notes", "category",
        "category_original",
    )


def decisions_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Edited review files, written in two parts and read back: the last filled row of a file name wins."""
    path = f"{shared_folder(spark)}/decisions-{uuid.uuid4().hex}"
    edited = decisions(spark, sf).select("journal", "doi", "title_en", "article_url", "review_final_decision", "review_final_category", "reviewer_notes")
    edited.repartitionByRange(2, "doi").write.option("header", True).option("escape", '"').csv(path)
    read = read_decisions(spark, path)
    return read.groupBy("review_final_decision", "review_final_category", "reviewer_notes").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("title_en").alias("n_titles"), F.min("doi").alias("first_doi")
    )


def relevance_split(spark: SparkSession, sf: str) -> DataFrame:
    """Kept and rejected records as two partitions of one table; the rejected one is read back."""
    path = f"{shared_folder(spark)}/relevance-{uuid.uuid4().hex}"
    filtered = _filtered(spark, sf).drop("found")
    sinks.write_routes(filtered, path, "relevance_status")
    return spark.read.schema(filtered.schema).parquet(path).where("relevance_status = 'reject'").select("seq", "relevance_status", "relevance_reason")


def delivery_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the waiting review queue blocks the delivery, of all records and of the kept ones."""
    final = stored(_final(spark, sf).select("final_decision"))
    rows = [
        (name, routing.delivery_blocked(part), routing.delivery_blocked(part, allow_review_pending=True))
        for name, part in (("all", final), ("kept", final.where("final_decision = 'keep'")))
    ]
    return spark.createDataFrame(rows, "records string, blocked boolean, blocked_if_allowed boolean")


def fallback_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Translated records, some of which came without an abstract."""
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    shown = records.withColumn("abstract", F.when(F.col("publication_stage") == "preprint", "").otherwise(F.col("abstract")))
    return localize(shown, _mark, PROSE_GLOSSARY).where("publication_stage = 'preprint'").select("seq", "summary_zh")


def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_counts(_final(spark, sf))


def digest_gate(spark: SparkSession, sf: str) -> DataFrame:
    return routing.digest_input(_reviewed(spark, sf)).select("seq", "part", "final_decision")


# --- reports -----------------------------------------------------------------


def decision_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.decision_counts(_reviewed(spark, sf))


def nonkeep_sources(spark: SparkSession, sf: str) -> DataFrame:
    return reports.nonkeep_sources(_provided(spark, sf))


def rule_feedback(spark: SparkSession, sf: str) -> DataFrame:
    return reports.rule_feedback(_provided(spark, sf))


def category_overrides(spark: SparkSession, sf: str) -> DataFrame:
    return reports.category_overrides(_provided(spark, sf))


def other_sources(spark: SparkSession, sf: str) -> DataFrame:
    # The German word lists are left out here, so German texts stay unclassified.
    return reports.other_sources(_with_others(spark, sf))


def _with_others(spark: SparkSession, sf: str) -> DataFrame:
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    return records.withColumn("category", F.when(F.col("category") == "germanic", "other").otherwise(F.col("category")))


def review_sources(spark: SparkSession, sf: str) -> DataFrame:
    return reports.review_sources(_provided(spark, sf))


def token_suggestions(spark: SparkSession, sf: str) -> DataFrame:
    found = reports.token_suggestions(_with_others(spark, sf), _provided(spark, sf), PROSE_TOKENS)
    return found.select("token", "n", F.array_join("examples", "|").alias("examples"))


def suggestions_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.suggestions_report(_with_others(spark, sf), _provided(spark, sf), PROSE_TOKENS)


def review_examples(spark: SparkSession, sf: str) -> DataFrame:
    return reports.decision_examples(_provided(spark, sf))


def glossary_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Known terms: the glossary, and every item of ``benchmark`` in term form."""
    known = spark.createDataFrame([(t,) for t in PROSE_GLOSSARY.known_terms()], "term string").unionByName(
        table(spark, sf, "benchmark").select(terms.normalize_term("text").alias("term"))
    )
    found = terms.glossary_candidates(_normalized(spark, sf), known)
    return found.select(
        "term", "n", "first_seq", F.array_join("examples", "|").alias("examples")
    )


# --- display -----------------------------------------------------------------


def _shown(spark: SparkSession, sf: str) -> DataFrame:
    return routing.digest_input(_provided(spark, sf))


def visual_filter(spark: SparkSession, sf: str) -> DataFrame:
    return display.visually_hidden(_provided(spark, sf), PROSE_RULES.display).select("seq", "hidden")


def display_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return _provided(spark, sf).select("seq", display.display_bucket(PROSE_RULES.display).alias("bucket"))


def display_order(spark: SparkSession, sf: str) -> DataFrame:
    keyed = display.with_display_keys(_provided(spark, sf), PROSE_RULES.display)
    return display.display_order(keyed)


def journal_groups(spark: SparkSession, sf: str) -> DataFrame:
    keyed = display.with_display_keys(_shown(spark, sf), PROSE_RULES.display)
    groups = display.journal_groups(keyed, PROSE_RULES.display)
    return display.rank_groups(groups).select("source_id", "n_records", "all_review", "tier", "tier_position", "group_name", "group_rank")


def priority_groups(spark: SparkSession, sf: str) -> DataFrame:
    return display.priority_groups(_shown(spark, sf), PROSE_RULES.display)


def digest_order(spark: SparkSession, sf: str) -> DataFrame:
    return display.digest_order(_shown(spark, sf), PROSE_RULES.display)


def digest_sections(spark: SparkSession, sf: str) -> DataFrame:
    return display.digest_sections(_shown(spark, sf), PROSE_RULES.display)


def review_sections(spark: SparkSession, sf: str) -> DataFrame:
    return display.review_sections(_provided(spark, sf), [F.col("seq")])


def card_fields(spark: SparkSession, sf: str) -> DataFrame:
    return display.card_fields(_provided(spark, sf))


# --- localization and exports ------------------------------------------------


def _mark(text: str) -> str:
    return "译:" + text


def localize_query(spark: SparkSession, sf: str) -> DataFrame:
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    return localize(records, _mark, PROSE_GLOSSARY).select("seq", "title_zh", "summary_zh")


def localize_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The first callable refuses long texts; those records go to the second."""

    def short_only(text: str) -> str:
        if len(text) > 600:
            raise ValueError("too long")
        return _mark(text)

    def second(text: str) -> str:
        return "再译:" + text

    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    done = localize(records, short_only, PROSE_GLOSSARY, secondary=second)
    return done.select("seq", "title_zh", "summary_zh")


def translation_memory(spark: SparkSession, sf: str) -> DataFrame:
    """Stored translations of the documents; the second store covers French."""
    records = classify_records(_normalized(spark, sf), PROSE_RULES)
    lang = F.element_at("tags", 1)

    def store(rows: DataFrame, mark: str) -> DataFrame:
        texts = rows.select(F.explode(F.array("title_en", "abstract")).alias("source_text"))
        return texts.distinct().withColumn("target_text", F.concat(F.lit(mark), "source_text"))

    base = _normalized(spark, sf)
    first = store(base.where(lang == "en"), "译:")
    second = store(base.where(lang == "fr"), "再译:")
    done = localize_from_memory(records, first, PROSE_GLOSSARY, second)
    return done.select("seq", "title_zh", "summary_zh")


def digest_export(spark: SparkSession, sf: str) -> DataFrame:
    records = display.with_publish_date(_shown(spark, sf)).withColumns(
        {"title_zh": F.col("title_en"), "summary_zh": F.lit("")}
    )
    ranked = display.in_digest_order(records, PROSE_RULES.display)
    return sinks.export_rows(ranked, PROSE_RULES.digest_columns, ["digest_rank"])


def review_export(spark: SparkSession, sf: str) -> DataFrame:
    queue = display.with_publish_date(_provided(spark, sf).where(routing.route() == "review"))
    ranked = display.in_digest_order(queue, PROSE_RULES.display)
    return sinks.export_rows(ranked, PROSE_RULES.review_columns, ["digest_rank"])


def _archive_days(spark: SparkSession, sf: str) -> DataFrame:
    """Order days as archive days; names with an urgent priority are no dates."""
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("latest")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day_name")
    ).distinct()


def archive_retention(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.expired_days(_archive_days(spark, sf), F.lit("1995-06-30").cast("date"), 30)


def archive_kept(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.kept_days(_archive_days(spark, sf), F.lit("1995-06-30").cast("date"), 30)


# --- streaming ---------------------------------------------------------------


def _record_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "documents").schema
    # A table is a file, or a folder of files with names of their own; only a pattern may stand for either.
    return spark.readStream.schema(schema).parquet(f"{sf}/documents.{{parquet}}")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def stream_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Drain ``documents`` as a stream through the row-wise stages into routes."""
    folder = _folder(spark)
    stream = runs.annotate_stream(_stream_records(spark, sf), PROSE_RULES, registry(spark, sf))
    narrow = stream.select("seq", "relevance_status", "category", "llm_confidence", "final_decision")
    runs.start_routes(narrow, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(narrow.schema).parquet(f"{folder}/out")


def _stream_records(spark: SparkSession, sf: str) -> DataFrame:
    return records_from(_record_stream(spark, sf))


def _landed(spark: SparkSession, sf: str, folder: str, parts: int = 5) -> DataFrame:
    """Stream of ``documents`` that landed in ``parts`` groups of files, one group per micro-batch.

    A group has as many files as the table can keep cores at work, so a batch is not the
    task of one file; a file is mostly one row group, which one task reads.
    """
    docs = table(spark, sf, "documents", spread_text=False)
    splits = docs.rdd.getNumPartitions()
    files = max(-(-splits // parts), min(splits, spark.sparkContext.defaultParallelism))
    docs.repartitionByRange(parts * files, "doc_id").write.parquet(f"{folder}/in")
    stream = runs.read_landed(spark, f"{folder}/in", docs.schema, "parquet", files_per_batch=files)
    return normalize_records(records_from(stream))


def _deduped(spark: SparkSession, sf: str) -> str:
    folder = _folder(spark)
    runs.start_dedupe(_landed(spark, sf, folder), folder).awaitTermination()
    return folder


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """First record of each primary key among the dated records of a stream."""
    kept = runs.read_deduped(spark, _deduped(spark, sf), "seq long, dedupe_key string")
    return kept.select("seq", "dedupe_key")


def stream_undated(spark: SparkSession, sf: str) -> DataFrame:
    """Records without a date, which the stream sets aside, by source."""
    rows = spark.read.schema("source_id string").parquet(f"{_deduped(spark, sf)}/undated")
    return rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


def stream_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters kept up over the batches of a stream, whose files arrive in any order."""
    folder = _folder(spark)
    resolution.start_resolution(_landed(spark, sf, folder, 3), folder).awaitTermination()
    return resolution.current_clusters(spark, folder)


def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Counted and late events by digest window and type, after five runs.

    Each run gets the events of eight days of the month; one event in ten comes a run
    late.
    """
    folder = _folder(spark)
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    run = F.floor(F.dayofmonth("ts") / 8) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    for number in range(5):
        landed = events.where(run == number)
        landed.write.mode("append").parquet(f"{folder}/in")
        stream = runs.read_landed(spark, f"{folder}/in", landed.schema, "parquet")
        runs.start_window_counts(stream, folder, "ts", ["event_type"], "1 day").awaitTermination()
    counts = runs.read_window_counts(spark, folder, "event_type string")
    return counts.select(iso_utc("window_start").alias("window_start"), iso_utc("window_end").alias("window_end"), "event_type", "n", "n_late")


def queries() -> dict[str, Query]:
    return {
        "scan_records": scan_records,
        "feed_rss": _feed("rss"),
        "feed_rdf": _feed("rdf"),
        "feed_atom": _feed("atom"),
        "html_links": html_links,
        "html_listing": html_listing,
        "select_sources": select_sources,
        "skip_front_matter": skip_front_matter_query,
        "route_counts": route_counts,
        "decisions_csv": decisions_csv,
        "relevance_split": relevance_split,
        "delivery_gate": delivery_gate,
        "fallback_summary": fallback_summary,
        "window_observed": window_observed,
        "digest_export": digest_export,
        "review_export": review_export,
        "archive_retention": archive_retention,
        "archive_kept": archive_kept,
        "acquire_records": acquire_records,
        "acquire_rest": acquire_rest,
        "digest_sections": digest_sections,
        "review_sections": review_sections,
        "card_fields": card_fields,
        "normalize_records": normalize_query,
        "ingest_window": ingest_window,
        "window_filter": window_filter,
        "window_stats": window_stats,
        "lookback_filter": lookback_filter,
        "digest_window": digest_window,
        "relevance_filter": relevance_filter,
        "heuristic_review": heuristic_review,
        "finalize_review": finalize_review,
        "digest_gate": digest_gate,
        "visual_filter": visual_filter,
        "display_bucket": display_bucket,
        "source_enrich": source_enrich,
        "manual_decisions": manual_decisions,
        "keyword_hits": keyword_hits,
        "glossary_candidates": glossary_candidates,
        "dedupe_key": dedupe_key,
        "dedupe_candidates": dedupe_candidates,
        "dedupe_clusters": dedupe_clusters,
        "completeness": completeness_query,
        "dedupe_survivors": dedupe_survivors,
        "dedupe_audit": dedupe_audit,
        "decision_counts": decision_counts,
        "nonkeep_sources": nonkeep_sources,
        "rule_feedback": rule_feedback,
        "category_overrides": category_overrides,
        "other_sources": other_sources,
        "review_sources": review_sources,
        "token_suggestions": token_suggestions,
        "suggestions_report": suggestions_report,
        "review_examples": review_examples,
        "category_scores": category_scores_query,
        "classify": classify_query,
        "journal_groups": journal_groups,
        "limit_per_source": limit_per_source_query,
        "normalized_order": normalized_order,
        "display_order": display_order,
        "priority_groups": priority_groups,
        "digest_order": digest_order,
        "clean_text": clean_text_query,
        "normalize_title": normalize_title_query,
        "canonical_doi": canonical_doi_query,
        "canonical_url": canonical_url_query,
        "parse_datetime": parse_datetime_query,
        "snippet": snippet_query,
        "author_line": author_line_query,
        "glossary_apply": glossary_apply,
        "glossary_trace": glossary_trace,
        "summary_text": summary_text,
        "sentence_cap": sentence_cap,
        "template_summary": template_summary_query,
        "review_payload": review_payload,
        "digest_windows": digest_windows,
        "review_provider": review_provider,
        "review_journal": review_journal,
        "localize": localize_query,
        "localize_fallback": localize_fallback,
        "translation_memory": translation_memory,
        "stream_digest": stream_digest,
        "stream_dedupe": stream_dedupe,
        "stream_undated": stream_undated,
        "stream_clusters": stream_clusters,
        "stream_late": stream_late,
    }
