"""Localized title and summary: templates, translation callables, fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from litsieve import defaults as d
from litsieve.config import Glossary
from litsieve.functions.rewriting import apply_glossary, cap_sentences, fill_template, leading_sentences
from litsieve.functions.text import label_for, text_or_empty
from litsieve.operators.providers import CallPolicy, call_records, call_with_policy
from litsieve.schemas import LOCALIZED_RESULT


def _category_zh(labels: Mapping[str, str]) -> Column:
    return label_for(F.coalesce(F.col("category"), F.lit("other")), dict(labels), labels.get("other", "其他"))


def _stage_zh() -> Column:
    return label_for(
        F.coalesce(F.col("publication_stage"), F.lit("journal")), d.STAGE_LABELS_ZH, d.STAGE_LABELS_ZH["journal"]
    )


def _fill(template: str, labels: Mapping[str, str]) -> Column:
    return fill_template(
        template,
        journal="journal",
        title="title_en",
        category_zh=_category_zh(labels),
        publication_stage_zh=_stage_zh(),
    )


def template_summary(
    labels: Mapping[str, str] = d.CATEGORY_LABELS_ZH,
    with_abstract: str = d.SUMMARY_WITH_ABSTRACT,
    without_abstract: str = d.SUMMARY_WITHOUT_ABSTRACT,
) -> Column:
    """Summary without a translator; one form with and one without abstract."""
    return F.when(text_or_empty("abstract") != "", _fill(with_abstract, labels)).otherwise(
        _fill(without_abstract, labels)
    )


def translated_summary(
    translated: Column | str,
    labels: Mapping[str, str] = d.CATEGORY_LABELS_ZH,
    prefix: str = d.SUMMARY_PREFIX,
    fallback: str = d.FALLBACK_SUMMARY,
) -> Column:
    """Prefix and the first two sentences of a translated abstract."""
    return F.when(
        text_or_empty("abstract") != "", F.concat(_fill(prefix, labels), leading_sentences(translated))
    ).otherwise(_fill(fallback, labels))


def localize_by_template(records: DataFrame, max_sentences: int = 4) -> DataFrame:
    return records.withColumns(
        {
            "title_zh": text_or_empty("title_en"),
            "summary_zh": cap_sentences(template_summary(), max_sentences),
        }
    )


def with_summaries(
    translated: DataFrame,
    glossary: Glossary,
    max_sentences: int = 4,
    labels: Mapping[str, str] = d.CATEGORY_LABELS_ZH,
) -> DataFrame:
    """Glossary, summary and sentence cap over ``title_text`` and ``abstract_text``."""
    pairs = glossary.replacements
    return translated.withColumns(
        {
            "title_zh": apply_glossary("title_text", pairs),
            "summary_zh": cap_sentences(
                translated_summary(apply_glossary("abstract_text", pairs), labels), max_sentences
            ),
        }
    ).drop("title_text", "abstract_text")


def localize(
    records: DataFrame,
    translate: Callable[[str], str],
    glossary: Glossary,
    secondary: Callable[[str], str] | None = None,
    policy: CallPolicy = CallPolicy(),
    max_sentences: int = 4,
) -> DataFrame:
    """Translate title and abstract with a user callable.

    When the first callable fails for a record, title and abstract are both
    redone by ``secondary``; without one the failure ends the job.
    """
    last: list[float] = []

    def both(call: Callable[[str], str], record: dict) -> dict:
        title, abstract = record["title_en"] or "", record["abstract"] or ""
        return {
            "title_text": call_with_policy(call, title, policy, last),
            "abstract_text": call_with_policy(call, abstract, policy, last) if abstract else "",
        }

    def translate_record(record: dict) -> dict:
        try:
            return both(translate, record)
        except Exception:
            if secondary is None:
                raise
            return both(secondary, record)

    done = call_records(
        records,
        "translated",
        ["title_en", "abstract"],
        "title_text string, abstract_text string",
        translate_record,
        CallPolicy(concurrency=policy.concurrency),
    )
    texts = done.withColumns(
        {"title_text": F.col("translated.title_text"), "abstract_text": F.col("translated.abstract_text")}
    )
    return with_summaries(texts.drop("translated"), glossary, max_sentences)


def localize_with(
    records: DataFrame,
    call: Callable[[dict], dict],
    columns: list[str],
    policy: CallPolicy = CallPolicy(),
    max_sentences: int = 4,
) -> DataFrame:
    """Title and summary straight from a callable ``record -> {title_zh, summary_zh}``."""
    done = call_records(records, "reply", columns, LOCALIZED_RESULT, call, policy)
    return done.withColumns(
        {"title_zh": F.col("reply.title_zh"), "summary_zh": cap_sentences("reply.summary_zh", max_sentences)}
    ).drop("reply")


def localize_from_memory(
    records: DataFrame,
    memory: DataFrame,
    glossary: Glossary,
    fallback: DataFrame | None = None,
    max_sentences: int = 4,
) -> DataFrame:
    """Translate by join to stored translations ``(source_text, target_text)``.

    A record counts as translated when its title and, if it has one, its
    abstract are stored.  Otherwise both come from ``fallback``, and a record
    that neither table covers falls back to the template.

    Texts meet by a 128-bit digest, so whole texts are neither sort nor shuffle
    keys; only digests and translations move.
    """
    filled = F.filter(F.array("title_en", "abstract"), lambda t: t.isNotNull() & (t != ""))
    wanted = records.select("seq", F.explode(F.array_distinct(F.transform(filled, F.md5))).alias("digest"))

    def lookup(table: DataFrame, suffix: str) -> DataFrame:
        unique = table.groupBy(F.md5("source_text").alias("digest")).agg(F.min("target_text").alias("target_text"))
        found = wanted.join(unique, "digest")
        return found.groupBy("seq").agg(
            F.map_from_entries(F.collect_list(F.struct("digest", "target_text"))).alias(f"texts_{suffix}")
        )

    joined = records.join(lookup(memory, "a"), "seq", "left")
    tables = ["a"]
    if fallback is not None:
        joined = joined.join(lookup(fallback, "b"), "seq", "left")
        tables.append("b")

    def pair(suffix: str) -> Column:
        texts = F.col(f"texts_{suffix}")
        title = F.try_element_at(texts, F.md5("title_en"))
        abstract = F.when(text_or_empty("abstract") == "", F.lit("")).otherwise(
            F.try_element_at(texts, F.md5("abstract"))
        )
        return F.when(
            title.isNotNull() & abstract.isNotNull(),
            F.struct(title.alias("title_text"), abstract.alias("abstract_text")),
        )

    chosen = joined.withColumn("chosen", F.coalesce(*(pair(t) for t in tables)))
    texts = chosen.withColumns(
        {
            "title_text": F.coalesce("chosen.title_text", text_or_empty("title_en")),
            "abstract_text": text_or_empty("chosen.abstract_text"),
        }
    )
    done = with_summaries(texts, glossary, max_sentences)
    return done.withColumn(
        "summary_zh",
        F.when(F.col("chosen").isNotNull(), F.col("summary_zh")).otherwise(
            cap_sentences(template_summary(), max_sentences)
        ),
    ).drop("chosen", *(f"texts_{t}" for t in tables))
