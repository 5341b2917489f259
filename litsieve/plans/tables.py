"""Article records over the given test tables.

Every column is derived from the columns of the table by a Spark expression, so
the work of a query grows with its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.config import DigestRules, DisplayRules, Glossary, RelevanceRules, ReviewRules
from litsieve.session import spread

PROSE_RULES = DigestRules(
    relevance=RelevanceRules(
        keep_keywords=(
            "the", "that", "License", "thing", "was", "public license", "version 3", "und", "pour", "the",
            "erst", "re-er",
        ),
        ai_keep_keywords=("apache", "mit license", "token", "queue"),
        reject_keywords=("que", "nicht", "mit", "ou", "eau", "con", "por", "elle", "des", "general public"),
        hard_reject_keywords=("worthless", "555", "doll", "free software"),
        title_prefixes=("It by", "Haanth.", "To oned "),
        doi_prefixes=("10.1000/0",),
        strict_source_ids=("src3", "src7"),
        conditional_journals=("Journal src11",),
    ),
    review=ReviewRules(
        editorial_prefixes=("Nt onor", "Tion was"),
        editorial_tags=("src13",),
        hard_reject_hints=("ththth", "queue."),
        strong_hints=("license", "ertion", "lich"),
    ),
    display=DisplayRules(
        top_source_ids=("src1", "src6", "src8"),
        source_order=("src6", "src1", "src2"),
        plant_groups=("plant-core",),
        plant_tokens=("ertion", "lich", "oiment"),
        deferred_categories=("romance",),
        non_deferred_categories=("rare-words",),
        hidden_source_ids=("src0", "src4", "src6", "src12"),
        hidden_keywords=("thing", "que", "nicht", "general public license"),
        never_hidden_category="rare-words",
    ),
    categories={
        "articles": ("the", "tion", "thing", "license", "anea"),
        "romance": ("que", "elle", "des", "la", "ou"),
        "germanic": ("und", "nicht", "der", "die", "mit"),
        "iberic": ("que", "por", "con", "para", "la"),
        "rare-words": ("queue", "token", "license", "public license", "version 3"),
    },
)

PROSE_GLOSSARY = Glossary(
    replacements=(
        ("the", "der"),
        ("tion", "ung"),
        ("derung", "Änderung"),
        ("license", "Lizenz"),
        ("ou", "où"),
        ("and", "基准"),
        ("基准", "基准测试"),
    ),
    seed_terms=("license", "public license"),
)

PROSE_TOKENS = ("license", "ththan", "queue", "onon", "ertion", "lich", "éau", "ción", "spam", "apache")


TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, folder: str, name: str, spread_text: bool = True) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df) if spread_text and name in TEXT_TABLES else df


def _by_lang(**values) -> Column:
    chain = None
    for lang, value in values.items():
        if lang != "other":
            chain = F.when(F.col("lang") == lang, value) if chain is None else chain.when(F.col("lang") == lang, value)
    return chain.otherwise(values["other"])


def source_group() -> Column:
    return (
        F.when(F.col("source").isin("src5", "src9"), "ai-conditional")
        .when(F.col("source").isin("src2", "src8"), "plant-core")
        .otherwise("general")
    )


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    return records_from(table(spark, folder, "documents"))


def records_from(docs: DataFrame) -> DataFrame:
    """Rows of ``documents`` as raw article records.

    Title is the first line and abstract the whole text.  Exact copies share a
    DOI, texts of one source and length share a URL, and one source with equal
    first lines shares a title key, so duplicate clusters form chains.
    """
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 2220)
    digest = F.md5("text")
    chars = F.col("n_chars").cast("string")
    title = F.substring_index("text", "\n", 1)
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.col("source").alias("source_id"),
        F.concat(F.lit("Journal "), "source").alias("journal"),
        F.concat(F.lit("family-"), F.right("source", F.lit(1))).alias("publisher_family"),
        source_group().alias("group"),
        _by_lang(de=F.lit("preprint"), other=F.lit("")).alias("publication_stage"),
        F.concat(F.lit("https://feeds.example.org/"), "source", F.lit(".xml")).alias("source_url"),
        title.alias("title"),
        _by_lang(
            de=F.lit(""),
            other=F.concat(
                F.lit("HTTPS://WWW."), "source", F.lit(".Example.org/Article/"), chars,
                F.lit("?utm_source=feed&id="), chars, F.lit("&q=a%20b#top"),
            ),
        ).alias("link"),
        _by_lang(
            es=F.lit(""),
            fr=F.concat(F.date_format(time, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")),
            de=F.date_format(time, "yyyy-MM-dd HH:mm:ss"),
            other=F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        ).alias("published"),
        F.col("text").alias("abstract"),
        F.lit(" article ").alias("article_type"),
        _by_lang(
            fr=F.lit(""),
            es=F.concat(F.lit("doi: 10.1000/"), F.upper(digest)),
            other=F.concat(F.lit("https://doi.org/10.1000/"), digest),
        ).alias("doi"),
        F.array("lang", "source", F.lit(" "), F.upper("lang")).alias("tags"),
        F.split(title, " ").alias("authors"),
        F.lit("").alias("fetched_at"),
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Sources of ``documents`` as a registry with one address per language."""
    docs = table(spark, folder, "documents", spread_text=False)
    return docs.groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs")).select(
        F.col("source").alias("source_id"),
        (~F.col("source").isin("src10", "src19")).alias("enabled"),
        F.concat(F.lit("Journal "), "source").alias("journal"),
        source_group().alias("group"),
        F.transform(
            "langs", lambda l: F.concat(F.lit("https://feeds.example.org/"), "source", F.lit("/"), l)
        ).alias("source_locator"),
    )


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """``labels`` as edited review rows for the labelled documents."""
    labels = table(spark, folder, "labels")
    raw = raw_records(spark, folder).select("seq", "journal", "doi", F.col("link").alias("article_url"), F.col("title").alias("title_en"))
    return labels.withColumnRenamed("doc_id", "seq").join(raw, "seq").select(
        "seq", "journal", "doi", "article_url", "title_en",
        F.when(F.col("toxic") == 1, " Reject ").when(F.col("quality") == 1, "keep").otherwise("").alias("review_final_decision"),
        F.when((F.col("toxic") == 0) & (F.col("quality") == 1), "romance").otherwise("").alias("review_final_category"),
        F.when(F.col("toxic") == 1, "flagged").otherwise("").alias("reviewer_notes"),
    )


def feed_payloads(spark: SparkSession, folder: str, form: str) -> DataFrame:
    """Feeds of up to a thousand consecutive documents per source, as XML text.

    The range of positions bounds a payload whatever the size of a source.
    """
    def escaped(value: Column) -> Column:
        return F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def tag(name: str, value: str) -> Column:
        return F.concat(F.lit(f"<{name}>"), escaped(F.col(value)), F.lit(f"</{name}>"))

    def tags(name: str, values: str) -> Column:
        wrap = lambda v: F.concat(F.lit(f"<{name}>"), escaped(v), F.lit(f"</{name}>"))
        return F.array_join(F.transform(values, wrap), "")

    # A second date, ahead of the first one in every other item; the first in the document counts.
    def dates(name: str, other: str) -> Column:
        second = F.lit(f"<{other}>2001-02-03T04:05:06Z</{other}>")
        return F.when(F.col("seq") % 2 == 1, F.concat(second, tag(name, "published"))).otherwise(F.concat(tag(name, "published"), second))

    fields, head, foot = {
        "rss": (
            [F.lit("<item>"), tag("title", "title"), tag("link", "link"), dates("pubDate", "dc:date"),
             tag("description", "abstract"), tag("dc:identifier", "doi"), tags("category", "tags"), F.lit("</item>")],
            '<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>t</title>',
            "</channel></rss>",
        ),
        "rdf": (
            [F.lit('<item rdf:about="x">'), tag("title", "title"), tag("link", "link"), tag("dc:date", "published"),
             tag("description", "abstract"), tag("prism:doi", "doi"), tags("dc:subject", "tags"),
             tags("dc:creator", "authors"), F.lit("</item>")],
            '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" '
            'xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:prism="http://prismstandard.org/namespaces/basic/2.0/">',
            "</rdf:RDF>",
        ),
        "atom": (
            [F.lit("<entry>"), tag("title", "title"), F.lit('<link rel="alternate" href="'), escaped(F.col("link")),
             F.lit('"/>'), dates("updated", "published"), tag("summary", "abstract"), tag("id", "doi"),
             F.array_join(F.transform("tags", lambda t: F.concat(F.lit('<category term="'), t, F.lit('"/>'))), ""),
             F.lit("</entry>")],
            '<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>',
            "</feed>",
        ),
    }[form]
    item = F.concat(*fields)
    items = raw_records(spark, folder).select(
        "source_id", "journal", "publisher_family", "group",
        F.lit("journal").alias("publication_stage"),
        F.floor(F.col("seq") / 1000).alias("page"), "seq", item.alias("item"),
    )
    return items.groupBy("source_id", "journal", "publisher_family", "group", "publication_stage", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "item"))), lambda e: e["item"]), "").alias("items")
    ).select(
        "source_id", "journal", "publisher_family", "group", "publication_stage",
        F.concat(F.lit("https://feeds.example.org/"), "source_id", F.lit("/"), F.col("page").cast("string")).alias("url"),
        F.concat(F.lit(head), "items", F.lit(foot)).alias("payload"),
    )
