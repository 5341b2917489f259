import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from litsieve.config import DigestRules, Glossary, ReviewRules
from litsieve.operators import display, review as reviews, sinks, windows
from litsieve.operators.classify import classify_records
from litsieve.operators.localization import localize
from litsieve.operators.providers import CallPolicy
from litsieve.operators.relevance import filter_relevance
from litsieve.operators.terms import glossary_candidates
from litsieve.plans.digest import digest_table, review_table, run_digest, write_digest

RAW = (
    "seq bigint, source_id string, journal string, publisher_family string, `group` string, publication_stage string, "
    "title string, link string, published string, abstract string, article_type string, doi string, tags array<string>"
)
SAMPLE = [
    (1, "nature-methods", "Nature Methods", "f", "nature-family", None, "Cell lineages of a barley root tip seen one by one",
     "https://papers.test/barley", "2026-03-14T00:10:00Z",
     "Single-cell sequencing of plant root tips follows which genes switch on as a barley root grows.",
     "article", "10.5555/barley", ["single-cell", "plant"]),
    (2, "patterns", "Patterns", "f", "ai-conditional", None, "Large language models read enzyme sequences",
     "https://papers.test/enzymes", "2026-03-14T01:00:00Z",
     "A foundation model trained on protein sequences ranks variants of an enzyme.",
     "article", "10.5555/enzymes", ["foundation model", "protein"]),
    (3, "science-advances", "Science Advances", "f", "science-family", None,
     "A longer life for lithium packs", "https://papers.test/lithium", "2026-03-14T02:00:00Z",
     "A perovskite catalyst keeps the battery at full charge for a thousand rounds.", "article", "10.5555/lithium", ["battery"]),
    (4, "preprints-genomics", "Preprints (Genomics)", "f", "preprint-core", "preprint",
     "Which pipeline joins gene expression atlases best", "https://papers.test/pipelines", "2026-03-14T03:00:00Z",
     "A benchmark of bioinformatics software on shared resource datasets.", "preprint",
     "10.5555/pipelines", ["benchmark", "bioinformatics"]),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(SAMPLE, RAW)


def ts(text):
    return F.lit(text).cast("timestamp")


def test_sample_day(spark, raw, tmp_path):
    rules = DigestRules()
    run = run_digest(
        raw, rules, start=ts("2026-03-13 00:00:00"), end=ts("2026-03-15 00:00:00"), work_folder=str(tmp_path / "work")
    )
    assert {(r.seq, r.relevance_status) for r in run.filtered.collect()} == {(1, "keep"), (2, "keep"), (3, "reject"), (4, "keep")}
    rows = digest_table(run, rules).orderBy("digest_rank").collect()
    assert [(r.digest_rank, r.journal, r.category) for r in rows] == [
        (1, "Nature Methods", "plant-biology"),
        (2, "Patterns", "ai-computational-biology"),
        (3, "Preprints (Genomics)", "methods-datasets-resources"),
    ]
    assert rows[0].publish_date == "2026-03-14T00:10:00Z" and rows[0].tags == "single-cell, plant"
    assert rows[0].summary_zh == (
        "该文来源为《Nature Methods》正式发表条目，归类为“植物生物学”。当前未配置自动中文翻译模型，建议根据摘要进一步润色。"
        "摘要显示研究重点与“Cell lineages of a barley root tip seen one by one”相关。"
    )
    assert review_table(run, rules).count() == 0
    assert write_digest(run, rules, str(tmp_path / "out"), F.lit("2026-03-15").cast("date"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "digest").glob("*.csv")))
    assert text.count("\n") >= 4 and "barley root" in text
    assert spark.read.parquet(str(tmp_path / "out" / "archive")).where("digest_date = '2026-03-15'").count() == 3


NORMAL = (
    "seq bigint, source_id string, journal string, `group` string, title_en string, abstract string, doi string, tags array<string>"
)


@pytest.mark.parametrize(
    "source, journal, title, abstract, doi, status, reason",
    [
        ("nature", "Nature", "News about cells", "", "10.1038/d41586-1", "reject", "matched editorial DOI prefix"),
        ("cell", "Cell", "A report", "no words", "", "keep", "matched keep keywords: cell"),
        ("x", "X", "Solar cells with plants", "", "", "reject", "matched hard reject keywords: solar cells"),
        ("x", "X", "Podcast: cells", "", "", "reject", "matched editorial title prefix"),
        ("x", "X", "Biofilms in pipes", "", "", "keep", "matched keep keywords: biofilm, biofilms"),
        ("science", "Science", "Stars", "", "", "reject", "strict bio source without biology-specific keyword match"),
        ("p", "Patterns", "Stars", "", "", "reject", "conditional journal without biology-specific signal"),
        ("x", "X", "Quantum battery", "", "", "reject", "matched reject keywords: battery, quantum"),
        ("x", "X", "Quantum battery alloy root", "", "", "reject", "reject signals outweigh keep signals: battery, quantum, alloy"),
        ("x", "X", "Transformer battery", "", "", "keep", "matched AI keep keywords: transformer"),
        ("x", "X", "Stars", "", "", "keep", "kept by default source scope"),
    ],
)
def test_cascade(spark, source, journal, title, abstract, doi, status, reason):
    rows = spark.createDataFrame([(1, source, journal, "g", title, abstract, doi, [])], NORMAL)
    got = filter_relevance(rows, DigestRules()).first()
    assert (got.relevance_status, got.relevance_reason) == (status, reason)


def test_classes_ties_and_repeats(spark):
    rows = spark.createDataFrame(
        [(1, "s", "J", "g", "enhancer", "", "", []), (2, "s", "J", "g", "genome protein", "", "", []), (3, "s", "J", "g", "zzz", "", "", [])],
        NORMAL,
    )
    got = {r.seq: r for r in classify_records(rows, DigestRules()).collect()}
    assert got[1].category == "gene-function-regulation" and got[1].category_hits == ["enhancer", "enhancer"]
    assert got[2].category == "protein-structure-function"
    assert (got[3].category, got[3].category_reason) == ("other", "no category keyword matched")


def reviewed(spark, rows):
    columns = (
        "seq bigint, source_id string, journal string, `group` string, publication_stage string, title_en string, abstract string, "
        "doi string, article_url string, canonical_url string, tags array<string>, category string, published_at string"
    )
    return spark.createDataFrame(rows, columns)


def base(seq, title="t", category="plant-biology", stage="journal", abstract="", doi="", tags=(), source="s", published="2026-01-01T00:00:00Z"):
    return (seq, source, "J", "g", stage, title, abstract, doi, "", "", list(tags), category, published)


def test_built_in_reviewer(spark):
    rows = [
        base(1, "Erratum: x"), base(2, tags=[" Profile "]), base(3, "repeated"), base(4, "auxin", "other"),
        base(5, "x", "other"), base(6, "x", stage="preprint"), base(7, "x"),
    ]
    got = reviews.review(reviewed(spark, rows), DigestRules()).orderBy("seq").collect()
    assert [(r.final_decision, r.llm_confidence) for r in got] == [
        ("reject", 0.95), ("reject", 0.9), ("reject", 0.88), ("keep", 0.83), ("review", 0.62), ("keep", 0.82), ("keep", 0.92),
    ]


def test_provider_thresholds_and_override(spark):
    replies = {1: ("maybe", 0.85), 2: ("maybe", 0.6), 3: ("maybe", 0.1), 4: ("Keep", 0.12345)}

    def call(record):
        decision, confidence = replies[record["seq"]]
        return {"decision": decision, "confidence": confidence, "category_override": "omics" if record["seq"] == 4 else None}

    got = reviews.review(reviewed(spark, [base(i) for i in replies]), DigestRules(), call, ["title_en"]).orderBy("seq").collect()
    assert [r.final_decision for r in got] == ["keep", "review", "reject", "keep"]
    assert (got[3].category, got[3].category_original, got[3].llm_confidence) == ("omics", "plant-biology", 0.123)


def test_payload_from_json(spark):
    rows = spark.createDataFrame([('{"r":{"decision":"keep","confidence":"0.7"}}',), ("oops",)], "response string")
    got = [r.p for r in rows.select(reviews.payload_from_json("response", "r").alias("p")).collect()]
    assert (got[0].decision, got[0].confidence) == ("keep", 0.7) and got[1].decision is None


def test_last_decision_wins(spark):
    records = reviews.finalize_review(
        reviews.heuristic_review(reviewed(spark, [base(1, "x", "other", doi="10.1/a"), base(2, "Y z", "other")]), ReviewRules()), ReviewRules()
    )
    decisions = spark.createDataFrame(
        [(1, "J", "doi:10.1/A", None, "x", "reject", "", "first"), (2, "J", "10.1/a", None, "x", "keep", "omics", "last"),
         (3, "j", None, None, "y  Z!", "nonsense", "", "note")],
        "seq bigint, journal string, doi string, article_url string, title_en string, review_final_decision string, "
        "review_final_category string, reviewer_notes string",
    )
    got = {r.seq: r for r in reviews.apply_decisions(records, decisions).collect()}
    assert (got[1].final_decision, got[1].category, got[1].category_original, got[1].reviewer_notes) == ("keep", "omics", "other", "last")
    assert (got[2].final_decision, got[2].manual_review_applied, got[2].reviewer_notes) == ("review", True, "note")


def test_review_rows_sort_after_kept(spark):
    rows = reviewed(spark, [base(1, "older kept", published="2025-01-01T00:00:00Z"), base(2, "newer", "other")])
    done = reviews.review(rows, DigestRules())
    for options in ({}, {"ranges": 2}):
        ranks = display.digest_order(done, DigestRules().display, **options)
        assert {r.seq: r.digest_rank for r in ranks.collect()} == {1: 1, 2: 2}


def test_visual_filter(spark):
    rows = reviewed(spark, [
        base(1, "human brain", "other", source="nature"), base(2, "human root", "other", source="nature"),
        base(3, "human", "ai-computational-biology", source="nature"), base(4, "human", "other"), base(5, "stars", "other", source="nature"),
    ])
    got = display.visually_hidden(rows, DigestRules().display).orderBy("seq").collect()
    assert [r.hidden for r in got] == [True, False, False, False, False]


def test_fallback_and_retry(spark):
    rows = reviewed(spark, [base(1, "fine", abstract="ok"), base(2, "fine", abstract="fail here")])

    def first(text):
        if "fail" in text:
            raise ValueError("no")
        return "1:" + text

    got = localize(rows, first, Glossary(), lambda t: "2:" + t, CallPolicy(max_attempts=2)).orderBy("seq").collect()
    assert [r.title_zh for r in got] == ["1:fine", "2:fine"]
    with pytest.raises(Exception):
        localize(rows, first, Glossary()).collect()


def test_scheduled_window(spark):
    runs = [(dt.datetime(2026, 3, 14, 23, 59),), (dt.datetime(2026, 3, 15, 0, 0),), (dt.datetime(2026, 3, 15, 0, 30),)]
    start, end = windows.scheduled_window("now", "Asia/Shanghai", "08:00")
    got = spark.createDataFrame(runs, "now timestamp").select(
        F.date_format(start, "MM-dd HH:mm").alias("s"), F.date_format(end, "MM-dd HH:mm").alias("e")
    ).collect()
    assert [(r.s, r.e) for r in got] == [("03-12 16:00", "03-14 00:00"), ("03-13 16:00", "03-15 00:00"), ("03-13 16:00", "03-15 00:00")]
    with pytest.raises(ValueError):
        windows.scheduled_window("now", "UTC", "25:00")


def test_window_ends_count(spark):
    rows = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-03"), (4, None)], "seq int, t string")
    time = F.col("t").cast("timestamp")
    kept = windows.window_filter(rows, time, ts("2026-01-01"), ts("2026-01-02"))
    assert {r.seq for r in kept.collect()} == {1, 2}
    assert {r.seq for r in windows.ingest_filter(rows, time, ts("2026-01-02"), None).collect()} == {2, 3, 4}


def test_retention(spark):
    days = spark.createDataFrame([("2026-02-12",), ("2026-02-13",), ("2026-02-14",), ("latest",), ("2026-99-01",)], "day_name string")
    got = sinks.expired_days(days, F.lit("2026-03-15").cast("date"), 30)
    assert {r.day_name for r in got.collect()} == {"2026-02-12", "2026-02-13"}


def test_archive_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = lambda v, d: spark.createDataFrame([(v, d)], "v int, digest_date string")
    sinks.write_archive(rows(1, "2026-01-01"), path)
    sinks.write_archive(rows(2, "2026-01-02"), path)
    sinks.write_archive(rows(3, "2026-01-02"), path)
    assert {(r.v, str(r.digest_date)) for r in spark.read.parquet(path).collect()} == {(1, "2026-01-01"), (3, "2026-01-02")}


def test_term_mining(spark):
    rows = reviewed(spark, [
        base(1, "Éabc wort", abstract="root hair zone. root hair zone; with 12 ab3 cd ef", tags=["x"]),
        base(2, "second", abstract="root hair zone. auxin"),
    ])
    got = {r.term: r for r in glossary_candidates(rows, ["auxin"], examples=2).collect()}
    assert got["root hair zone"].n == 1 and got["second root hair zone"].n == 1 and "auxin" not in got and "with" not in got
    assert got["wort root hair zone"].examples == ["Éabc wort"]


def test_terms_named_by_sketch_or_counted_in_full(spark):
    import random

    draw = random.Random(6)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(i, f"title {i}", " , ".join(draw.choices(words, range(1, 201), k=30)), ["tag"]) for i in range(80)]
    records = spark.createDataFrame(rows, "seq long, title_en string, abstract string, tags array<string>").repartition(3)

    def found(**sizes):
        out = glossary_candidates(records, ["worda a", words[-1]], limit=15, examples=2, **sizes)
        return sorted((r.term, r.n, r.first_seq, tuple(r.examples)) for r in out.collect())

    # Enough counters, too few to tell the last winner, and too few named terms.
    whole = found()
    assert len(whole) == 15 and words[-1] not in {t for t, *_ in whole}
    assert found(tracked=60, named=20) == found(named=10) == whole
    counts, seen = {}, {}
    for i, title, text, _ in rows:
        for term in re.findall(r"\b[a-z][a-z0-9-]{2,}(?: [a-z0-9-]{2,}){0,3}\b", f"{title} {text} tag"):
            if not (re.search("[0-9]", term) and term.count(" ") > 1):
                counts[term] = counts.get(term, 0) + 1
                seen.setdefault(term, []).append(i)
    best = sorted((t for t in counts if t != words[-1]), key=lambda t: (-counts[t], seen[t][0]))[:15]
    assert [(t, n) for t, n, *_ in whole] == sorted((t, counts[t]) for t in best)
    assert all((first, titles) == (seen[t][0], tuple(f"title {i}" for i in seen[t][:2])) for t, _, first, titles in whole)


def test_window_scan_prunes_and_counts_in_one_pass(spark, raw, tmp_path):
    from litsieve.operators.normalize import publish_time

    more = raw.unionByName(raw.withColumns({"seq": F.col("seq") + 10, "published": F.lit("2026-03-16T05:00:00Z")}))
    more = more.unionByName(raw.where("seq = 1").withColumns({"seq": F.lit(20).cast("long"), "published": F.lit("")}))
    path = str(tmp_path / "ingested")
    sinks.write_ingested(more, path, publish_time(more))
    start, end = ts("2026-03-14 00:30:00"), ts("2026-03-15 00:00:00")
    kept = windows.scan_window(spark, path, start, end)
    assert {r.seq for r in kept.collect()} == {2, 3, 4}
    assert {r.seq for r in windows.scan_window(spark, path, start, end, undated=True).collect()} == {2, 3, 4, 20}
    plan = kept.select("seq")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(published_ts" in plan and "published_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "Python" not in plan
    run = run_digest(more, DigestRules(), start=start, end=end, work_folder=str(tmp_path / "work"), count_window=True)
    assert run.window_counts.get == windows.window_stats(more, publish_time(more), start, end).first().asDict()
    assert [r.seq for r in run.normalized_order().orderBy("rank").collect()] == [4, 3, 2]


def test_registries_of_any_size(spark, monkeypatch):
    from litsieve.sources import registry

    records = spark.createDataFrame([(i, f"s{i % 3}" if i else None) for i in range(60)], "seq long, source_id string")
    sources = spark.createDataFrame([(f"s{i}", f"g{i}") for i in range(1, 40)], "source_id string, `group` string")
    want = {(i, None if not i or i % 3 == 0 else f"g{i % 3}") for i in range(60)}
    for rows, joins in ((10_000, "Broadcast"), (5, "Broadcast"), (1, "__salt")):
        monkeypatch.setattr(registry, "SMALL_ROWS", rows)
        got = registry.enrich(records, sources, ["group"])
        assert {(r.seq, r.group) for r in got.collect()} == want
        assert joins in got._jdf.queryExecution().toString()


def test_report_computes_its_inputs_once(spark):
    from litsieve.operators.reports import suggestions_report

    calls = spark.sparkContext.accumulator(0)

    def counted(seq):
        calls.add(1)
        return "other"

    rows = spark.range(4).select(
        F.col("id").alias("seq"), F.concat(F.lit("s"), F.col("id") % 2).alias("source_id"), F.lit("license").alias("title_en"),
        F.lit("").alias("abstract"), F.udf(counted)("id").alias("category"), F.lit("review").alias("final_decision"),
    )
    report = suggestions_report(rows, rows.withColumns({"source_id": F.lit("r"), "category": F.lit("x")}), ["license"]).first()["report"]
    assert report == (
        '{"other_sources":[{"name":"s0","n":2},{"name":"s1","n":2}],"review_sources":[{"name":"r","n":4}],'
        '"tokens":[{"name":"license","n":8}]}'
    )
    assert calls.value == 4
