import html
import random
import re
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from litsieve.functions.dates import iso_utc, parse_datetime
from litsieve.functions.identifiers import canonical_doi, canonical_url, resolve_url
from litsieve.functions.keywords import found_terms, hits_among, present_runs
from litsieve.functions.payloads import json_path
from litsieve.functions.rewriting import apply_glossary, cap_sentences, leading_sentences, trace_glossary
from litsieve.functions.text import author_line, clean_list, clean_text, label_for, normalize_title, snippet
from litsieve.defaults import GLOSSARY_REPLACEMENTS


def apply(spark, values, function, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[1] for r in sorted(rows.select("i", function("v").alias("o")).collect())]


def test_clean_text(spark):
    texts = [
        None, "", "  a \n b\t", "A &lt;i&gt;x&lt;/i&gt; &amp; b", "a  b　", "&amp;lt;b&amp;gt; c",
        "<p>x</p><br>y", "R&D &copy 2024 &#233;&#xe9; &notit;", "\x1cq\x1f", "1 < 2 and 3 > 2",
    ]
    expected = []
    for text in texts:
        decoded = re.sub("<[^>]+>", " ", html.unescape(text or ""))
        expected.append(" ".join(decoded.split()))
    assert apply(spark, texts, clean_text) == expected


def test_clean_list(spark):
    got = apply(spark, [["a &amp; b", " ", "<i>c</i>", "&lt;&gt;"], [], None], clean_list, "array<string>")
    assert got == [["a & b", "c", "<>"], [], []]


def test_normalize_title(spark):
    assert apply(spark, ["H<sub>2</sub>O: A–B", "植物", None], normalize_title) == ["h 2 o a b", "", ""]


def test_doi(spark):
    values = ["https://doi.org/10.1/AbC", "HTTP://dx.doi.org/10.1/x", "doi: 10.2/Y", "DOI:10.3/z ", None, ""]
    assert apply(spark, values, canonical_doi) == ["10.1/abc", "10.1/x", "10.2/y", "10.3/z", "", ""]


def test_url(spark):
    urls = [
        "HTTPS://Example.ORG:8080/Path/A;v=1?utm_source=x&b=2&a=&UTM_x=1&spm=3&&c#frag",
        "http://x.org", "http://x.org?q=a%20b+c~*&p=%C3%A9", "relative/path ", "mailto:a@b.c", "", None,
        "https://u:P@Host/é?x=1=2",
    ]
    tracked = {"fbclid", "gclid", "mc_cid", "mc_eid", "spm"}
    expected = []
    for url in urls:
        raw = (url or "").strip()
        parts = urlsplit(raw)
        if not parts.scheme or not parts.netloc:
            expected.append(raw)
            continue
        head, _, last = parts.path.rpartition("/")
        path = (head + "/" + last.split(";")[0]) if parts.path else "/"
        pairs = [
            (k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True)
            if k not in tracked and not k.startswith("utm_")
        ]
        query = urlencode(pairs)
        expected.append(f"{parts.scheme.lower()}://{parts.netloc.lower()}{path}" + (f"?{query}" if query else ""))
    assert apply(spark, urls, canonical_url) == expected


def test_resolve_url(spark):
    base = "https://x.org/a/b.html?q=1#t"
    links = ["/c", "d", "../e", "//y.org/f", "https://z.org/g", "?h=1", "#i", "/j/../k", "https://z.org/a/./b"]
    rows = spark.createDataFrame([(i, base, h) for i, h in enumerate(links)], "i int, b string, h string")
    got = [r[1] for r in sorted(rows.select("i", resolve_url("b", "h")).collect())]
    assert got == [urljoin(base, h) for h in links]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-03-14T00:10:00Z", "2026-03-14T00:10:00Z"),
        ("2026-03-14", "2026-03-14T00:00:00Z"),
        ("2026-03-14 08:30", "2026-03-14T08:30:00Z"),
        ("2026-03-14T08:30:05.123456+08:00", "2026-03-14T00:30:05Z"),
        ("20260314T083005", "2026-03-14T08:30:05Z"),
        ("Sat, 14 Mar 2026 10:00:00 +0200", "2026-03-14T08:00:00Z"),
        ("14 Mar 26 10:00 EST", "2026-03-14T15:00:00Z"),
        ("Sat, 14 Mar 2026 10:00:00 GMT", "2026-03-14T10:00:00Z"),
        ("14 March 1999 10:00:00", "1999-03-14T10:00:00Z"),
        ("2026-13-45", ""), ("tomorrow", ""), ("", ""), (None, ""),
    ],
)
def test_dates(spark, text, expected):
    assert apply(spark, [text], lambda c: iso_utc(parse_datetime(c))) == [expected]


def brute_hits(text, keywords):
    hits = []
    for keyword in keywords:
        key = keyword.lower()
        pattern = r"\s+".join(re.escape(p) for p in key.split(" "))
        if re.fullmatch("[a-z][a-z0-9-]{2,}", key) and not key.endswith("s"):
            pattern += "s?"
        left = "(?<![a-z0-9])" if key[0].isalnum() else ""
        right = "(?![a-z0-9])" if key[-1].isalnum() else ""
        if re.search(left + pattern + right, text.lower()):
            hits.append(keyword)
    return hits


def test_keywords_match_brute_force(spark):
    keywords = ["cell", "single-cell", "T cell", "sensors", "cd8", "line-1", "c++", "+x", "é", "cell", "AI", "stem cell"]
    pieces = ["cell", "cells", "single-cell", "singlecell", "t", "T  cell", "sensor", "sensors", "cd8", "cd8s", "line-1s",
              "c++x", "a+x", "é", "aé", "ai", "stem", "stem\ncells", "-", ".", "subcell", "line 1"]
    rng = random.Random(7)
    texts = [rng.choice(["", " ", "."]).join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(300)]

    def hits(column):
        lowered = F.lower(column)
        present = present_runs(lowered, keywords)
        return hits_among(found_terms(lowered, present, keywords), keywords)

    assert apply(spark, texts, hits) == [brute_hits(t, keywords) for t in texts]


def test_display_texts(spark):
    assert apply(spark, ["a  b", "x" * 30, "ab cd ef"], lambda c: snippet(c, 7)) == ["a b", "xxxxxx…", "ab cd…"]
    authors = [["A", "B"], list("ABCDEFG"), [" ", ""], None]
    assert apply(spark, authors, author_line, "array<string>") == [
        "Authors: A, B", "Authors: A, B, E, F, G", "", "",
    ]
    assert apply(spark, ["x", "my-stage"], lambda c: label_for(c, {"x": "Ex"})) == ["Ex", "My-Stage"]


def test_glossary(spark):
    texts = ["单单元格 基准 工作流", "single-cell annotation 基准", "price", " gut microbiota "]
    expected = ["单细胞 基准测试 工作流程", "单细胞 annotation 基准测试", "p水稻", "gut 微生物群"]
    assert apply(spark, texts, lambda c: apply_glossary(c, GLOSSARY_REPLACEMENTS)) == expected
    traced = apply(spark, texts, lambda c: trace_glossary(c, GLOSSARY_REPLACEMENTS))
    assert [t["text"] for t in traced] == expected
    assert [(c["source"], c["target"]) for c in traced[2]["changes"]] == [("rice", "水稻")]


def test_sentences(spark):
    assert apply(spark, ["一！二?三。四", "  ", None], leading_sentences) == ["一。二。", "", ""]
    assert apply(spark, ["一。二。三", "一！二?三", "a!b!c!d"], lambda c: cap_sentences(c, 2)) == [
        "一。二。", "一。二。", "a!b!c!d",
    ]


def test_json_path(spark):
    payload = ['{"a":[{"b":"x"}],"c":{"0":"y"}}', "not json", None]
    assert apply(spark, payload, lambda c: json_path(c, "a.0.b")) == ["x", None, None]
    assert apply(spark, payload, lambda c: json_path(c, "c.0")) == ["y", None, None]


def test_phrases_in_one_pass(spark):
    import random

    from litsieve.functions.keywords import found_terms, keyword_pattern, present_runs

    draw = random.Random(9)
    parts = ["ab", "abc", "rna", "seq", "x1", "é", "-", " ", "  ", "\n", "s", "+", "ers"]
    phrases = ["ab abc", "ab abc rna", "rna-seq", "rna-", "+ab", "c++", "seq x1", "seq x1é", "é-é", "abc-abs", "ab-rnas", "ab-rna x1", "abc rna"]
    phrases += list({"".join(draw.choice(parts) for _ in range(draw.randint(2, 5))).strip() for _ in range(60)})
    phrases = [p for p in dict.fromkeys(" ".join(p.split()) for p in phrases) if p and not p.isalnum()]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(300)] + [f"a {p}s. {p}" for p in phrases]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = ("ab", "seq")
    found = df.select("t", found_terms("t", present_runs("t", [*words, *phrases]), [*words, *phrases]).alias("found"))
    single = F.array_compact(F.array(*(F.when(F.col("t").rlike(keyword_pattern(p)), F.lit(p)) for p in phrases)))
    for r in found.select("found", single.alias("want")).collect():
        assert sorted({f for f in r.found if f in phrases}) == sorted(r.want)


def test_rounds_like_the_reference(spark):
    import random

    from litsieve.functions.numbers import round_decimals

    draw = random.Random(7)
    values = [i / 10000 for i in range(-20, 10001)] + [0.0625, 0.1875, 2.5e-4, -0.5005, 1e13, 1e300, float("inf"), 0.0005]
    values += [draw.random() for _ in range(2000)] + [draw.uniform(-1e6, 1e6) for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_decimals("v", 3).alias("r")).collect()
    assert [r.v for r in rows if r.r != round(r.v, 3)] == []


def test_sql_rounds_like_the_reference():
    import duckdb

    found = duckdb.sql("SELECT i / 10000 AS v, printf('%.3f', i / 10000)::DOUBLE AS r FROM range(10001) AS t(i)").fetchall()
    assert [v for v, r in found if r != round(v, 3)] == []


def test_batches_to_python_stay_small(spark):
    from litsieve.operators.providers import call_records
    from litsieve.session import BATCH_BYTES, BATCH_ROWS

    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "10000")
        spark.conf.set(names[1], "64m")
        call_records(spark.range(1).withColumnRenamed("id", "seq"), "n", ["seq"], "v long", lambda r: {"v": 1})
        assert [spark.conf.get(n) for n in names] == [str(BATCH_ROWS), str(BATCH_BYTES)]
        # Lower limits stay.
        spark.conf.set(names[0], "10")
        call_records(spark.range(1).withColumnRenamed("id", "seq"), "n", ["seq"], "v long", lambda r: {"v": 1})
        assert spark.conf.get(names[0]) == "10"
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)


def test_parts_of_the_searched_text_are_cleaned_once(spark):
    from litsieve.functions.text import TAG
    from litsieve.operators.normalize import normalize_records
    from litsieve.operators.relevance import match_keywords

    raw = spark.createDataFrame([(1, "J", "A &amp;amp; b", "<p>The  thing</p>\n")], "seq long, journal string, title string, abstract string")
    cleaned = normalize_records(raw).select("seq", "journal", "title_en", "abstract", "tags")
    found = match_keywords(cleaned, ("the", "thing", "amp"))
    assert [(r.title_en, r.abstract, r.found) for r in found.collect()] == [("A &amp; b", "The thing", ["the", "thing"])]
    # Journal, title, abstract, each tag, and their joined text: one cleaning each.
    assert found._jdf.queryExecution().optimizedPlan().toString().count(TAG) == 5


def test_white_space_of_any_kind(spark):
    from litsieve.functions.text import SPACE_CHARACTERS, squeeze, strip_long

    draw = random.Random(17)
    marks = [" "] * 20 + list(SPACE_CHARACTERS) + list("ab译é!") * 6
    texts = ["", " ", "a", " a", "a b", "a  b", "a　b"] + ["".join(draw.choices(marks, k=draw.randrange(12))) for _ in range(400)]
    assert apply(spark, texts, squeeze) == [" ".join(t.split()) for t in texts]
    assert apply(spark, texts, strip_long) == [t.strip() for t in texts]


def test_sentences_and_glossary_like_plain_python(spark):
    draw = random.Random(18)
    texts = ["".join(draw.choices("ab 。！!?　", k=draw.randrange(14))) for _ in range(400)]

    def parts(text, stops):
        return [s for s in map(str.strip, re.split(f"[{stops}]", text)) if s]

    assert apply(spark, texts, leading_sentences) == ["".join(s + "。" for s in parts(t, "。！!?")[:2]) for t in texts]
    for limit in (1, 2, 4):
        expected = ["".join(s + "。" for s in p[:limit]) if len(p) > limit else t for t in texts for p in [parts(t, "。！?")]]
        assert apply(spark, texts, lambda c: cap_sentences(c, limit)) == expected

    pairs = (("a", "bb"), ("", "x"), ("bbb", "a "), ("zz", "y"), (" b", "zz"), ("zz", "a"))

    def replaced(text):
        text = text.strip()
        for source, target in pairs:
            text = text.replace(source, target) if source else text
        return " ".join(text.split())

    assert apply(spark, texts, lambda c: apply_glossary(c, pairs)) == [replaced(t) for t in texts]
    assert apply(spark, texts, lambda c: apply_glossary(c, ())) == [" ".join(t.split()) for t in texts]
