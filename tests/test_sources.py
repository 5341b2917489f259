import json

from pyspark.sql import functions as F

from litsieve.config import DigestRules, sources_from_watchlist
from litsieve.sources.dispatch import acquire, read_payloads, with_locators
from litsieve.sources.feeds import read_feeds
from litsieve.sources.listings import page_links
from litsieve.sources.records import filled_decisions, read_decisions, scan_records
from litsieve.sources.registry import select_sources, source_locators

SCHEMA = (
    "source_id string, journal string, publisher_family string, `group` string, publication_stage string, "
    "source_strategy string, url string, payload string"
)
RSS = (
    '<rss><channel><title>t</title><item><title>A &lt;i&gt;x&lt;/i&gt;</title><link>http://a</link>'
    "<category>k1</category><category>k2</category><pubDate>Sat, 14 Mar 2026 10:00:00 GMT</pubDate></item>"
    "<item><title>Advisory Board and Contents</title></item></channel></rss>"
)
RDF = (
    '<rdf:RDF xmlns:rdf="r" xmlns:dc="d" xmlns:prism="p"><item><title>B</title><link>http://b</link>'
    "<dc:creator>X</dc:creator><dc:creator>Y</dc:creator><prism:doi>10.1/b</prism:doi><dc:subject>s</dc:subject></item></rdf:RDF>"
)
ATOM = (
    '<feed xmlns="a"><entry><title>C</title><link href="http://c"/><category term="t"/>'
    "<id>https://doi.org/10.1000/abc</id><updated>2026-03-14T00:00:00Z</updated></entry></feed>"
)
LISTING = (
    '<html>&nbsp;<a href="/x/advance-article/1">A long enough <b>article</b> title</a>'
    '<a href="/x/advance-article/1">Another text of the same article</a><a href="/x/advance-article/2">short</a></html>'
)


def payloads(spark, *rows):
    return spark.createDataFrame(
        [(s, f"Journal {s}", "p", "g", "journal", "official_feed_or_toc", url, text) for s, url, text in rows], SCHEMA
    )


def test_feed_forms(spark):
    table = payloads(spark, ("r", "u1", RSS), ("d", "u2", RDF), ("a", "u3", ATOM))
    rss = read_feeds(table.where("source_id = 'r'")).orderBy("item_pos").collect()
    assert (rss[0].title, rss[0].link, rss[0].tags) == ("A <i>x</i>", "http://a", ["k1", "k2"])
    rdf = read_feeds(table.where("source_id = 'd'")).first()
    assert (rdf.doi, rdf.authors, rdf.tags) == ("10.1/b", ["X", "Y"], ["s"])
    atom = read_feeds(table.where("source_id = 'a'")).first()
    assert (atom.link, atom.doi, atom.tags) == ("http://c", "10.1000/abc", ["t"])


def test_first_child_in_document_order(spark):
    rss = "<rss><title>no channel</title><channel>{}</channel><channel><item><title>second channel</title></item></channel></rss>"
    item = "<item><title> </title><title>T<b>wo</b> </title>{}</item>"
    both = ["<date>d</date><pubDate>p</pubDate>", "<pubDate>p</pubDate><date>d</date>", "<pubDate> </pubDate><published>q</published>"]
    atom = (
        '<feed xmlns="a"><!-- c --><entry><title>C</title><link href=""/><link>text</link><link href=" h "/><category term=" t "/><category/>'
        "<content>first</content><summary>second</summary><id>http://x/1</id></entry><other/></feed>"
    )
    rdf = "<RDF><item><summary>s</summary><encoded>e</encoded><url>u</url><link>l</link><subject>a</subject><category>b</category><subject>c</subject></item></RDF>"
    table = payloads(
        spark, ("r", "u1", rss.format("".join(item.format(b) for b in both))), ("a", "u2", atom), ("d", "u3", rdf),
        ("x", "u4", "<html/>"), ("y", "u5", ""), ("z", "u6", None),
    )
    got = {(r.source_id, r.item_pos): r for r in read_feeds(table).collect()}
    assert sorted(got) == [("a", 0), ("d", 0), ("r", 0), ("r", 1), ("r", 2)]
    assert [got["r", i].published for i in range(3)] == ["d", "p", "q"] and got["r", 0].title == "Two"
    assert (got["a", 0].link, got["a", 0].abstract, got["a", 0].tags, got["a", 0].doi) == ("h", "first", ["t"], "")
    assert (got["d", 0].link, got["d", 0].abstract, got["d", 0].tags) == ("u", "s", ["a", "b", "c"])
    assert sorted(r.source_id for r in read_payloads(table)[1].collect()) == ["x", "y", "z"]
    # One scan and one parse for all kinds of feeds.
    plan = read_feeds(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" not in plan


def test_dispatch_and_quarantine(spark):
    oup = "https://academic.oup.com/x/advance-articles"
    table = payloads(spark, ("r", "u1", RSS), ("l", oup, LISTING), ("bad", "u9", "<rss><channel>"))
    records, broken = read_payloads(table)
    got = {(r.source_id, r.title) for r in records.collect()}
    assert got == {
        ("r", "A <i>x</i>"), ("r", "Advisory Board and Contents"), ("l", "A long enough article title"),
    }
    assert [r.source_id for r in broken.collect()] == ["bad"]


def test_acquire_limits_and_stamps(spark):
    items = "".join(
        f"<item><title>T{i}</title><pubDate>2026-03-1{i}T00:00:00Z</pubDate></item>" for i in range(5)
    )
    table = payloads(spark, ("r", "u1", f"<rss><channel>{items}<item><title>undated</title></item></channel></rss>"))
    start, end = F.lit("2026-03-11").cast("timestamp"), F.lit("2026-03-14").cast("timestamp")
    rows = acquire(table, start, end, F.lit("now"), limit=3).records.orderBy("seq").collect()
    assert [(r.title, r.published_at, r.fetched_at) for r in rows] == [
        (f"T{i}", f"2026-03-1{i}T00:00:00Z", "now") for i in (1, 2, 3)
    ]


def test_acquire_joins_sources_in_listed_order(spark, tmp_path):
    from litsieve.config import DigestRules
    from litsieve.plans.digest import run_digest

    def feed(*titles):
        items = "".join(f"<item><title>{t}</title><pubDate>2026-03-11T00:00:00Z</pubDate></item>" for t in titles)
        return f"<rss><channel>{items}</channel></rss>"

    table = spark.createDataFrame(
        [("z", feed("first", "second")), ("a", feed("third")), ("cut", "<rss><channel>"), ("none", "<feed></feed>")], "url string, payload string"
    )
    sources = spark.createDataFrame(
        [("s", True, "f", "J", "g", "journal", "feed", ["z", "a", "gone"], 0), ("t", True, "f", "K", "g", "journal", "feed", ["cut", "none"], 1)],
        "source_id string, enabled boolean, publisher_family string, journal string, `group` string, publication_stage string, "
        "source_strategy string, source_locator array<string>, position int",
    )
    got = acquire(table, None, None, F.lit("now"), limit=2, sources=sources)
    assert [(r.title, r.seq) for r in got.records.orderBy("seq").collect()] == [("first", 0), ("second", 1)]
    assert [r.url for r in got.quarantine.collect()] == ["cut"]
    assert [(r.source_id, r.url) for r in got.missing.collect()] == [("s", "gone")]
    run = run_digest(got.records, DigestRules(), sources=sources)
    assert {r.title_en for r in run.normalized.collect()} == {"first", "second"}


def test_acquire_stores_records_not_feeds(spark):
    feeds = [("s", f"u{n}", f"<rss><channel>{'<item><title>t</title></item>' * n}</channel></rss>") for n in (0, 3, 5)]
    records, rest = read_payloads(payloads(spark, *feeds, ("s", "cut", "<rss>")))
    assert records.count() == 8 and [r.url for r in rest.collect()] == ["cut"]
    rows = spark.read.parquet(*records.inputFiles())
    # A row per record, one for the feed without records and one for what is no feed.
    assert rows.count() == 10 and "feed" not in rows.columns
    sources = spark.createDataFrame(
        [("s", True, "f", "J", "g", "journal", "feed", ["u3"], 0)],
        "source_id string, enabled boolean, publisher_family string, journal string, `group` string, publication_stage string, "
        "source_strategy string, source_locator array<string>, position int",
    )
    found, _, addresses = with_locators(spark.createDataFrame(feeds, "x string, url string, payload string"), sources)
    # Few addresses are a stored table, so they travel to the payloads.
    assert addresses.inputFiles() and "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_uncovered_listing_page_is_quarantined(spark):
    table = payloads(spark, ("l", "https://nowhere.example.org/toc", LISTING)).withColumn("source_strategy", F.lit("official_toc"))
    records, rest = read_payloads(table)
    assert records.count() == 0 and rest.count() == 1


def test_decisions_follow_file_names(spark, tmp_path):
    head = "journal,doi,article_url,title_en,review_final_decision,review_final_category,reviewer_notes\n"
    for name, decision in (("b.csv", "reject"), ("a.csv", "keep"), ("c.csv", "review")):
        (tmp_path / name).write_text(head + f"J,10.1/x,,,{decision},,\n")
    rows = read_decisions(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.review_final_decision for r in rows] == ["keep", "reject", "review"]


def test_links(spark):
    html = (
        '<script>var a="<a href=1>no</a>"</script><!-- <a href="c">no</a> --><a class=q HREF=\'/one?x=1&amp;y=2\'> a <b> b</b>&amp;c</a>'
        '<a name="t">no href</a><a href="/two">outer<a href="/three">inner</a><a href="/open">never closed'
    )
    rows = page_links(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("link_pos").collect()
    assert [(r.href, r.link_text) for r in rows] == [("/one?x=1&y=2", "a b &c"), ("/three", "inner")]


def test_jsonl_scan(spark, tmp_path):
    lines = [
        {"seq": 1, "title": "a", "tags": "one", "authors": ["x", "y"]},
        {"seq": 2, "title": "b", "tags": ["p", "q"]},
    ]
    path = tmp_path / "raw.jsonl"
    path.write_text("\n\n".join(json.dumps(line) for line in lines))
    rows = scan_records(spark, str(path)).orderBy("seq").collect()
    assert [(r.tags, r.authors) for r in rows] == [(["one"], ["x", "y"]), (["p", "q"], [])]
    path.write_text("{broken")
    try:
        scan_records(spark, str(path)).collect()
    except Exception:
        return
    raise AssertionError("a malformed line must stop the job")


def test_decision_file(spark, tmp_path):
    path = tmp_path / "queue.csv"
    path.write_text('journal,doi,title_en,review_final_decision,review_final_category\nJ,10.1/a,"A, ""b""", Keep ,\nJ,10.1/b,B,,\n')
    rows = read_decisions(spark, str(path)).collect()
    assert [(r.doi, r.title_en, r.review_final_decision, r.reviewer_notes) for r in rows] == [("10.1/a", 'A, "b"', "keep", "")]
    assert filled_decisions(read_decisions(spark, str(path))).count() == 1


def test_registry(spark):
    watchlist = {"journals": [
        {"id": "a", "enabled": True, "journal_name": "A", "source_locator": ["u1", "u2"]},
        {"id": "b", "enabled": False, "journal_name": "B", "source_locator": "u3"},
        {"id": "c", "enabled": True, "journal_name": "C", "source_locator": None},
    ]}
    sources = sources_from_watchlist(spark, watchlist)
    assert {r.source_id for r in select_sources(sources).collect()} == {"a", "c"}
    assert [r.url for r in source_locators(select_sources(sources, ["a", "b", "c"])).orderBy("url").collect()] == ["u1", "u2"]


def test_rules_from_mapping():
    rules = DigestRules.from_mapping({
        "relevance_filter": {"keep_keywords": ["x"]},
        "categories": [{"id": "k", "keywords": ["y"]}, {"id": "other", "keywords": []}],
        "display_priority": {"default_grouping_mode": "priority"},
    })
    assert rules.relevance.keep_keywords == ("x",) and rules.relevance.reject_keywords == ()
    assert rules.categories == {"k": ("y",)} and rules.display.grouping_mode == "priority"
