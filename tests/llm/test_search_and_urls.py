"""Multi-index search, revisits and URL filter."""

import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from litsieve.llm import queries
from litsieve.llm.bloom import build_filter, may_be_listed
from litsieve.llm.multi_index import nearest_neighbours
from litsieve.llm.revisits import HEADERS, latest_earlier, resolve_revisits
from litsieve.llm.url_filter import canonical, judge_urls

FOLDER = "/root/testdata/sf0.001"


def brute(vectors, query_id, k=10):
    ids, query = [i for i, _ in vectors], dict(vectors)[query_id]
    scored = sorted((math.dist(query, v), i) for i, v in vectors if i != query_id)
    assert len(set(ids)) == len(ids)
    return scored[:k]


def test_search_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(x) for x in rng.normal(size=7)]) for i in range(300)]
    copies = [(i, good[5][1]) for i in range(300, 340)]  # a hot vector
    odd = [(900, None), (901, [0.0] * 7), (902, [float("nan")] * 7), (903, [float("inf")] + [1.0] * 6), (904, [1.0, 2.0]), (905, [None] + [1.0] * 6)]
    rows = spark.createDataFrame(good + copies + odd + [(None, good[1][1]), good[7]], "vec_id long, embedding array<double>")
    rows = rows.withColumn("cell", F.lit("clash")).withColumn("query_id", F.lit(1))
    found = nearest_neighbours(rows, rows.where("vec_id % 50 = 5 or vec_id >= 900"), centroids=8).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(by_query) == {5, 55, 105, 155, 205, 255, 305}
    hits = 0
    for query, got in by_query.items():
        want = brute(good + copies, query)
        hits += len({i for _, i in got} & {i for _, i in want})
        assert len(got) == 10 and all(abs(s - math.dist(dict(good + copies)[query], dict(good + copies)[i])) < 1e-12 for s, i in got)
    assert hits >= 0.9 * 70
    # Copies have distance 0 and come in order of their ids.
    assert [i for _, i in by_query[5]] == list(range(300, 310))
    assert [i for _, i in by_query[305]] == [5, *range(300, 305), *range(306, 310)]


def test_search_few_and_none(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = nearest_neighbours(rows, rows.where("vec_id = 1")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(1, 1, 2, math.sqrt(2))]
    assert nearest_neighbours(rows.limit(0), rows.limit(0)).count() == 0


def test_search_query_recall(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    data = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    got = {}
    for r in queries.op1_multi_index(spark, FOLDER).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == {i for i, _ in data if i % 100 == 0}
    hits = [len(found & {i for _, i in brute(data, q)}) / 10 for q, found in got.items()]
    assert sum(hits) / len(hits) >= 0.9


def records(spark, rows):
    schema = f"record_id long, url string, captured_at timestamp, kind string, status int, headers {HEADERS}, body string"
    at = lambda h: None if h is None else dt.datetime(2024, 1, 1, h)
    return spark.createDataFrame([(i, u, at(h), k, s, head, b) for i, u, h, k, s, head, b in rows], schema)


def test_revisits_check_validators_and_merge_headers(spark):
    old = [("ETag", 'W/"a"'), ("Content-Type", "text/html"), ("Date", "old"), ("date", "older")]
    url = "http://a.example/x"
    rows = records(
        spark,
        [
            (1, url + "#top", 1, "response", 200, old, "one"),
            (2, "http://www.A.example/x/", 2, "revisit", 304, [("etag", '"a"'), ("content-type", "x"), ("DATE", "new"), ("Vary", "*")], None),
            (3, url, 3, "revisit", 304, [("ETag", '"b"')], None),
            (4, url, 4, "response", 200, [("Last-Modified", "m")], "two"),
            (5, url, 5, "revisit", 304, [("last-modified", "m")], None),
            (6, url, 6, "revisit", 304, None, None),
            (7, url, 0, "revisit", 304, [("ETag", '"a"')], None),
            (8, None, 9, "revisit", 304, [], None),
            (9, url, None, "revisit", 304, [], None),
            (10, url, 7, "response", 500, [], "error"),
            (11, url, 8, "revisit", 304, [("etag", '"a"')], None),
            (11, url, 8, "revisit", 304, [("etag", '"a"')], None),
            # The response of the same instant has the larger id, so it is not earlier.
            (20, "http://b.example/", 1, "revisit", 304, [], None),
            (21, "http://b.example/", 1, "response", 200, [], None),
            (22, "http://b.example/", 1, "revisit", 304, [], None),
        ],
    ).withColumn("key", F.lit("clash")).withColumn("outcome", F.lit("clash"))
    got = {r.record_id: r for r in resolve_revisits(rows).collect()}
    assert {i: (r.outcome, r.response_id) for i, r in got.items()} == {
        2: ("resolved", 1), 3: ("mismatch", 1), 5: ("resolved", 4), 6: ("unvalidated", 4), 7: ("missing", None), 8: ("missing", None),
        9: ("missing", None), 11: ("unvalidated", 4), 20: ("missing", None), 22: ("unvalidated", 21),
    }
    assert got[2].body == "one" and got[3].body is None and got[22].body is None
    assert [(h.name, h.value) for h in got[2].headers] == [("Content-Type", "text/html"), ("etag", '"a"'), ("DATE", "new"), ("Vary", "*")]
    assert resolve_revisits(rows.limit(0)).count() == 0


def test_hot_url_over_many_ranges(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("other")).otherwise(F.lit("hot")).alias("key"),
        F.timestamp_seconds("id").alias("captured_at"),
        F.col("id").alias("record_id"),
        (F.col("id") % 50 == 1).alias("full"),
    )
    got = {r.record_id: r.response_id for r in latest_earlier(rows, ranges=9).collect()}
    last, expected = {}, {}
    for i in range(4000):
        key = "other" if i % 3 == 0 else "hot"
        expected[i] = last.get(key)
        if i % 50 == 1:
            last[key] = i
    assert got == expected


def test_filter_has_no_false_negatives(spark):
    listed = spark.range(5000).select(F.col("id").cast("string").alias("u"))
    words = build_filter(listed, "u")
    probe = may_be_listed(spark, words)
    inside, outside = (
        spark.range(a, b).where(probe(F.xxhash64(F.col("id").cast("string")))).count() for a, b in ((0, 5000), (5000, 25000))
    )
    assert inside == 5000 and outside < 400
    # A filter that is far too small lets everything through; the join then decides.
    assert build_filter(listed, "u", max_blocks=1).shape == (1, 8)
    pages = listed.select(F.lit(1).alias("page_id"), F.concat(F.lit("http://h/"), "u").alias("url"))
    assert judge_urls(pages, pages.where("url like '%7'"), ()).where("verdict = 'block'").count() == 500


def test_rules_and_list(spark):
    urls = [
        ("http://Example.NET/en/x", "allow", "example.net/en/"), ("http://a.b.example.net/de/x", "block", "net/"), ("http://net/", "block", "net/"),
        ("http://example.net", "allow", None), ("http://example.net?x=/en/", "allow", None), ("http://xnet/", "allow", None),
        ("https://m.example.com/de/?q", "block", "example.com/de/"), ("https://m.example.com/dex", "allow", None),
        ("http://z.org/fr/1", "allow", "org/fr/"), ("http://listed.org/p/?utm_source=a", "block", None), ("http://www.listed.org/p#x", "block", None),
        ("http://listed.org/fr/p", "allow", "org/fr/"), ("http://listed.org/P", "allow", None), (None, "allow", None), ("no scheme", "allow", None), ("", "allow", None),
    ]
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(urls)] + [(3, urls[3][0])], "page_id long, url string")
    pages = pages.withColumn("host", F.lit("clash")).withColumn("listed", F.lit("clash"))
    listed = spark.createDataFrame([("ftp://LISTED.org/p/",), ("http://listed.org/fr/p",), (None,), ("nothing",)], "url string")
    rows = judge_urls(pages, listed).collect()
    assert len(rows) == len(urls) + 1
    got = {r.page_id: (r.verdict, r.rule) for r in rows}
    assert got == {i: (v, rule) for i, (_, v, rule) in enumerate(urls)}
    assert {(r.host, r.path) for r in rows if r.page_id in (13, 14, 15)} == {("", "")}
    assert judge_urls(pages.limit(0), listed.limit(0)).count() == 0


def test_canonical_form(spark):
    urls = ["http://www.A.org/x/?b=1&utm_medium=z&c=2#f", "https://a.org/x?b=1&c=2", "http://a.org?ref=q", "http://a.org/", None, "a.org"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(canonical(F.col("u")).alias("c")).collect()
    assert [r.c for r in rows] == ["a.org/x?b=1&c=2", "a.org/x?b=1&c=2", "a.org", "a.org", None, None]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("pages", "documents", "conversations"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = queries.queries()[name](spark, FOLDER)
    answer = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(result.columns)
    got = sorted((tuple(r[c] for c in names) for r in result.collect()), key=repr)
    assert got == sorted(answer.fetchall(), key=repr)
