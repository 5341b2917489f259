import random

from pyspark.sql import functions as F

from litsieve.operators import skew
from litsieve.operators.components import connected_components
from litsieve.operators.dedupe import clusters, key_table, resolve_duplicates
from litsieve.operators.normalize import normalize_records

RAW = "seq bigint, source_id string, journal string, title string, link string, doi string, published string, abstract string"


def records(spark, rows):
    return normalize_records(spark.createDataFrame(rows, RAW))


def test_chain_over_keys(spark):
    rows = [
        (1, "s", "J", "one", "http://x/a", "", "", ""),
        (2, "s", "J", "two", "", "10.1/1", "", ""),
        (3, "s", "J", "three", "http://x/a?utm_source=q", "doi:10.1/1", "", "long"),
        (4, "s", "J", "four", "", "", "", ""),
        (5, "s", "J", "FOUR!", "", "", "2026-01-01", ""),
    ]
    done = resolve_duplicates(records(spark, rows))
    assert {r.seq for r in done.survivors.collect()} == {3, 5}
    assert {(r.seq, r.duplicate_of) for r in done.duplicates.collect()} == {
        (1, "url:http://x/a"), (2, "url:http://x/a"), (4, "title:j::four"),
    }


def test_undated_wins_ties(spark):
    rows = [(1, "s", "J", "t", "", "10.1/1", "2026-01-01", ""), (2, "s", "J", "t", "", "10.1/1", "", "x")]
    assert [r.seq for r in resolve_duplicates(records(spark, rows)).survivors.collect()] == [2]


def test_empty_titles(spark):
    rows = [(i, "s", "J", "植物", f"http://x/{i}", "", "", "") for i in range(4)]
    keys = key_table(records(spark, rows))
    assert clusters(keys).select("cluster").distinct().count() == 1
    assert clusters(key_table(records(spark, rows), skip_empty_title=True)).select("cluster").distinct().count() == 4


def union_find(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    chain = [(i + 1, i) for i in range(0, 60)]
    hub = [(i, 1000) for i in range(1001, 1101)]
    loose = [tuple(sorted(rng.sample(range(2000, 2120), 2), reverse=True)) for _ in range(90)]
    edges = chain + hub + loose
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint").distinct())
    assert {r.node: r.component for r in found.collect()} == union_find(edges)


def test_rank_over_ranges(spark):
    rng = random.Random(5)
    data = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"g{i % 5}", rng.randint(0, 20), rng.choice("ab")) for i in range(2000)]
    rows = spark.createDataFrame(data, "seq bigint, g string, x int, y string")
    order = [F.col("x"), F.col("y"), F.col("seq")]
    for groups in ([], ["g"]):
        ranks = skew.rank_rows(rows, order, groups, ranges=7)
        expected = {}
        seen = {}
        for seq, g, x, y in sorted(data, key=lambda r: (r[2], r[3], r[0])):
            place = g if groups else None
            seen[place] = seen.get(place, 0) + 1
            expected[seq] = seen[place]
        assert {r.seq: r["rank"] for r in ranks.collect()} == expected


def test_top_counts_tie_goes_to_first_seen(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, "c")], "seq bigint, k string")
    assert [r.k for r in skew.top_counts(rows, "k", ["seq"], 2).collect()] == ["b", "a"]
