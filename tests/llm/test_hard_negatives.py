"""Hard negatives against a loop over all pairs."""

import math

import pytest
from pyspark.sql import functions as F

from litsieve.llm import hard_negatives as hn
from litsieve.llm.queries import op12_slot_negatives

SCHEMA = "vec_id long, label long, embedding array<double>"


def brute(rows, anchor, positives=5, k=3):
    scaled = {i: (label, [math.floor(256 * x) for x in v]) for i, label, v in rows}
    out = []
    for a in sorted(i for i in scaled if anchor(i)):
        score = {i: sum(x * y for x, y in zip(scaled[a][1], v)) for i, (_, v) in scaled.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if scaled[i][0] == scaled[a][0]][:positives]:
            fits = [i for i in ranked if scaled[i][0] != scaled[a][0] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fits[:k])]
    return out


def found(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def test_ties_hot_label_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROW_BLOCK", 40)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 3)
    # Few different vectors, so many scores are equal; two thirds have one label.
    good = [(i, 0 if i % 3 else i % 5, [(i * 7 % 11) / 8 - 0.4, (i * 5 % 7) / 8, (i % 4) / 4]) for i in range(300)]
    odd = [
        (1000, None, [1.0] * 3), (1001, 1, None), (1002, 1, [1.0, None, 1.0]), (1003, 1, [float("nan")] * 3),
        (1004, 1, [float("inf")] * 3), (1005, 1, []), (1006, 1, [1.0] * 2), (None, 1, [1.0] * 3), good[8], (8, 9, [1.0] * 3),
    ]
    rows = spark.createDataFrame(good + odd, SCHEMA).withColumns({"rank": F.lit("clash"), "slot": F.lit("clash"), "anchors": F.lit(1)})
    got = found(hn.hard_negatives(rows, F.col("vec_id") % 20 == 0))
    assert got == sorted(brute(good, lambda i: i % 20 == 0)) and len(got) > 100


def test_large_components_and_empty_tables(spark):
    rows = [(0, 1, [2.0**20, 1.0]), (1, 1, [2.0**20, 3.0]), (2, 2, [2.0**20 - 2.0**18, 1.0]), (3, 2, [2.0**19 + 1, -1.0]), (4, 1, [-1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(hn.hard_negatives(df, F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0) != []
    # Beyond a long nothing breaks.
    found(hn.hard_negatives(df.withColumn("embedding", F.transform("embedding", lambda x: x * 2**60)), F.col("vec_id") == 0))
    assert found(hn.hard_negatives(df.limit(0), F.col("vec_id") == 0)) == []
    assert found(hn.hard_negatives(df, F.col("vec_id") == 7)) == []
    # Nothing of one's own label, and a negative positive score.
    alone = spark.createDataFrame([(0, 1, [1.0]), (1, 2, [1.0]), (2, 2, [-1.0])], SCHEMA)
    assert found(hn.hard_negatives(alone, F.col("vec_id") <= 1)) == []


def test_copies_of_anchors_stay_out_of_the_driver(spark, monkeypatch):
    for name, value in {"ROW_BLOCK": 4, "SHARDS": 5, "SHARD_BLOCKS": 4}.items():
        monkeypatch.setattr(hn, name, value)
    rows = [(i, i % 3, [(i * 7 % 11) / 8 - 0.4, (i * 5 % 7) / 8, (i % 4) / 4]) for i in range(300)]
    df = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    assert found(df) == sorted(brute(rows, lambda i: i % 20 == 0))
    # The blocks are small and Spark's threshold is its own: by estimate, either side would be broadcast.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [__shard" not in plan and "ShuffledHashJoin [__shard" in plan


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    plain = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, list(r.embedding)) for r in rows if r.label is not None and r.embedding]
    assert found(op12_slot_negatives(spark, "/root/testdata/sf0.001")) == sorted(brute(plain, lambda i: i % 50 == 0))


@pytest.mark.parametrize("score", [-7, -1, 0, 1, 2, 3, 199, 200, 201])
def test_limits(score):
    low, high = hn.limits(score, 50, 95)
    assert {n for n in range(-300, 300) if 50 * score <= 100 * n <= 95 * score} == set(range(low, high + 1))
