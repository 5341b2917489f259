"""Removal of repeated strings against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from litsieve.llm import suffix_dedup as sd
from litsieve.llm.queries import op13_suffix_dedup


def brute(rows, length=100):
    """Rows in reading order: id, text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            key = data[p : p + length]
            if key in seen:
                gone[p : p + length] = True
            else:
                seen.add(key)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (rows[i][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=repr)


def found(df):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def sample(n=120, seed=5):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(2, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(30) for _ in range(4)] + ["é" * 80, "x" * 150, "ab" * 90]
    rows = []
    for i in range(n):
        kind = draw.random()
        if kind < 0.2 and rows:
            text = draw.choice(rows)[1] or ""
        elif kind < 0.5:
            # One short line with other text around it, and passages cut off at their edges.
            p = draw.choice(passages)
            text = prose(5) + p[: draw.randint(min(90, len(p)), len(p))] + prose(6) + passages[0] + draw.choice(["", passages[0][40:]])
        elif kind < 0.6 and rows and rows[-1][1]:
            old = rows[-1][1]
            text = old[: len(old) // 2] + "#" + old[len(old) // 2 + 1 :]
        else:
            text = prose(draw.randint(0, 40))
        rows.append((i * 3 % n, text))
    return rows


def test_against_all_strings(spark):
    rows = sample() + [(1000, None), (1001, ""), (1002, "short"), (1003, "z" * 99), (1004, "z" * 100), (1005, "y" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit("clash"), "hash": F.lit(1), "at": F.lit(2)})
    want = brute(rows)
    assert sum(r[2] for r in want) > 5000
    assert found(sd.suffix_dedup(df)) == want
    # Small blocks, and anchors in parts of two segments.
    assert found(sd.suffix_dedup(df, block_bytes=700, part_segments=2)) == want


def test_other_lengths_and_texts(spark, monkeypatch):
    monkeypatch.setattr(sd, "SLICE_BYTES", 64)
    rows = sample(60, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sd.suffix_dedup(df, length=40, anchor=16, with_text=True)
    assert found(got) == brute(rows, 40)
    for r in got.where("kept_text not like '%�%'").collect():
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_repeated_rows_and_no_ids(spark):
    text = " ".join(map(str, range(200)))
    rows = [(5, text), (5, text), (None, text), (None, text), (7, text[50:])]
    got = found(sd.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)))
    assert got == brute(rows) and sum(r[2] == 0 for r in got) == 1
    assert found(sd.suffix_dedup(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_sorting():
    draw = random.Random(2)
    data = bytes(draw.choice(b"ab") for _ in range(3000)) + b"c" * 300
    for length, shallow in ((20, 0), (20, 8), (24, 16), (12, 8)):
        places = list(range(0, len(data) - length + 1))
        want: dict = {}
        for p in places:
            want.setdefault(data[p : p + length], []).append(p)
        got = [sorted(g) for g in sd.deep_shallow(data, np.array(places), length, shallow)]
        assert sorted(got) == sorted(v for v in want.values() if len(v) > 1)
        assert [data[g[0] : g[0] + length] for g in got] == sorted(data[g[0] : g[0] + length] for g in got)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_suffix_dedup(spark, "/root/testdata/sf0.001")) == brute(docs)


def test_lengths_that_hashes_cannot_cover(spark):
    docs = spark.createDataFrame([(1, "a" * 300)], "doc_id long, text string")
    for length, anchor in ((100, 24), (120, 32), (60, 32)):
        with pytest.raises(ValueError):
            sd.suffix_dedup(docs, length=length, anchor=anchor)
