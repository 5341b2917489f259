"""Near duplicates and fingerprints."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from litsieve.llm import queries
from litsieve.llm.common import shingles
from litsieve.llm.minhash import min_max_signature, near_duplicates
from litsieve.llm.syncmers import anchors, edited_fingerprints, matched_anchors

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sets_of(docs):
    found = {}
    for doc_id, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        found[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return found


def brute_components(docs, percent):
    sets = sets_of(docs)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, docs, percent):
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rep", F.lit("clash")).withColumn("band", F.lit("clash"))
    got = near_duplicates(rows, (percent, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len({i for i, _ in docs})


def test_components_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    docs = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "é \x85 x")]
    # A large group of near copies: edits of one text, from few to very many.
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((i, " ".join(words)))
    docs += [(200 + i, docs[10 + 7][1]) for i in range(40)]
    docs += [(300 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(80)]
    docs.append((2000, " ".join(vocabulary * 300)))
    rng.shuffle(docs)
    check(spark, docs, 85)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = queries.op5_minmax_dedup(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, 85)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(5, text), (5, text), (7, text), (9, "other words"), (None, text)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(rows).collect()}
    assert got == {5: (5, True), 7: (5, False), 9: (9, True)}
    assert near_duplicates(rows.limit(0)).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for share in (0.3, 0.6, 0.85):
        common = rng.integers(0, 2**63, 1000, np.uint64)
        n = int(1000 * (1 / share - 1) / 2)
        a, b = (np.concatenate([common, rng.integers(0, 2**63, n, np.uint64)]) for _ in range(2))
        errors.append((min_max_signature(a) == min_max_signature(b)).mean() - len(common) / (len(common) + 2 * n))
    assert max(map(abs, errors)) < 0.12


def test_long_texts_are_read_piece_by_piece():
    data = (" ".join(f"word{i}" for i in range(400_000))).encode()
    assert len(shingles(data, 5)) == 400_000 - 4


def edited(docs):
    ordered = sorted((i, t or "") for i, t in docs)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        yield i, text[: len(text) - half] + after[:half]


def test_edited_texts_and_likeness(spark):
    rng = random.Random(1)
    make = lambda n: " ".join("".join(rng.choice("abcdeé😀") for _ in range(5)) for _ in range(n))
    docs = [(i * 10 - 50, make(rng.randint(40, 200))) for i in range(30)]
    docs += [(7, None), (8, ""), (9, "a"), (11, "a b"), (12, " \n"), (13, docs[3][1]), (14, docs[3][1])]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("clash")).withColumn("owner", F.lit(0))
    got = {r.doc_id: r for r in edited_fingerprints(rows).collect()}
    assert set(got) == {i for i, _ in docs}
    for i, text in edited(docs):
        assert got[i].edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
    for i, text in docs:
        assert got[i].n_chars == len(text or "")
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if len(text or "") > 200 and i not in (13, -20):
            assert got[i].near_edited > 0.15 and got[i].near_next < 0.1
    assert got[13].fingerprint == got[14].fingerprint == got[-20].fingerprint != ""
    assert got[13].near_next == 1.0 and got[7].fingerprint == "" and got[7].near_next == 1.0
    single = edited_fingerprints(rows.where("doc_id = 0")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    assert edited_fingerprints(rows.limit(0)).count() == 0


def test_fingerprints_hold_every_anchor(spark):
    rng = random.Random(2)
    words = [f"v{rng.randrange(10**6)}" for _ in range(3000)]
    # The second text differs in one word and has a passage of its own.
    other = words[:1000] + ["changed"] + words[1001:] + [f"v{rng.randrange(10**6)}" for _ in range(60)]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    own = {r.doc_id: [a.hash for a in r.anchors] for r in anchors(rows).collect()}
    got = {r.doc_id: r for r in edited_fingerprints(rows).collect()}
    for i, found in own.items():
        assert len(found) > 1000 and got[i].fingerprint == "".join(f"{h & 0xFFFFFFFF:08X}" for h in found)
    alike = len({*own[1]} & {*own[2]}) / len({*own[1]} | {*own[2]})
    assert alike < 1 and abs(got[1].near_next - alike) < 1e-12 and abs(got[2].near_next - alike) < 1e-12


def test_repeated_ids_are_one_document(spark):
    rows = spark.createDataFrame([(1, "b b b"), (1, "a a a"), (2, "c"), (None, "x")], "doc_id long, text string")
    got = {r.doc_id: r.n_chars for r in edited_fingerprints(rows).collect()}
    assert got == {1: 3 + 2, 2: 1}


def test_anchors_do_not_depend_on_context(spark):
    rng = random.Random(5)
    words = [f"x{rng.randrange(10**6)}" for _ in range(400)]
    passage = " ".join(words[100:200])
    rows = spark.createDataFrame(
        [(1, " ".join(words[:300])), (2, "other start " + passage + " other end"), (3, "few words"), (4, None)], "doc_id long, text string"
    )
    found = anchors(rows)
    sizes = {r.doc_id: len(r.anchors) for r in found.collect()}
    # About half of the k-mers are anchors.
    assert 0.35 * 296 < sizes[1] < 0.65 * 296 and sizes[3] == 1 and sizes[4] == 0
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    got = matched_anchors(found, found, pairs).collect()
    assert [(r["shift"]) for r in got] == [2 - 100] and got[0].n > 30


def test_fingerprint_query_runs_native(spark):
    plan = queries.op6_closed_syncmers(spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
