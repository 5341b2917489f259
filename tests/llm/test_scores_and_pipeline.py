"""Toxicity, licence scan and the pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from litsieve.llm import queries
from litsieve.llm.licences import NONE, TEMPLATES, UNKNOWN, fit as fit_licences, scan
from litsieve.llm.toxicity import NEIGHBOURS, SLOTS, START_LETTERS, count_slots, fit, letter_terms, score_documents, toxicity

FOLDER = "/root/testdata/sf0.01"
INSULTS = ["idiot", "moron", "scumbag", "loserly", "worthless"]


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    syllables = ["an", "th", "re", "on", "ti", "es", "ed", "ou", "ing", "her"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(30, 90))]
        toxic = i % 6 == 0
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        docs.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, int(toxic)))
    return docs, labels


def tables(spark, docs, labels):
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic long").withColumn("text", F.lit("clash"))


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus()
    docs += [(5000, None), (5001, ""), (5002, "12 34 !?"), (5003, docs[0][1]), (5004, docs[0][1]), (None, docs[1][1]), (5005, "a " * 300_000), (0, docs[0][1])]
    labels += [(7777, 1), (None, 1), (1, None)]
    rows, known = tables(spark, docs, labels)
    got = score_documents(rows, fit(rows, known)).collect()
    assert len(got) == len(docs)
    by_id = {r.doc_id: r for r in got}
    for i, r in by_id.items():
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.doc_id is not None and r.held_out and r.doc_id < 900]
    caught = [r.predicted for r in held if r.doc_id % 6 == 0]
    wrong = [r.predicted for r in held if r.doc_id % 6]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.01
    assert by_id[5003].score == by_id[5004].score == by_id[0].score
    assert by_id[5000].score == by_id[5001].score == by_id[5002].score < 0.7
    assert len(by_id[3].evidence) == 5 and by_id[5000].evidence == []


def test_nearest_examples_match_all_cosines(spark):
    docs, labels = corpus(700)
    rows, known = tables(spark, docs, labels)
    model = fit(rows, known, per_label=200)
    index = model.index
    dense = np.zeros((index.size, len(model.vocabulary)))
    for term, place in enumerate(index.place):
        if place >= 0:
            dense[:, term] = index.dense[:, place].ravel()[: index.size]
        else:
            own = slice(index.lists[term], index.lists[term + 1])
            dense[index.example[own], term] = index.weight[own]
    assert np.allclose((dense**2).sum(axis=1), 1, atol=1e-5)
    for _, text in docs[::20]:
        terms, weights = model.vector(*letter_terms(text))
        best, cosine = index.nearest(terms, weights, NEIGHBOURS)
        assert np.allclose(cosine, np.sort(dense[:, terms] @ weights)[::-1][:NEIGHBOURS], atol=1e-5)


def test_cosines_match_tf_idf_from_scratch(spark):
    """Terms, document counts, weights and cosines computed again without the operator's arrays."""
    docs, labels = corpus(300)
    rows, known = tables(spark, docs, labels)
    model = fit(rows, known, per_label=60)

    def terms(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        trigrams = [("t", f" {w} "[i : i + 3]) for w in words for i in range(len(w))]
        return Counter(trigrams + [("s", w[:START_LETTERS]) for w in words])

    counted = {i: terms(text) for i, text in docs}
    held = Counter(t for found in counted.values() for t in found)

    def vector(found):
        weight = {t: (1 + math.log(n)) * (math.log((len(docs) + 1) / (held[t] + 1)) + 1e-6) for t, n in found.items()}
        length = math.sqrt(sum(w * w for w in weight.values())) or 1.0
        return {t: w / length for t, w in weight.items()}

    vectors = {i: vector(found) for i, found in counted.items()}
    for i, text in docs[::15]:
        best, cosine = model.index.nearest(*model.vector(*letter_terms(text)), NEIGHBOURS)
        plain = sorted((sum(w * vectors[int(e)].get(t, 0) for t, w in vectors[i].items()) for e in model.doc_id), reverse=True)
        # A term that shares a slot with another one has a count that is too high.
        assert np.allclose(cosine, plain[:NEIGHBOURS], atol=0.01)


def test_slots_count_documents(spark):
    docs, labels = corpus(200)
    rows, known = tables(spark, docs, labels)
    model = fit(rows, known, per_label=20)
    assert len(model.idf) == SLOTS
    held = Counter(int(k) for _, text in docs for k in letter_terms(text)[0])
    keys = np.array(list(held), np.int64)
    right = np.log((len(docs) + 1) / (np.array(list(held.values())) + 1)) + 1e-6
    found = model.idf[count_slots(keys)]
    assert (found <= right + 1e-6).all() and np.mean(np.isclose(found, right, atol=1e-6)) > 0.99
    # The vocabulary is that of the examples.
    texts = dict(docs)
    own = set(np.concatenate([letter_terms(texts[int(i)])[0] for i in model.doc_id]).tolist())
    assert set(model.vocabulary[:-1].tolist()) == own


def test_scores_depend_on_text_alone(spark):
    docs, labels = corpus(300)
    rows, known = tables(spark, docs, labels)
    model = fit(rows, known)
    moved = rows.select((F.col("doc_id") + 1).alias("doc_id"), "text")
    first = {r.doc_id + 1: r.score for r in score_documents(rows, model).collect()}
    assert first == {r.doc_id: r.score for r in score_documents(moved, model).collect()}


def test_long_texts_are_examples_and_all_terms_count(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    docs = [(i, " ".join(word(6) for _ in range(1500)) + (" " + " ".join(INSULTS) * 40 if i % 2 else "")) for i in range(40)]
    docs += [(100 + i, docs[1][1]) for i in range(3)] + [(1, docs[1][1] + " other")] * 3
    assert all(len(letter_terms(t)[0]) > 2048 for _, t in docs)
    rows, known = tables(spark, docs, [(i, i % 2) for i in range(40)] + [(9000 + i, 1) for i in range(40)])
    model = fit(rows, known, per_label=12)
    # Labels without a text take no place of the sample, and repeated rows are one example.
    drawn = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(model.toxic) == [0.0] * min(12, sum(i % 2 == 0 for i in drawn)) + [1.0] * min(12, sum(i % 2 for i in drawn))
    # The vocabulary is the corpus: no text has a term that its length leaves out.
    for _, text in docs[:5]:
        terms, weights = model.vector(*letter_terms(text))
        assert len(terms) == len(letter_terms(text)[0]) and (weights**2).sum() == pytest.approx(1)


def test_without_labels_or_rows(spark):
    rows, known = tables(spark, [(1, "some text"), (2, None)], [(9, 1)])
    assert [r.predicted for r in toxicity(rows, known.limit(0)).collect()] == [0, 0]
    assert toxicity(rows.limit(0), known).count() == 0


def test_terms_of_long_texts_piece_by_piece():
    text = " ".join(f"w{chr(97 + i % 26)}x" for i in range(2000))
    whole, pieces = letter_terms(text), letter_terms(text, piece=100)
    assert np.array_equal(whole[0], pieces[0]) and np.array_equal(whole[1], pieces[1])
    assert letter_terms(None)[0].size == letter_terms(" 1 ")[0].size == 0


@pytest.fixture(scope="module")
def scanner():
    rng = random.Random(8)
    return fit_licences([" ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 7))) for _ in range(40)) for _ in range(300)])


def test_notices_are_found_in_long_paragraphs(spark, scanner):
    rng = random.Random(9)
    filler = lambda n: " ".join("".join(rng.choice("aeiourstln") for _ in range(5)) for _ in range(n))
    texts = {family: f"{filler(300)} {notice}. {filler(200)}\n{filler(10)}" for family, options in TEMPLATES.items() for notice in options[:1]}
    docs = [(i, text) for i, text in enumerate(texts.values())]
    docs += [(50, filler(2000)), (51, None), (52, ""), (53, "the driver lost his license in the snow"), (54, "Licensed under the Zanzibar Vendor License."), (55, docs[0][1]), (None, docs[0][1])]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("family", F.lit("clash"))
    got = {}
    for r in scan(rows, scanner).collect():
        got.setdefault(r.doc_id, set()).add((r.family, r.confirmed))
    for i, family in enumerate(texts):
        assert (family, True) in got[i] and {f for f, ok in got[i] if ok} == {family}
    assert not {50, 51, 52, 53} & set(got)
    assert {f for f, _ in got[54]} == {UNKNOWN}
    assert got[55] == got[0] == got[None]
    assert scan(rows.limit(0), scanner).count() == 0


def test_wrapped_notices_and_notices_one_below_the_other(spark, scanner):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License"
    both = "Released under the MIT License\nLicensed under the Apache License, Version 2.0"
    texts = [bsd, gpl, both, f"{bsd}\r\n \t\r\n{gpl}\n\n\n{both}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in scan(rows, scanner).collect():
        if r.confirmed:
            got.setdefault(r.doc_id, set()).add((r.paragraph, r.family))
    assert got[0] == {(0, "bsd")} and got[1] == {(0, "gpl-3.0")} and got[2] == {(0, "mit"), (0, "apache-2.0")}
    assert got[3] == {(0, "bsd"), (1, "gpl-3.0"), (2, "mit"), (2, "apache-2.0")}


def test_classifier_on_new_notices(scanner):
    from litsieve.llm.licences import CLASSES, grams_of, words_of

    label = lambda text: CLASSES[int(scanner.probabilities(scanner.features(grams_of(words_of(text)))).argmax())]
    assert label("Code in this folder is licensed under the Apache License, Version 2.0") == "apache-2.0"
    assert label("Everything here is released under the MIT License") == "mit"
    assert label("Licensed under the GNU General Public License version 3") == "gpl-3.0"
    assert label("distributed under the terms of the Fabrikam licence agreement") == UNKNOWN
    assert label("the car has a new license plate") == NONE
    assert scanner.probabilities([]).argmax() == CLASSES.index(NONE)


HEADERS = [
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
     "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
     "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "agpl-3.0"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
     "Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "cc-by-nc-nd"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies.", "isc"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "epl-2.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Licensed under the Apache License, Version 1.1", None),
    ("Licensed under the Boost Software License version 1.0", None),
    ("This font is licensed under the SIL Open Font License", None),
]


def test_headers_of_like_licences(spark, scanner):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(HEADERS)], "doc_id long, text string")
    got = {}
    for r in scan(rows, scanner).collect():
        got.setdefault(r.doc_id, set()).add((r.family, r.confirmed))
    for i, (text, family) in enumerate(HEADERS):
        assert {f for f, ok in got.get(i, ()) if ok} == ({family} if family else set()), (text, got.get(i))
    # No licence without a family is taken for one.
    assert all({f for f, _ in got.get(i, ())} <= {UNKNOWN} for i, (_, family) in enumerate(HEADERS) if family is None)


def test_unknown_class_on_families_it_has_not_met(scanner):
    from litsieve.llm.licences import CERTAIN, CLASSES, UNKNOWN_NOTICES, grams_of, words_of

    names = ("fair source", "business source", "elastic", "microsoft reciprocal", "nokia open source", "intel", "w3c software notice", "ruby", "php", "qt")
    texts = [words_of(n.format(name)) for n in UNKNOWN_NOTICES for name in names]
    chances = [scanner.probabilities(scanner.features(grams_of(words))) for words in texts]
    families = [c for c in chances if CLASSES[int(c.argmax())] != UNKNOWN and c.max() >= CERTAIN]
    assert len(families) <= 0.05 * len(texts)


def test_licence_query_finds_every_notice(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id for r in queries.op7_licences(spark, FOLDER).collect() if r.confirmed}
    assert found == {i for i, t in docs.items() if "licen" in t.lower()}


def test_stages_one_after_the_other(spark, tmp_path):
    """Each stage against a plain version of what it decides."""
    docs, labels = corpus(400)
    docs += [(1000 + i, docs[1][1] + f" more{i}") for i in range(20)] + [(2000, None), (2001, "")]
    docs.append(docs[2])
    rows = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 4}", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near-duplicates", "mixing", "packing"]
    names = rows.columns

    start = read("documents.parquet")
    stages["toxicity"](spark, start, str(tmp_path)).write.parquet(f"{tmp_path}/1")
    scores = {r.doc_id: r.predicted for r in toxicity(start, read("labels.parquet")).collect()}
    assert sorted(r.doc_id for r in read("1").collect()) == sorted(i for i, _ in docs if not scores[i])

    stages["near-duplicates"](spark, read("1"), str(tmp_path)).write.parquet(f"{tmp_path}/2")
    ids = [r.doc_id for r in read("2").collect()]
    clean = {i for i, _ in docs if not scores[i]}
    assert sorted(ids) == sorted(i for i in clean if i < 1000 or i >= 2000) and 2 in ids

    stages["mixing"](spark, read("2"), str(tmp_path)).write.parquet(f"{tmp_path}/3")
    assert read("1").columns == read("2").columns == names and sorted(read("3").columns) == sorted(names)
    words = lambda name: sum(len((r.text or "").split()) for r in read(name).collect())
    assert abs(words("3") - 1.5 * words("2")) <= 4
    whole = dict(docs)
    # Taken words keep their order; words between two taken blocks may be missing.
    for r in read("3").collect():
        rest = iter(whole[r.doc_id].split())
        assert all(word in rest for word in r.text.split())

    packed = stages["packing"](spark, read("3"), str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in read("3").collect()}


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixing_stage_with_null_and_repeated_ids(spark):
    texts = [(1, "a b c"), (1, "d e f g"), (1, "d e f g"), (None, "h i"), (None, "j k l m n"), (2, "o p")]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], DOCUMENT)
    got = corpus_pipeline.mix_sources(spark, rows, "").collect()
    n = sum(len(t.split()) for _, t in texts)
    assert abs(sum(len(r.text.split()) for r in got) - 1.5 * n) <= 0.5
    # One block takes everything once, and half of the words again.
    assert all(sum((r.doc_id, r.text) == own for r in got) >= texts.count(own) for own in texts)


def test_near_duplicate_stage_judges_rows(spark):
    words = lambda start: " ".join(f"w{start}x{i}" for i in range(40))
    texts = [(1, words(1)), (2, words(1) + " more"), (2, words(2)), (2, words(3)), (2, words(3)), (3, words(4)), (3, words(5))]
    texts += [(4, None), (4, None), (4, ""), (5, ""), (None, words(6)), (None, words(7))]
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], DOCUMENT)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, rows, "").collect()]
    expected = {own for own in texts if own != (2, words(1) + " more")}
    assert len(got) == len(expected) and set(got) == expected


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
