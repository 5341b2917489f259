"""Licence scan with a paragraph classifier.

A logistic regression on word n-grams names the licence family of a paragraph or
says that it is unknown or no licence at all; probabilities are calibrated, and a
predicted family is confirmed by comparing the paragraph with its templates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from litsieve.llm.common import texts

# Notices by family (fixed values: the wordings that licences ask for, in short).
_GNU = "you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation either version {} of the license or at your option any later version"
_CC = "this work is licensed under a creative commons {} 4.0 international license"
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl-3.0": (
        "this program is free software " + _GNU.format("affero general public license", "3"),
        "licensed under the gnu affero general public license version 3",
        "licensed under the agpl version 3 or later",
    ),
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        "distributed under the terms of the apache 2.0 license",
    ),
    "bsd": (
        "released under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "use of this source code is governed by a bsd style license",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        _CC.format("attribution"),
        "available under the creative commons attribution license",
    ),
    "cc-by-nc": (
        "licensed under cc by nc 4.0",
        _CC.format("attribution noncommercial"),
        "available under the creative commons attribution non commercial license",
    ),
    "cc-by-nc-nd": ("licensed under cc by nc nd 4.0", _CC.format("attribution noncommercial noderivatives")),
    "cc-by-nc-sa": ("licensed under cc by nc sa 4.0", _CC.format("attribution noncommercial sharealike")),
    "cc-by-nd": ("licensed under cc by nd 4.0", _CC.format("attribution noderivatives")),
    "cc-by-sa": ("licensed under cc by sa 4.0", _CC.format("attribution sharealike"), "available under the creative commons attribution sharealike license"),
    "cc0": ("this work is released under cc0 1.0", "this work is dedicated to the public domain under the creative commons cc0 1.0 universal dedication"),
    "epl-2.0": (
        "licensed under the eclipse public license version 2.0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0",
    ),
    "gpl-2.0": (
        "this work is licensed under the gnu general public license version 2",
        "this program is free software " + _GNU.format("general public license", "2"),
        "licensed under the gpl version 2 or later",
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "this program is free software " + _GNU.format("general public license", "3"),
        "licensed under the gpl version 3 or later",
    ),
    "isc": (
        "released under the isc license",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "lgpl": (
        "this library is free software " + _GNU.format("lesser general public license", "2.1"),
        "this library is free software " + _GNU.format("lesser general public license", "3"),
        "licensed under the gnu lesser general public license",
        "licensed under the lgpl version 3 or later",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ),
    "mpl-2.0": (
        "licensed under the mozilla public license version 2.0",
        "this source code form is subject to the terms of the mozilla public license v 2.0",
    ),
    "unlicense": (
        "this software is released under the unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
}
# Versions of the families that have one; a notice that names another version is none of theirs.
VERSIONS = {"agpl-3.0": "3", "apache-2.0": "2", "epl-2.0": "2", "gpl-2.0": "2", "gpl-3.0": "3", "mpl-2.0": "2"}
# Words that a version follows, or stands in one word with.
BEFORE_VERSION = frozenset("version v license licence gpl agpl apache mpl epl".split())
VERSION = re.compile(r"(?:v|gplv?|agplv?|mplv?|eplv?)?([0-9]+(?:\.[0-9]+)*)")
# Notices of licences without a family, and sentences that only sound like a notice.
UNKNOWN_NOTICES = (
    "licensed under the {} license",
    "released under the {} license version 2",
    "this work is licensed under the {} public license",
    "distributed under the terms of the {} licence agreement",
    "available under the {} community license",
)
UNKNOWN_NAMES = (
    "acme", "zebra", "orion", "vendor", "example", "solaris", "quartz", "harbor", "nimbus", "proprietary", "evaluation", "partner",
    "artistic", "zlib", "common development and distribution", "european union", "python software foundation", "academic free",
)
# Names that only the calibration sees, so that its unknown notices are of families it has not met.
HELD_OUT_NAMES = ("boost software", "open font", "ms pl", "postgresql", "sleepycat", "do what you want")
NO_NOTICES = (
    "the driver lost his license after the accident",
    "a fishing license costs ten dollars in this state",
    "students at mit have released a study of public transport",
    "the license plate of the car was under the snow",
    "version 3 of the general plan was released to the public",
    "the apache helicopter flew under the clouds",
    "the work is free of charge for any person",
    "the terms of the agreement are subject to change",
    "this file is a copy of the source",
    "the foundation has distributed free software in the country",
)
UNKNOWN, NONE = "unknown", "none"
CLASSES = (*TEMPLATES, UNKNOWN, NONE)
# Blank lines end a paragraph; single line breaks are white space.
BLANK_LINES = r"\n[ \t\x0B\f\r]*\n\s*"
N_GRAM = 2
# Long paragraphs are read in overlapping windows of this many words.
WINDOW, STRIDE = 80, 40
COPIES = 12  # altered copies of every notice to train on, every fourth of them held out for the calibration
BACKGROUND = 2000  # paragraphs of the corpus to train on as no licence, at most
CERTAIN = 0.6  # families below this calibrated chance are unknown
EXPLAINED = 0.7  # share of a match that another family's template must explain to take it over
CONFIRMED = 0.6  # share of a template's n-grams that a paragraph must hold
WORDS = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

FOUND = "doc_id long, paragraph int, window int, family string, probability double, template string, similarity double, confirmed boolean"


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, N_GRAM + 1) for i in range(len(words) - n + 1)}


@dataclass
class Classifier:
    vocabulary: dict[str, int]
    weights: np.ndarray  # terms and a constant, by class
    temperature: float

    def features(self, grams: set[str]) -> list[int]:
        return sorted(self.vocabulary[g] for g in grams if g in self.vocabulary)

    def probabilities(self, rows: list[int]) -> np.ndarray:
        """Class probabilities of a paragraph; its vector has length 1, so long ones are not louder."""
        z = self.weights[-1] + (self.weights[rows].sum(axis=0) / np.sqrt(len(rows)) if rows else 0)
        z = np.exp((z - z.max()) / self.temperature)
        return z / z.sum()


def _altered(words: list[str], noise: list[str], rng: np.random.Generator) -> list[str]:
    """A notice as texts hold it: a word may be missing, others stand around it."""
    kept = [w for w in words if rng.random() > 0.06] or words
    around = [noise[i] for i in rng.integers(0, len(noise), rng.integers(0, 20))] if noise else []
    cut = rng.integers(0, len(around) + 1)
    return around[:cut] + kept + around[cut:]


def _softmax_fit(rows: list[list[int]], target: np.ndarray, terms: int, rounds: int = 400) -> np.ndarray:
    """Multinomial logistic regression with a small ridge, by gradient steps with momentum."""
    x = np.zeros((len(rows), terms + 1))
    for i, own in enumerate(rows):
        x[i, own] = 1 / np.sqrt(max(1, len(own)))
    x[:, -1] = 1
    y = np.eye(len(CLASSES))[target]
    # Classes weigh the same, however many examples they have.
    weight = 1 / np.maximum(1, np.bincount(target, minlength=len(CLASSES)))[target]
    weight = (weight / weight.sum())[:, None]
    at = np.zeros((terms + 1, len(CLASSES)))
    speed = np.zeros_like(at)
    for _ in range(rounds):
        z = x @ at
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - 4.0 * (x.T @ (weight * (p - y)) + 1e-4 * at)
        at = at + speed
    return at


def fit(background: list[str], seed: int = 11) -> Classifier:
    """Train on altered notices and on ``background`` windows.

    The temperature is fitted on held-out copies and on notices of licences that no
    training notice names, which the unknown class has to take.
    """
    rng = np.random.default_rng(seed)
    plain = [words_of(text)[:WINDOW] for text in background]
    plain = [w for w in plain if w and not {"license", "licence", "licensed", "licenses", "copyright"} & set(w)]
    noise = [w for own in plain[:200] for w in own][:4000]
    pairs: list[tuple[list[str], str, bool]] = []
    notices = [(t, family) for family, texts in TEMPLATES.items() for t in texts]
    notices += [(n.format(name), UNKNOWN) for n in UNKNOWN_NOTICES for name in UNKNOWN_NAMES]
    unmet = [words_of(n.format(name)) for n in UNKNOWN_NOTICES for name in HELD_OUT_NAMES]
    notices += [(n, NONE) for n in NO_NOTICES]
    for text, label in notices:
        copies = COPIES if label not in (UNKNOWN, NONE) else COPIES // 3
        pairs += [(_altered(words_of(text), noise, rng), label, i % 4 == 3) for i in range(copies)]
    pairs += [(w, NONE, i % 4 == 3) for i, w in enumerate(plain)]
    pairs += [(_altered(words, noise, rng), UNKNOWN, True) for words in unmet]
    # Terms are those of the notices: other words say nothing about licences.
    terms = sorted(set().union(*(grams_of(words_of(text)) for text, _ in notices)))
    model = Classifier({t: i for i, t in enumerate(terms)}, np.zeros((len(terms) + 1, len(CLASSES))), 1.0)
    rows = [model.features(grams_of(words)) for words, _, _ in pairs]
    target = np.array([CLASSES.index(label) for _, label, _ in pairs])
    held = np.array([h for _, _, h in pairs])
    model.weights = _softmax_fit([r for r, h in zip(rows, held) if not h], target[~held], len(terms))
    losses = {}
    for temperature in np.geomspace(0.25, 4, 25):
        model.temperature = float(temperature)
        chance = [model.probabilities(r)[t] for r, t, h in zip(rows, target, held) if h]
        losses[model.temperature] = -np.log(np.maximum(chance, 1e-12)).mean()
    model.temperature = min(losses, key=losses.get)
    return model


def _first_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First words of the first paragraph, as one example each; at most ``WINDOW`` words."""
    blank = re.compile(BLANK_LINES)
    for batch in batches:
        first = (blank.split(text or "", 1)[0] for text in batch.column("text").to_pylist())
        shown = [" ".join(words_of(paragraph)[:WINDOW])[: 16 * WINDOW] for paragraph in first]
        yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(shown, pa.string())], names=["h", "text"])


def background_windows(docs: DataFrame, n: int = BACKGROUND) -> list[str]:
    """One window of about ``n`` documents, those of smallest hash; for training only.

    The share of the documents is set by their number, so rows are chosen where they
    are and only their windows reach the driver: at most ``2 * n`` of 1,280 characters.
    """
    total = docs.count()
    share = min(1.0, n / max(total, 1))
    h = F.xxhash64("doc_id", "text")
    chosen = texts(docs, doc_id="long", text="string").withColumn("h", h).where(F.col("h") < int((share - 0.5) * 2.0**64) if share < 1 else F.lit(True))
    windows = chosen.select("h", "text").mapInArrow(_first_windows, "h long, text string")
    return [row["text"] for row in windows.groupBy("h").agg(F.min("text").alias("text")).limit(2 * n).collect()]


def _version(number: str) -> str:
    return re.sub(r"(\.0)+$", "", number)


def named_versions(words: list[str]) -> set[str]:
    """Version numbers that a notice names; 2.0 is 2."""
    found = set()
    for before, word in zip(["", *words], words):
        match = VERSION.fullmatch(word)
        if match and (before in BEFORE_VERSION or not word[0].isdigit()):
            found.add(_version(match[1]))
    return found


_TEMPLATE_GRAMS = [(family, t, grams_of(words_of(t))) for family, own in TEMPLATES.items() for t in own]


def rivalled(family: str, template: str, grams: set[str]) -> bool:
    """Whether a template of another family tells more about the n-grams that match this one.

    That is so where it is held as well, with as many n-grams, and explains most of
    the match: a notice with the words of one family and the further ones of another
    is the other's, and two notices side by side stay two.
    """
    own = grams_of(words_of(template))
    matched = own & grams
    for other, _, theirs in _TEMPLATE_GRAMS:
        held = theirs & grams
        if other != family and len(held) >= len(matched) and len(held) * len(own) >= len(matched) * len(theirs):
            if len(matched & theirs) >= EXPLAINED * len(matched):
                return True
    return False


def similarity(grams: set[str], family: str) -> tuple[str, float]:
    """The family's template of which the paragraph holds most n-grams, and their share."""
    share, template = max((len(own & grams) / len(own), t) for f, t, own in _TEMPLATE_GRAMS if f == family)
    return template, share


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """Licence notices of every document: ``doc_id, paragraph, window, family, probability,
    template, similarity, confirmed``.

    Whole texts are read, paragraph by paragraph (parted by blank lines), long ones in
    overlapping windows.  A row stands for a window whose likeliest class is a family
    or the unknown class; a family below ``CERTAIN`` is unknown too.  ``confirmed`` says
    that a template of the family is found in the window, and that no template of another
    family tells more about it; a notice that names another version than its family's is
    unknown.  Of classes with equal chances the first in the order of names counts.  A single line that confirms
    a family none of the paragraph's windows does has a row of its own behind them, so
    notices one below the other are all named.  Null and empty texts have no rows.
    Repeated rows are scanned one by one; a null doc_id stays null.
    """

    cues = {g for t in model.vocabulary for g in t.split()}
    templates = [grams_of(words_of(t)) for own in TEMPLATES.values() for t in own]
    template_words = {g for own in templates for g in own if " " not in g}

    def judged(part: list[str], around: list[str]) -> tuple | None:
        if cues.isdisjoint(part):
            return None  # no known term: no licence
        grams = grams_of(part)
        chance = model.probabilities(model.features(grams))
        best = int(chance.argmax())
        if CLASSES[best] == NONE:
            return None
        family, probability = CLASSES[best], float(chance[best])
        if family == UNKNOWN:
            return family, probability, None, 0.0, False
        template, share = similarity(grams, family)
        versions = named_versions(part)
        other = bool(versions) and family in VERSIONS and VERSIONS[family] not in versions
        if probability < CERTAIN or other:
            return UNKNOWN, probability, template, share, False
        sure = share >= CONFIRMED and not rivalled(family, template, grams | grams_of(around))
        return family, probability, template, share, sure

    def may_confirm(line: list[str]) -> bool:
        # The shortest template has nine n-grams, of which three words hold five at most.
        if len(template_words.intersection(line)) < 4:
            return False
        grams = grams_of(line)
        return any(len(own & grams) >= CONFIRMED * len(own) for own in templates)

    def windows(words: list[str]) -> list[list[str]]:
        return [words[start : start + WINDOW] for start in range(0, max(1, len(words) - STRIDE), STRIDE)]

    def surroundings(words: list[str], window: int) -> list[str]:
        """A window with a stride on either side: a notice may be cut by the window's ends."""
        return words[max(0, (window - 1) * STRIDE) : (window + 1) * STRIDE + WINDOW]

    def of_paragraph(paragraph: str) -> Iterator[tuple]:
        lines = [words for line in paragraph.split("\n") if (words := words_of(line))]
        whole = [word for words in lines for word in words]
        parts = windows(whole)
        named = set()
        for window, part in enumerate(parts):
            if found := judged(part, surroundings(whole, window)):
                if found[-1]:
                    named.add(found[0])
                yield (window, *found)
        window = len(parts)
        for words in lines if len(lines) > 1 else ():
            for at, part in enumerate(windows(words)) if may_confirm(words) else ():
                if (found := judged(part, surroundings(words, at))) and found[-1] and found[0] not in named:
                    yield (window, *found)
                    named.add(found[0])
                    window += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = re.compile(BLANK_LINES)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for number, paragraph in enumerate(blank.split(text or "")):
                    for found in of_paragraph(paragraph):
                        for column, value in zip(out, (doc_id, number, *found)):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.float64(), pa.bool_())
            names = [field.split()[0] for field in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return texts(docs, doc_id="long", text="string").mapInArrow(run, FOUND)


def licences(docs: DataFrame) -> DataFrame:
    """Train and scan all documents."""
    return scan(docs, fit(background_windows(docs)))
