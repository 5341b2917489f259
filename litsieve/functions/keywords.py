"""Keyword matching without a shuffle.

A text is split once into runs of ``[a-z0-9]``; a run boundary is exactly the
boundary a keyword needs.  The runs are intersected with the vocabulary of all
rule lists, and every rule list is then answered from that short array.
Keywords of more than one run (phrases, hyphens) of all lists are matched by one
pattern that is a trie, in texts that hold the first run of one.  The whole thing is a
narrow projection: no explode, no join, no regrouping, whatever the data size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from litsieve.functions.text import ALPHANUMERICS, SPACES, as_column

_RUN = re.compile("[a-z0-9]+")
_SINGLE = re.compile("[a-z][a-z0-9-]{2,}")


def takes_plural(keyword: str) -> bool:
    """Single words of three or more characters may carry one plural ``s``."""
    return bool(_SINGLE.fullmatch(keyword)) and not keyword.endswith("s")


def _is_one_run(keyword: str) -> bool:
    return bool(_RUN.fullmatch(keyword))


def keyword_pattern(keyword: str) -> str:
    """Java pattern for one keyword in lower-case text."""
    key = keyword.lower()
    body = "".join(SPACES + "+" if ch == " " else ch if ch.isalnum() else "\\" + ch for ch in key)
    if takes_plural(key):
        body += "s?"
    left = "(?<![a-z0-9])" if key[:1].isalnum() else ""
    right = "(?![a-z0-9])" if key[-1:].isalnum() else ""
    return left + body + right


def _vocabulary(keywords: Iterable[str]) -> list[str]:
    runs: dict[str, None] = {}
    for keyword in keywords:
        key = keyword.lower()
        parts = _RUN.findall(key)
        for run in parts:
            runs.setdefault(run)
        if parts and takes_plural(key):
            runs.setdefault(parts[-1] + "s")
    return list(runs)


def token_runs(lowered: Column | str) -> Column:
    return F.split(as_column(lowered), f"[^{ALPHANUMERICS}]+")


def present_runs(lowered: Column | str, keywords: Sequence[str]) -> Column:
    """Vocabulary runs that occur in the text, each once."""
    vocabulary = _vocabulary(keywords)
    if not vocabulary:
        return F.array().cast("array<string>")
    return F.array_intersect(F.split(F.lit(" ".join(vocabulary)), " "), token_runs(lowered))


def phrase_trie(phrases: Sequence[str]) -> str:
    """One Java pattern for all phrases, as a trie: it reads each character once.

    Among phrases that start at one place it matches the longest that fits.
    """
    root: dict = {}
    for phrase in phrases:
        node = root
        for ch in phrase:
            node = node.setdefault(ch, {})
        # The end of a phrase is an edge of its own, tried after all longer ones.
        node[""] = ("s?" if takes_plural(phrase) else "") + ("(?![a-z0-9])" if phrase[-1:].isalnum() else "")

    def shown(node: dict) -> str:
        edges = [_edge(ch) + shown(child) for ch, child in node.items() if ch]
        edges += [node[""]] if "" in node else []
        return edges[0] if len(edges) == 1 else "(?:" + "|".join(edges) + ")"

    return shown(root)


def _edge(ch: str) -> str:
    return SPACES + "+" if ch == " " else ch if ch.isalnum() else "\\" + ch


def _implied(phrases: Sequence[str]) -> dict[str, list[str]]:
    """Phrases that occur where a given text was matched: itself, and those it starts with."""
    known, out = dict.fromkeys(phrases), {}
    for phrase in phrases:
        for text in (phrase, phrase + "s") if takes_plural(phrase) else (phrase,):
            found = []
            for end in range(1, len(text) + 1):
                # A shorter phrase ends where no letter or digit follows.
                if end < len(text) and text[end - 1].isalnum() and _RUN.match(text[end]):
                    continue
                head = text[:end]
                found += [k for k in (head, head[:-1]) if k in known and (k == head or takes_plural(k) and head == k + "s")]
            out[text] = list(dict.fromkeys(found))
    return out


def found_terms(lowered: Column | str, present: Column | str, keywords: Sequence[str]) -> Column:
    """``present`` plus every confirmed phrase, as the lower-case keyword.

    All phrases of all lists are looked for in one pass, whatever their number; texts
    without the first word of any phrase are passed over.
    """
    lowered, present = as_column(lowered), as_column(present)
    phrases = [k for k in dict.fromkeys(k.lower() for k in keywords) if not _is_one_run(k)]
    # Keywords that start with a mark need no boundary before them.
    bounded, free = [p for p in phrases if p[:1].isalnum()], [p for p in phrases if p and not p[:1].isalnum()]
    found = []
    for group, left in ((bounded, "(?<![a-z0-9])"), (free, "")):
        if not group:
            continue
        # Inside a look-ahead, so that a phrase may start within another one.
        matches = F.regexp_extract_all(lowered, F.lit(f"{left}(?=({phrase_trie(group)}))"), F.lit(1))
        texts = F.array_distinct(F.transform(matches, lambda m: F.regexp_replace(m, SPACES + "+", " ")))
        implied = F.from_json(F.lit(json.dumps(_implied(group))), "map<string,array<string>>")
        terms = F.array_distinct(F.flatten(F.transform(texts, lambda t: F.element_at(implied, t))))
        first = list(dict.fromkeys(_RUN.findall(p)[0] for p in group if _RUN.search(p)))
        if all(map(_RUN.search, group)):
            terms = F.when(F.arrays_overlap(present, F.split(F.lit(" ".join(first)), " ")), terms)
        found.append(F.coalesce(terms, F.array().cast("array<string>")))
    return F.concat(present, *found) if found else present


def hits_among(found: Column | str, keywords: Sequence[str]) -> Column:
    """Keywords of one list that occur, in list order, one per list entry."""
    if not keywords:
        return F.array().cast("array<string>")
    found = as_column(found)
    entries = []
    for keyword in keywords:
        key = keyword.lower()
        plural = key + "s" if _is_one_run(key) and takes_plural(key) else key
        entries.append({"term": keyword, "one": key, "many": plural})
    # A JSON literal folds to a constant and costs one call, not one per keyword.
    table = F.from_json(F.lit(json.dumps(entries)), "array<struct<term:string,one:string,many:string>>")
    return F.transform(
        F.filter(table, lambda e: F.array_contains(found, e["one"]) | F.array_contains(found, e["many"])),
        lambda e: e["term"],
    )


def contains_any(text: Column | str, parts: Sequence[str]) -> Column:
    """Plain substring test against a short list; one pass over the text."""
    if not parts:
        return F.lit(False)
    return as_column(text).rlike("|".join(_literal(p) for p in parts))


def _literal(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in text)


def starts_with_any(text: Column | str, prefixes: Sequence[str]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | as_column(text).startswith(prefix)
    return test
