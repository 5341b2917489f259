"""Term candidates for the glossary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.defaults import TERM_STOP_WORDS
from litsieve.functions.text import ALPHANUMERICS, SPACES, as_column, squeeze, text_or_empty
from litsieve.operators.skew import counts_with_first
from litsieve.session import release, stored

# Counters of the sketch, and the terms it names.
TRACKED_TERMS = 200_000
NAMED_TERMS = 2_000

# Fixed value: a term is one to four words, the first starting with a letter.
# Word boundaries are spelled out, since the Unicode ones of Java are slow.
_WORD = rf"[{ALPHANUMERICS}_[\x80-\x{{10ffff}}&&[\p{{L}}\p{{N}}]]]"
_PART = f"[{ALPHANUMERICS}-]"
TERM_PATTERN = (
    rf"(?<!{_WORD})[a-z]{_PART}{{2,}}(?:{SPACES}+{_PART}{{2,}}){{0,3}}"
    rf"(?:(?<!-)(?!{_WORD})|(?<=-)(?={_WORD}))"
)


def normalize_term(term: Column | str) -> Column:
    return squeeze(F.lower(as_column(term)))


def term_occurrences(records: DataFrame, stop_words: Sequence[str] = TERM_STOP_WORDS) -> DataFrame:
    """One row per occurrence of a usable term: ``term``, ``seq``, ``pos``."""
    text = F.lower(
        F.concat_ws(" ", text_or_empty("title_en"), text_or_empty("abstract"), F.array_join("tags", " "))
    )
    def usable(term: Column) -> Column:
        return (
            (F.length(term) >= 4)
            & ~(term.rlike("[0-9]") & (F.size(F.split(term, " ")) > 2))
            & ~term.isin(*stop_words)
        )

    # Normalized and tested inside the array, where each term is computed once.
    matches = F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0))
    terms = F.filter(F.transform(matches, squeeze), usable)
    return records.select("seq", F.posexplode(terms).alias("pos", "term"))


def _most_frequent(occurrences: DataFrame, tracked: int, named: int) -> tuple[list[str], int]:
    """Terms that a counter sketch names, and how often a term it doesn't name can occur.

    Each task keeps ``tracked`` counters; the sketches are merged, never the terms.
    A counter is off by at most 3.5 parts in ``tracked`` of all occurrences.
    """
    row = occurrences.agg(
        F.expr(f"approx_top_k(term, {named}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    top, error = row["top"] or [], 0 if row["n"] <= tracked // 2 else -(-7 * row["n"] // (2 * tracked))
    return [e["item"] for e in top], error + (top[-1]["count"] if len(top) == named else 0)


def glossary_candidates(
    records: DataFrame,
    known_terms: DataFrame | Sequence[str],
    limit: int = 50,
    examples: int = 2,
    stop_words: Sequence[str] = TERM_STOP_WORDS,
    tracked: int = TRACKED_TERMS,
    named: int = NAMED_TERMS,
) -> DataFrame:
    """Most frequent unknown terms with example titles, by count then first seen.

    The pattern runs over the texts once; its terms are stored without their titles.
    A counter sketch names the candidates, and those alone are counted exactly, with
    their first occurrences in the same pass.  Where the sketch's error bound cannot
    tell the last winner from a term it did not name, all terms are counted, so the
    result is always exact.
    """
    occurrences = stored(term_occurrences(records, stop_words).select("term", "seq", "pos"))
    spark = records.sparkSession
    if not isinstance(known_terms, DataFrame):
        known = spark.createDataFrame([(t,) for t in known_terms], "term string")
    else:
        known = known_terms.select("term").distinct()

    def best(rows: DataFrame) -> DataFrame:
        counted = counts_with_first(rows, "term", ["seq", "pos"], examples).join(known, "term", "left_anti")
        # At most ``limit`` rows.
        return stored(counted.orderBy(F.desc("n"), "first").limit(limit))

    terms, unseen = _most_frequent(occurrences, tracked, named)
    candidates = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))
    top = best(occurrences.join(candidates, "term", "left_semi"))
    counts = [r["n"] for r in top.select("n").collect()]
    if unseen and (len(counts) < limit or min(counts) <= unseen):
        release(top)
        top = best(occurrences)
    # The titles of at most ``limit`` times ``examples`` records.
    wanted = top.select("term", "n", F.col("first")[0]["o0"].alias("first_seq"), F.posexplode("first").alias("item", "e"))
    shown = records.select("seq", "title_en").join(F.broadcast(wanted.withColumn("seq", F.col("e.o0"))), "seq")
    titles = F.transform(F.array_sort(F.collect_list(F.struct("item", "title_en"))), lambda e: e["title_en"])
    return shown.groupBy("term", "n", "first_seq").agg(titles.alias("examples"))
