"""Text cleaning and display text, as Spark columns.

Every function takes a column (or column name) and returns a column, so the
work stays in whole-stage code generation.  The one exception is entity
decoding: HTML has some 2,200 named entities with prefix rules, which Spark has
no built-in for, so rows that hold an ``&`` go through an Arrow UDF.  All other
rows reach that UDF as nulls and pass through untouched.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# White space as Unicode defines it, plus the four ASCII separators that a
# Java ``\s`` leaves out.  Latin characters are listed one by one and the others
# sit behind one range check: Java then needs two tests for a letter, where a
# plain union of the same ranges runs six times slower over long texts.
SPACES = (
    r"[\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)
# A run of white space other than one blank.  Single blanks stay where they are: a pattern
# that replaced each by itself would rebuild every text word by word.
UNEVEN = f"{SPACES}(?:{SPACES}+|(?<! ))"
# ASCII letters and digits, listed for the same reason.
ALPHANUMERICS = "abcdefghijklmnopqrstuvwxyz0123456789"
# The same characters one by one, for trimming.
SPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
TAG = r"<[^>]+>"
# Joins list elements for a joint decode; no entity decodes to this character.
ELEMENT_MARK = "\x01"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` computed once, however often it is used.

    The lambda is interpreted, which also keeps long expressions out of the
    generated method and its size limit.
    """
    return F.element_at(F.transform(F.array(value), build), 1)


def regex_groups(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """Array of capture groups of a full match from one regex pass, unmatched ones ``''``."""
    marked = F.regexp_replace(text, pattern, ELEMENT_MARK.join(f"${g}" for g in groups))
    return F.when(text.rlike(pattern), F.split(marked, ELEMENT_MARK))


@F.arrow_udf(StringType())
def _decode(values: pa.Array) -> pa.Array:
    if values.null_count == len(values):
        return values
    return pa.array(
        [None if text is None else html.unescape(text) for text in values.to_pylist()], pa.string()
    )


def decode_entities(text: Column | str) -> Column:
    """Decode HTML entities once; text without ``&`` never leaves the JVM."""
    text = as_column(text)
    return F.coalesce(_decode(F.when(text.contains("&"), text)), text)


def squeeze(text: Column | str) -> Column:
    """Collapse each run of white space to one blank and trim the ends."""
    return F.trim(F.regexp_replace(as_column(text), UNEVEN, " "))


def strip_ends(text: Column | str) -> Column:
    """Trim white space of any kind from both ends, keeping the inside."""
    return F.trim(as_column(text), F.lit(SPACE_CHARACTERS))


def strip_long(text: Column | str) -> Column:
    """``strip_ends`` for long texts, which it reads several times: pass a column or a lambda's variable.

    Spark lists all characters of a text to trim its right end, so only texts that end in
    white space are trimmed there.
    """
    text, spaces = as_column(text), F.lit(SPACE_CHARACTERS)
    ends = F.exists(F.array(*(F.lit(c) for c in SPACE_CHARACTERS)), text.endswith)
    return F.when(ends, F.trim(text, spaces)).otherwise(F.ltrim(text, spaces))


def strip_markup(text: Column | str) -> Column:
    return bind(
        as_column(text),
        lambda t: squeeze(F.when(t.contains("<"), F.regexp_replace(t, TAG, " ")).otherwise(t)),
    )


def clean_text(text: Column | str) -> Column:
    """Entities first, then tags, then white space; null becomes ``''``."""
    return strip_markup(F.coalesce(decode_entities(text), F.lit("")))


def clean_list(values: Column | str) -> Column:
    """``clean_text`` on each element; elements that end up empty are dropped."""
    joined = decode_entities(F.array_join(as_column(values), ELEMENT_MARK))
    return F.filter(
        F.transform(F.split(F.coalesce(joined, F.lit("")), ELEMENT_MARK), strip_markup),
        lambda item: item != "",
    )


def letters_and_digits(text: Column | str) -> Column:
    """Lower-case ASCII letters and digits of already clean text, blank-separated."""
    return F.trim(F.regexp_replace(F.lower(as_column(text)), f"[^{ALPHANUMERICS}]+", " "))


def normalize_title(text: Column | str) -> Column:
    """Title form used for matching; titles in other scripts become empty."""
    return letters_and_digits(clean_text(text))


def first_filled(*columns: Column | str) -> Column:
    """First column that is neither null nor ``''``."""
    return F.coalesce(*(F.nullif(as_column(c), F.lit("")) for c in columns))


def snippet(text: Column | str, limit: int = 240) -> Column:
    """At most ``limit`` characters; a cut text ends in an ellipsis."""
    flat = squeeze(text)
    return F.when(F.length(flat) <= limit, flat).otherwise(
        F.concat(F.rtrim(F.substring(flat, 1, limit - 1)), F.lit("…"))
    )


def list_text(values: Column | str) -> Column:
    """A list shown as comma-separated text, null as ``''``."""
    return F.coalesce(F.array_join(as_column(values), ", "), F.lit(""))


def text_or_empty(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(""))


def author_line(authors: Column | str) -> Column:
    """``Authors: …`` with all names up to five, else the first two and last three."""
    names = F.filter(
        F.transform(F.coalesce(as_column(authors), F.array().cast("array<string>")), strip_ends),
        lambda name: name != "",
    )
    shown = F.when(F.size(names) <= 5, names).otherwise(
        F.concat(F.slice(names, 1, 2), F.slice(names, -3, 3))
    )
    return F.when(F.size(names) == 0, F.lit("")).otherwise(
        F.concat(F.lit("Authors: "), F.array_join(shown, ", "))
    )


def title_words(value: Column | str) -> Column:
    """``my-stage`` → ``My-Stage``: each part between hyphens gets a capital."""
    return F.array_join(F.transform(F.split(as_column(value), "-"), F.initcap), "-")


def label_for(value: Column | str, labels: dict[str, str], default: str | None = None) -> Column:
    """Look a value up in a small label map; unknown values fall back to ``default``
    or to the capitalised value."""
    value = as_column(value)
    fallback = title_words(value) if default is None else F.lit(default)
    return F.coalesce(F.try_element_at(constant_map(labels), value), fallback)


def constant_map(values: dict[str, str]) -> Column:
    """A map literal, passed as one JSON text that folds to a constant."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")
