"""Lenient timestamp parsing and fixed output formats (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from litsieve.functions.text import as_column, bind, clean_text, constant_map, regex_groups, text_or_empty

# English month abbreviations and mail-header time zone names.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONE_OFFSETS = {
    "UT": "+00:00",
    "UTC": "+00:00",
    "GMT": "+00:00",
    "Z": "+00:00",
    "AST": "-04:00",
    "ADT": "-03:00",
    "EST": "-05:00",
    "EDT": "-04:00",
    "CST": "-06:00",
    "CDT": "-05:00",
    "MST": "-07:00",
    "MDT": "-06:00",
    "PST": "-08:00",
    "PDT": "-07:00",
}

_ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:[^\d](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    r"(?:(Z)|([+-]\d{2}):?(\d{2})?)?)?$"
)
_MAIL = (
    r"^(?:[A-Za-z]+\.?,?\s*)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s-]+(\d{2,4})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+(?:([+-]\d{2})(\d{2})|\(?([A-Za-z]+)\)?).*)?$"
)


def _or(value: Column, default: str) -> Column:
    return F.when(value == "", F.lit(default)).otherwise(value)


def _joined(*parts: Column | str) -> Column:
    pieces = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*pieces).try_cast("timestamp")


def _iso_timestamp(text: Column) -> Column:
    # year, month, day, hour, minute, second, fraction, zone hour, zone minute
    groups = regex_groups(text, _ISO, (1, 3, 4, 5, 6, 7, 8, 10, 11))

    def build(g: Column) -> Column:
        offset = F.when(g[7] == "", F.lit("+00:00")).otherwise(F.concat(g[7], F.lit(":"), _or(g[8], "00")))
        return _joined(
            g[0], "-", g[1], "-", g[2], "T",
            _or(g[3], "00"), ":", _or(g[4], "00"), ":", _or(g[5], "00"), ".", _or(g[6], "0"), offset,
        )

    return bind(groups, build)


def _mail_timestamp(text: Column) -> Column:
    # day, month, year, hour, minute, second, zone hour, zone minute, zone name
    groups = regex_groups(text, _MAIL, (1, 2, 3, 4, 5, 6, 7, 8, 9))
    months = constant_map({m: f"{i:02d}" for i, m in enumerate(MONTHS, 1)})
    zones = constant_map(ZONE_OFFSETS)

    def build(g: Column) -> Column:
        short = g[2].try_cast("int")
        year = F.when(short > 99, short).when(short > 68, short + 1900).otherwise(short + 2000)
        named = F.coalesce(F.try_element_at(zones, F.upper(g[8])), F.lit("+00:00"))
        offset = F.when(g[6] == "", named).otherwise(F.concat(g[6], F.lit(":"), g[7]))
        return _joined(
            F.lpad(year.cast("string"), 4, "0"), "-", F.try_element_at(months, F.lower(g[1])), "-",
            F.lpad(g[0], 2, "0"), "T", F.lpad(g[3], 2, "0"), ":", g[4], ":", _or(g[5], "00"), offset,
        )

    return bind(groups, build)


def parse_datetime(value: Column | str) -> Column:
    """ISO 8601 (no zone means UTC), then mail-header dates, else null."""
    return bind(clean_text(value), lambda text: F.coalesce(_iso_timestamp(text), _mail_timestamp(text)))


def iso_utc(value: Column | str) -> Column:
    """``2026-03-14T00:10:00Z``; null becomes ``''``."""
    return text_or_empty(F.date_format(as_column(value), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def date_label(value: Column | str) -> Column:
    """Publish date as shown to readers."""
    return F.coalesce(
        F.date_format(as_column(value), "yyyy-MM-dd HH:mm 'UTC'"), F.lit("Publish date unavailable")
    )
