"""DOI and URL normal forms, and URL resolution."""

from __future__ import annotations

from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from litsieve.functions.text import as_column, bind, clean_text, regex_groups, strip_ends, text_or_empty

# Query parameters that carry tracking data only.
TRACKING_PARAMETERS = ("fbclid", "gclid", "mc_cid", "mc_eid", "spm")
TRACKING_PREFIXES = ("utm_",)


def canonical_doi(value: Column | str) -> Column:
    """Bare lower-case DOI: resolver address and ``doi:`` label removed."""
    doi = F.regexp_replace(clean_text(value), r"(?i)^https?://(dx\.)?doi\.org/", "")
    doi = F.regexp_replace(doi, r"(?i)^doi:\s*", "")
    return F.lower(F.trim(doi))


def _decode_part(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), F.replace(part, F.lit("+"), F.lit(" ")))


def _encode_part(part: Column) -> Column:
    # The Java encoder keeps '*' and escapes '~'; form encoding does the reverse.
    encoded = F.replace(F.url_encode(part), F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))


def _clean_query(query: Column) -> Column:
    """Drop empty and tracking parameters, keep order and blanks, encode afresh."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _decode_part(F.substring_index(p, "=", 1)).alias("name"),
            _decode_part(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )

    def wanted(pair: Column) -> Column:
        tracked = pair["name"].isin(*TRACKING_PARAMETERS)
        for prefix in TRACKING_PREFIXES:
            tracked = tracked | pair["name"].startswith(prefix)
        return ~tracked

    return F.array_join(
        F.transform(
            F.filter(pairs, wanted),
            lambda pair: F.concat(_encode_part(pair["name"]), F.lit("="), _encode_part(pair["value"])),
        ),
        "&",
    )


def canonical_url(value: Column | str) -> Column:
    """URL normal form for matching.

    Scheme and authority lower-case, path case kept (empty path is ``/``),
    parameters of the last path segment, fragment and tracking parameters
    dropped.  Text without scheme or authority is only trimmed.
    """
    absolute = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]+)([^?#]*)(?:\?([^#]*))?(?:#[\s\S]*)?$"

    def build(g: Column) -> Column:
        path = F.regexp_replace(g[2], ";[^/]*$", "")
        query = _clean_query(g[3])
        return F.concat(
            F.lower(g[0]),
            F.lit("://"),
            F.lower(g[1]),
            F.when(path == "", F.lit("/")).otherwise(path),
            bind(query, lambda q: F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))),
        )

    return bind(
        text_or_empty(strip_ends(value)),
        lambda raw: F.coalesce(bind(regex_groups(raw, absolute, (1, 2, 3, 4)), build), raw),
    )


@F.arrow_udf(StringType())
def _join_urls(base: pa.Array, href: pa.Array) -> pa.Array:
    if href.null_count == len(href):
        return href
    return pa.array(
        [
            None if b is None or h is None else urljoin(b, h)
            for b, h in zip(base.to_pylist(), href.to_pylist())
        ],
        pa.string(),
    )


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Resolve a link against its page.

    Links with a scheme and plain rooted paths resolve in the JVM; the rest
    (relative paths, ``..`` segments, bare queries) goes through an Arrow UDF.
    """
    base, href = as_column(base), as_column(href)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1)
    dotted = href.rlike(r"(^|/)\.{1,2}(/|$|[?#])")
    has_scheme = href.rlike(r"^https?://[^/?#]+/") & ~dotted
    rooted = href.rlike(r"^/[^/]") & ~href.contains(";") & ~href.endswith("#") & ~href.endswith("?") & ~dotted & (site != "")
    plain = F.when(has_scheme & ~href.endswith("#") & ~href.endswith("?"), href).when(
        rooted, F.concat(site, href)
    )
    return F.coalesce(plain, _join_urls(F.when(plain.isNull(), base), F.when(plain.isNull(), href)))
