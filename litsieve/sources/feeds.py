"""Feed payloads to records: RSS 2.0, RDF (RSS 1.0) and Atom.

Payloads are rows of a table: ``url``, ``payload`` and source columns.  Each is
parsed once, inside its own task, into the children of its items in document
order.  Which children make up a record is said by column expressions over that
list.  A payload that is not well-formed, or is no feed, has no list and can be set
aside from the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from litsieve.defaults import FRONT_MATTER_TITLES
from litsieve.functions.text import first_filled, strip_ends, text_or_empty
from litsieve.schemas import FEED_COLUMNS
from litsieve.session import evaluate_once, small_batches

SOURCE_COLUMNS = ("source_id", "journal", "publisher_family", "group", "publication_stage")

# Element of an item, by the local name of the root.
ITEM_OF = {"rss": "item", "RDF": "item", "feed": "entry"}
_CHILD = pa.struct([(name, pa.string()) for name in ("name", "text", "href", "term")])
_PARSED = pa.struct([("root", pa.string()), ("items", pa.list_(pa.list_(_CHILD)))])


def _local(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2] if isinstance(element.tag, str) else ""


def _parsed(payload: str | None) -> tuple[str, list[list[tuple]]] | None:
    """Root and items of a feed, each item the list of its children in document order."""
    try:
        root = ElementTree.fromstring(payload or "")
    except (ElementTree.ParseError, ValueError):
        return None
    name = _local(root)
    if name not in ITEM_OF:
        return None
    # The items of RSS stand in its first channel.
    parent = next((c for c in root if _local(c) == "channel"), ()) if name == "rss" else root
    items = [
        [(_local(c), "".join(c.itertext()).strip(), c.get("href"), c.get("term")) for c in item]
        for item in parent
        if _local(item) == ITEM_OF[name]
    ]
    return name, items


def _column(payload: str | None) -> pa.Array:
    """One payload as an Arrow value; the fields of its children lie one after another."""
    found = _parsed(payload)
    if found is None:
        return pa.array([None], _PARSED)
    root, items = found
    children = [child for item in items for child in item]
    fields = [pa.array([child[i] for child in children], pa.string()) for i in range(len(_CHILD))]
    ends = pa.array([0, *accumulate(map(len, items))], pa.int32())
    by_item = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, fields=list(_CHILD)))
    whole = pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), by_item)
    return pa.StructArray.from_arrays([pa.array([root], pa.string()), whole], fields=list(_PARSED))


@F.arrow_udf(from_arrow_type(_PARSED))
def parse_feed(payloads: pa.Array) -> pa.Array:
    """``root`` and ``items`` of every payload, null where it is no well-formed feed.

    Spark's own XML reader forgets the order of elements with different names, which
    decides between alternatives; nothing else is left to Python.  Payloads are turned
    into Arrow one by one, so the Python objects of one feed exist at a time.
    """
    done = [_column(p.as_py()) for p in payloads]
    return pa.concat_arrays(done) if done else pa.array([], _PARSED)


def child_texts(item: Column, *names: str) -> Column:
    """All non-empty texts of the children of these names, in document order."""
    found = F.filter(item, lambda c: c["name"].isin(*names) & (c["text"] != ""))
    return F.transform(found, lambda c: c["text"])


def child_text(item: Column, *names: str) -> Column:
    """First non-empty text among the children of these names, whichever comes first."""
    return text_or_empty(F.try_element_at(child_texts(item, *names), F.lit(1)))


def child_attributes(item: Column, name: str, attribute: str) -> Column:
    """Non-empty attributes of the children of one name, then trimmed, in document order."""
    found = F.filter(item, lambda c: (c["name"] == name) & (c[attribute] != ""))
    return F.transform(found, lambda c: strip_ends(c[attribute]))


def doi_from_id(entry_id: Column) -> Column:
    """DOI inside an entry id: everything after the resolver address."""
    return F.regexp_extract(entry_id, r"(?i)doi\.org/(.+)$", 1)


def _fields(i: Column) -> dict[str, dict[str, Column]]:
    """Columns of a record for each kind of feed."""
    empty = F.array().cast("array<string>")
    href = F.try_element_at(child_attributes(i, "link", "href"), F.lit(1))
    return {
        "rss": dict(
            link=child_text(i, "link"),
            published=child_text(i, "pubDate", "published", "date"),
            abstract=child_text(i, "description", "encoded", "summary"),
            doi=child_text(i, "identifier"),
            tags=child_texts(i, "category"),
            authors=empty,
        ),
        "RDF": dict(
            link=child_text(i, "link", "url"),
            published=child_text(i, "date", "published"),
            abstract=child_text(i, "encoded", "description", "summary"),
            doi=child_text(i, "doi", "identifier"),
            tags=child_texts(i, "subject", "category"),
            authors=child_texts(i, "creator"),
        ),
        "feed": dict(
            link=text_or_empty(F.coalesce(href, child_text(i, "link"))),
            published=child_text(i, "published", "updated", "date"),
            abstract=child_text(i, "summary", "content", "subtitle"),
            doi=text_or_empty(first_filled(child_text(i, "doi", "identifier"), doi_from_id(child_text(i, "id")))),
            tags=child_attributes(i, "category", "term"),
            authors=empty,
        ),
    }


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """``payloads`` plus ``feed``: the parsed payload, null where nothing could be read."""
    return small_batches(payloads).withColumn("feed", parse_feed("payload"))


def feed_records(parsed: DataFrame) -> DataFrame:
    """Records of parsed payloads, numbered by their position in the feed."""
    return feed_items(parsed).where("item_pos IS NOT NULL").select(*FEED_COLUMNS)


def feed_items(parsed: DataFrame) -> DataFrame:
    """The columns of ``parsed`` without ``feed``, and those of a record, one row per item.

    A payload without items keeps one row, whose ``item_pos`` is null; ``root`` tells a
    feed without items from what is no feed, and only the latter keeps its ``payload``.
    Feed and payload end behind a one-row generator: the optimizer would otherwise carry
    them along, and each row of a feed would hold a copy of the whole of it.
    """
    kept = [c for c in parsed.columns if c not in ("feed", "payload")]
    split = evaluate_once(
        parsed.withColumnRenamed("payload", "__whole"),
        root=F.col("feed.root"), items=F.col("feed.items"), payload=F.when(F.col("feed").isNull(), F.col("__whole")),
    )
    items = split.select(
        *kept, "root", "payload", F.col("url").alias("source_url"), F.posexplode_outer("items").alias("item_pos", "i")
    )
    i, root = F.col("i"), F.col("root")
    kinds = _fields(i)
    chosen = {
        name: F.when(root == "rss", kinds["rss"][name]).when(root == "RDF", kinds["RDF"][name]).otherwise(kinds["feed"][name])
        for name in kinds["rss"]
    }
    return items.withColumns(
        {"title": child_text(i, "title"), "article_type": child_text(i, "type"), **chosen}
    ).drop("i")


def read_feeds(payloads: DataFrame) -> DataFrame:
    """Records of all payloads, in one pass whatever their kinds."""
    return feed_records(parse_payloads(payloads))


def skip_front_matter(records: DataFrame, titles: Sequence[str] = FRONT_MATTER_TITLES) -> DataFrame:
    """Drop items whose title is on the list of things that are no articles."""
    return records.where(~F.lower(strip_ends(text_or_empty("title"))).isin(*titles))
