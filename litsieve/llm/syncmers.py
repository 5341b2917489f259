"""Document fingerprints from closed syncmers, with DataFrame operations only.

A k-mer is a run of words, its inner substrings are runs of fewer words.  A k-mer
is an anchor when the smallest hash among its inner substrings is that of the
first or the last one.  The choice looks at the k-mer alone, so a passage has the
same anchors wherever it stands and edits elsewhere move none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.llm.common import WORD, columns
from litsieve.operators.positions import with_rank
from litsieve.session import stored

K_WORDS = 5
INNER_WORDS = 2


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _with_inner(df: DataFrame, words: str, name: str) -> DataFrame:
    """Hash of every inner substring, by its place."""
    last = F.size(words) - INNER_WORDS
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(F.col(words), i + j) for j in range(INNER_WORDS)))
    )
    return df.withColumn(name, F.when(F.size(words) >= K_WORDS, hashes))


def _places(inner: str) -> Column:
    """Places of the k-mers whose smallest inner hash is at an edge."""
    span = K_WORDS - INNER_WORDS
    at = lambda i, j: F.get(F.col(inner), i + j)
    return F.filter(
        F.sequence(F.lit(0), F.size(inner) - span - 1),
        lambda i: F.least(at(i, 0), at(i, span)) <= F.least(*(at(i, j) for j in range(1, span))),
    )


def _hash(inner: str, i: Column) -> Column:
    return F.hash(*(F.get(F.col(inner), i + j) for j in range(K_WORDS - INNER_WORDS + 1)))


def anchors(docs: DataFrame) -> DataFrame:
    """``doc_id, anchors``: place (in words) and hash of every anchor of a text.

    A text of fewer than ``K_WORDS`` words has one anchor, the hash of all of them,
    at place 0.  Null texts and texts without words have none.
    """
    split = columns(docs, doc_id="long", text="string").select("doc_id", words_of(F.col("text")).alias("words"))
    inner = _with_inner(split, "words", "inner")
    found = F.transform(_places("inner"), lambda i: F.struct(i.alias("place"), _hash("inner", i).alias("hash")))
    whole = F.array(F.struct(F.lit(0).alias("place"), F.hash("words").alias("hash")))
    none = F.array().cast("array<struct<place: int, hash: int>>")
    return inner.select(
        "doc_id",
        F.when(F.coalesce(F.size("words"), F.lit(0)) < 1, none).when(F.size("words") < K_WORDS, whole).otherwise(found).alias("anchors"),
    )


def matched_anchors(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b, shift, n``: anchors that the texts of each pair share, by the shift of their places.

    A passage that both hold gives many anchors at one shift.
    """
    a = left.select(F.col("doc_id").alias("a"), F.explode("anchors").alias("l"))
    b = right.select(F.col("doc_id").alias("b"), F.explode("anchors").alias("r"))
    named = pairs.join(a, "a").join(b.withColumn("h", F.col("r.hash")), (F.col("l.hash") == F.col("h")) & (pairs["b"] == b["b"]))
    return named.groupBy("a", pairs["b"], (F.col("r.place") - F.col("l.place")).alias("shift")).agg(F.count(F.lit(1)).alias("n"))


def with_hashes(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the hashes of all anchors of a text, in the order of their places."""
    w, h = f"__{name}_words", f"__{name}_inner"
    inner = _with_inner(df.withColumn(w, words_of(F.col(text))), w, h)
    found = F.transform(_places(h), lambda i: _hash(h, i))
    whole = F.when(F.size(w) > 0, F.array(F.hash(w))).otherwise(F.array().cast("array<int>"))
    return inner.withColumn(name, F.when(F.size(w) >= K_WORDS, found).otherwise(whole)).drop(w, h)


def fingerprint(hashes: Column) -> Column:
    """Anchors as text: eight hexadecimal digits each."""
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(F.expr("4294967295L").bitwiseAND(x.cast("long"))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of all anchors of both texts, from 0 to 1.  Two texts without anchors are alike."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    In the edited text the last half of the code points is replaced by as many of
    the next document's first ones (ids ascending; after the last comes the first).
    Null texts count as empty.  A doc_id that repeats is one document, with the
    smallest of its texts.  A row without doc_id has no place in the order and takes
    no part.  Empty tables give no rows.

    Only ids and lengths are ordered.  Texts are shuffled once by id; what a
    document needs of the next one travels from there: the prefix and the anchors.
    """
    texts = columns(docs, doc_id="long", text="string").where("doc_id is not null").withColumn("text", F.coalesce("text", F.lit("")))
    sizes = texts.select("doc_id", F.char_length("text").cast("long").alias("n_chars"))
    ids = stored(sizes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("n_chars").alias("n_chars")))
    repeats = ids.where("rows > 1").limit(1).count() > 0
    if repeats:
        texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
        ids = stored(texts.select("doc_id", F.char_length("text").cast("long").alias("n_chars")))
    ranked = stored(with_rank(ids.select("doc_id", "n_chars"), [F.col("doc_id")], name="rank"))
    total = ranked.count()
    # The document that precedes each one, and how much of the text it borrows.
    owners = ranked.select(F.col("doc_id").alias("owner"), F.floor(F.col("n_chars") / 2).alias("half"), (F.col("rank") % F.lit(max(1, total)) + 1).alias("rank"))
    loans = stored(ranked.select("doc_id", "rank").join(owners, "rank").select("doc_id", "owner", "half"))
    own = with_hashes(texts.join(loans.select("doc_id", "owner", "half"), "doc_id"), "text", "hashes")
    lent = own.select(
        F.col("owner").alias("doc_id"),
        F.left("text", F.col("half").cast("int")).alias("borrowed"),
        F.col("hashes").alias("next_hashes"),
    )
    mine = own.select("doc_id", "text", "hashes")
    both = mine.join(lent, "doc_id")
    n = F.char_length("text")
    kept = n - F.floor(n / 2)
    edited = F.concat(F.left("text", kept.cast("int")), "borrowed")
    # A shorter next document replaces as much as it has; the rest of the half is gone.
    both = both.withColumn("edited", edited)
    both = with_hashes(both, "edited", "edited_hashes")
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("hashes")).alias("fingerprint"),
        fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
