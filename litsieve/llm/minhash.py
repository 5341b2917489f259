"""Near duplicates by min-max hashing.

Each permutation gives two signature values, its smallest and its largest hash,
so half the hash evaluations fill the same signature.  Bands of the signature
find candidates; every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from litsieve.llm.bloom import build_filter, may_be_listed
from litsieve.llm.common import memory_returned, mixed, shingles, text_bytes, texts as text_rows, worker_value
from litsieve.operators.components import connected_components
from litsieve.session import release, stored

SHINGLE_WORDS = 5
BANDS = 32
BAND_PERMUTATIONS = 4  # two values each, so a band has eight rows
SEED = 20240229
# Members of a group that are compared in one piece.
BLOCK = 256
# A candidate between groups needs this much less than the threshold by its signature:
# the 256 values have a standard deviation of 0.022 at 0.85.
SIGNATURE_SLACK = 0.13

FEATURES = "doc_id long, n_shingles long, set_key binary, signature binary"


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    return worker_value("permutations", _drawn_permutations, small=True)


def _drawn_permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = BANDS * BAND_PERMUTATIONS
    return rng.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def min_max_signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the hashes under each permutation, as 16-bit values.

    Two sets agree in one value with about the probability of their Jaccard
    similarity, for minima and maxima alike.
    """
    factor, shift = _permutations()
    low = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factor), np.uint64)
    for at in range(0, len(hashes), 1024):
        values = factor[:, None] * hashes[None, at : at + 1024] + shift[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    # Extremes share their top bits, so sixteen bits are taken after mixing.
    return (mixed(np.stack([low, high], axis=1).ravel()) >> np.uint64(48)).astype(np.uint16)


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for data in text_bytes(batch):
                found = shingles(data, width)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(min_max_signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    return run


def features(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Set size, 128-bit key of the set and signature of every text."""
    return text_rows(docs, doc_id="long", text="string").mapInArrow(memory_returned(_features(width)), FEATURES)


def _band_keys(classes: DataFrame) -> DataFrame:
    """One row per class and band, named by a hash of the band's sixteen bytes."""
    size = 2 * 2 * BAND_PERMUTATIONS
    bands = F.array(
        *(F.xxhash64(F.lit(i), F.substring("signature", i * size + 1, size)) for i in range(BANDS))
    )
    return classes.select("rep", F.posexplode(bands).alias("band_no", "band"))


def _confirm(threshold: tuple[int, int], width: int):
    numerator, denominator = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_set = None, None
        for batch in batches:
            keep = []
            centers = batch.column("b").to_pylist()
            for i, (left, right) in enumerate(zip(text_bytes(batch, "text_a"), text_bytes(batch, "text_b"))):
                if centers[i] != held:
                    held, held_set = centers[i], shingles(right, width)
                own = shingles(left, width)
                shared = len(np.intersect1d(own, held_set, assume_unique=True))
                union = len(own) + len(held_set) - shared
                if denominator * shared >= numerator * union:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, threshold: tuple[int, int], width: int = SHINGLE_WORDS) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold.

    Texts are joined to the pairs one side after the other; the members travel to
    their partner b, whose set is then built once per run of rows.
    """
    texts = text_rows(docs, doc_id="long", text="string")
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(memory_returned(_confirm(threshold, width)), "a long, b long")


def _linked(threshold: tuple[int, int], width: int):
    """Links between different components within each block pair.

    Signatures rule out most pairs; the full sets of the rest are compared here, so
    only links leave the task.  A pair is left to the first band that it shares.
    """
    numerator, denominator = threshold
    limit = numerator / denominator - SIGNATURE_SLACK

    def links_of(rows, texts) -> list[tuple[int, int]]:
        rep, component, side, band, sizes, signature = rows
        first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        sets: dict[int, np.ndarray] = {}

        def full(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingles(texts[row].as_py(), width)
            return sets[row]

        found = []
        for row in first:
            others = second[(component[second] != component[row]) & ((side[row] != 2) | (rep[second] < rep[row]))]
            ratio = np.minimum(sizes[others], sizes[row]) / np.maximum(sizes[others], sizes[row])
            others = others[denominator * ratio >= numerator * (1 - 1e-9)]
            if not len(others):
                continue
            agree = signature[others] == signature[row]
            shared = agree.reshape(len(others), BANDS, -1).all(axis=2).argmax(axis=1)
            for other in others[(agree.mean(axis=1) >= limit) & (shared == band[row])]:
                both = len(np.intersect1d(full(row), full(other), assume_unique=True))
                if denominator * both >= numerator * (sizes[row] + sizes[other] - both):
                    found.append((max(rep[row], rep[other]), min(rep[row], rep[other])))
        return found

    def groups(table_: pa.Table) -> pa.RecordBatch:
        keys = np.asarray(table_.column("key"))
        values = [np.asarray(table_.column(c)) for c in ("rep", "component", "side", "band_no", "n_shingles")]
        signature = np.frombuffer(b"".join(table_.column("signature").to_pylist()), np.uint16).reshape(len(keys), 2 * BANDS * BAND_PERMUTATIONS)
        texts = table_.column("text").cast(pa.binary())
        bounds = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else [0]
        found = []
        for low, high in zip(bounds[:-1], bounds[1:]):
            found += links_of((*(v[low:high] for v in values), signature[low:high]), texts[low:high])
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by key; a group may go on in the next batch.
        rest: pa.Table | None = None
        for batch in batches:
            table_ = pa.Table.from_batches([batch])
            table_ = pa.concat_tables([rest, table_]) if rest is not None else table_
            keys = np.asarray(table_.column("key"))
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            rest = table_.slice(cut)
            yield groups(table_.slice(0, cut))
        if rest is not None:
            yield groups(rest)

    return run


def _leftover_links(
    members: DataFrame, classes: DataFrame, texts: DataFrame, components: DataFrame, threshold: tuple[int, int], width: int
) -> DataFrame:
    """Links between different components of one bucket.

    The first round has compared every member with the smallest one, so buckets
    that are one component by now are done.  Of the others, each member meets the
    members of other components, block against block: a bucket of any size is cut
    into blocks, and no task holds more than two blocks of a bucket.
    """
    labelled = members.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "band_no", "rep", F.coalesce("component", "rep").alias("component")
    )
    several = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
        # Two members: their only pair has been tested.
        .where("low < high and n > 2")
        .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    cut = labelled.join(several, "band").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(
            F.xxhash64("band", F.least(x, "block"), F.greatest(x, "block")).alias("key"),
            F.when(x == F.col("block"), 2).when(x > F.col("block"), 0).otherwise(1).alias("side"),
        ),
    )
    rows = (
        cut.select("rep", "component", "band_no", F.inline(others))
        .join(classes.select("rep", "n_shingles", "signature"), "rep")
        .join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(parts, "key")
        .sortWithinPartitions("key")
        .select("key", "rep", "component", "side", "band_no", "n_shingles", "signature", "text")
        .mapInArrow(memory_returned(_linked(threshold, width)), "a long, b long")
    )


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = (80, 100), width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Documents are linked when the Jaccard similarity of their sets of ``width``
    lower-cased words is at least the threshold (a fraction of integers), and
    ``component_id`` is the smallest document reachable over links.  ``kept`` marks
    one document per component.  Copies of one set count as one class from the
    start, so a group of a million copies is one row in all later steps.

    Null and empty texts have no shingles and are linked with nothing.  A doc_id
    that repeats is one document with several texts; a row without doc_id cannot
    be named in a result and takes no part.  Empty tables give an empty result.
    """
    docs = text_rows(docs, doc_id="long", text="string").where("doc_id is not null")
    found = stored(features(docs, width))
    classes = stored(
        found.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    # A different set misses or adds a shingle at least: n of n + 1 must reach the threshold.
    numerator, denominator = threshold
    apart = classes.where(denominator * F.col("n_shingles") >= numerator * (F.col("n_shingles") + 1))
    keys = stored(_band_keys(apart))
    buckets = keys.groupBy("band").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(keys.join(buckets, "band").select("band", "band_no", "rep", "center"))
    release(keys)
    # Only texts that meet another one at all travel in the comparisons below.
    involved = stored(members.select(F.col("rep").alias("doc_id")).distinct())
    # A filter of bounded size keeps most other texts out of the shuffle.
    probe = may_be_listed(docs.sparkSession, build_filter(involved, "doc_id"))
    texts = stored(docs.where(probe(F.xxhash64("doc_id"))).join(involved, "doc_id", "left_semi"))
    star = members.where("rep > center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    links = stored(confirmed(star, texts, threshold, width))
    components = stored(connected_components(links))
    more = _leftover_links(members, apart, texts, components, threshold, width)
    links = stored(links.unionByName(more))
    release(texts, members)
    # A document whose repeated rows have several sets ties those classes together.
    owners = found.join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep").distinct()
    ties = owners.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    repeated = owners.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    joined = links.unionByName(ties.join(repeated, F.col("a") == F.col("doc_id"), "left_semi").select("a", "b"))
    components = connected_components(joined)
    reached = owners.join(components.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "rep")).alias("component")
    )
    sized = found.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    return sized.join(reached, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce("component", "doc_id") == F.col("doc_id")).alias("kept"),
    )
