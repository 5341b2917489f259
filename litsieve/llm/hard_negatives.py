"""Hard negatives of every anchor and positive, by slot-decomposed selection.

A positive allows negatives up to a share of its own score.  The upper limits of an
anchor's positives cut the scores into disjoint slots, so a negative belongs to one
slot however many windows overlap there.  Tasks keep the best few of each slot, which
is all that any window can show of it, and the windows are answered from the slots at
and below their positive, merged in descending order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.llm.common import columns
from litsieve.session import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
ROW_BLOCK = 2048
ANCHOR_BLOCK = 512
# Blocks of rows are dealt to this many shards, or as many as keep a shard at so many blocks.
SHARDS = 64
SHARD_BLOCKS = 32
# Products whose sums stay below this are exact in doubles and leave room for a row number.
EXACT = 1 << 50
LONG = (1 << 63) - 1
ROW = "struct<vec_id: long, label: long, v: array<long>>"


def _matrix(values: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(values.flatten(), np.int64).reshape(-1, dim)


def _keys(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Per anchor and row: inner product times the number of rows, plus the rows behind it.

    Larger keys come first in the order by score and, as rows are sorted by id, by
    smaller id; no two are equal.  Products too large for doubles are Python integers.
    """
    n, dim = rows.shape
    most = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (rows, anchors)]
    if most[0] * most[1] * dim < EXACT:
        scores = (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    else:
        scores = np.array([[sum(map(int.__mul__, a, r)) for r in rows.tolist()] for a in anchors.tolist()], object)
        scores = scores.reshape(len(anchors), n)
    return scores * n + np.arange(n - 1, -1, -1)


def _best(keys: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """Anchor, row and score of the ``k`` best allowed rows of each anchor."""
    n = keys.shape[1]
    nothing = -LONG - 1 if keys.dtype == np.int64 else -(1 << 200)
    keys = np.where(allowed, keys, nothing)
    if keys.dtype == np.int64 and n > k:
        keys = np.partition(keys, n - k, axis=1)[:, n - k :]
    else:
        keys = np.sort(keys, axis=1)[:, max(0, n - k) :]
    for anchor, place in zip(*np.nonzero(keys > nothing)):
        score, behind = divmod(int(keys[anchor, place]), n)
        yield int(anchor), n - 1 - behind, max(-LONG - 1, min(score, LONG))


def _blocks(batch: pa.RecordBatch, name: str, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Ids, labels, vectors and the other fields of a block, by id."""
    entries = batch.column(name)[at].values
    ids = np.asarray(entries.field("vec_id"))
    order = np.argsort(ids, kind="stable")
    entries = entries.take(pa.array(order))
    vectors = entries.field("v")
    return ids[order], np.asarray(entries.field("label")), _matrix(vectors, len(vectors[0])), entries


def _table(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    whole = zip(*found) if found else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in whole], names=names)


def _positives(k: int):
    """The best ``k`` other rows of a block, for each anchor of a block; both have one label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                anchor_ids, _, anchors, _ = _blocks(batch, "anchors", at)
                ids, _, rows, _ = _blocks(batch, "rows", at)
                best = _best(_keys(rows, anchors), anchor_ids[:, None] != ids, k)
                found = [(int(anchor_ids[a]), int(ids[r]), score) for a, r, score in best]
                yield _table(found, ["anchor_id", "vec_id", "score"])

    return run


def limits(score: int, lowest: int, highest: int) -> tuple[int, int]:
    """Smallest and largest score with lowest * score <= 100 * it <= highest * score."""
    return -(-lowest * score // 100), highest * score // 100


def _negatives(k: int, lowest: int, highest: int):
    """The best ``k`` rows of a block in each slot of each anchor of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                anchor_ids, anchor_labels, anchors, entries = _blocks(batch, "anchors", at)
                ids, labels, rows, _ = _blocks(batch, "rows", at)
                keys, n = _keys(rows, anchors), len(ids)
                other = anchor_labels[:, None] != labels
                windows = [[limits(s, lowest, highest) for s in own] for own in entries.field("positives").to_pylist()]
                # A slot ends above the next upper limit; the last one at the least score of any window.
                least = [min([low for low, high in own if low <= high], default=LONG) for own in windows]
                found = []
                for slot in range(max(map(len, windows), default=0)):
                    tops = [own[slot][1] if slot < len(own) else -LONG for own in windows]
                    floors = [own[slot + 1][1] + 1 if slot + 1 < len(own) else low for own, low in zip(windows, least)]
                    floors = [max(pair) for pair in zip(floors, least)]
                    # Key limits: the last key of the upper and the first key of the lower score.
                    ends = [[min(max(x, -LONG // n), LONG // n) if keys.dtype == np.int64 else x for x in side] for side in (tops, floors)]
                    top, floor = (np.array(side, keys.dtype)[:, None] for side in ends)
                    inside = other & (keys <= top * n + (n - 1)) & (keys >= floor * n)
                    found += [(int(anchor_ids[a]), slot, int(ids[r]), score) for a, r, score in _best(keys, inside, k)]
                yield _table(found, ["anchor_id", "slot", "vec_id", "score"])

    return run


def _usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False)) & (F.size(embedding) > 0)


def scaled_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, components as floor(scale * x)."""
    whole = columns(vectors, vec_id="long", label="long", embedding="array<double>")
    usable = whole.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("embedding")))
    v = F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    one = usable.select("vec_id", F.struct("label", v.alias("v")).alias("r")).groupBy("vec_id").agg(F.min("r").alias("r"))
    rows = one.select("vec_id", "r.label", "r.v")
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    return rows.where(F.size("v") == length.select("d").scalar())


def _in_blocks(rows: DataFrame, groups: list[str], size: int, name: str, *fields: str) -> DataFrame:
    """Rows of each group gathered into blocks of about ``size``."""
    counts = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
    part = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("__n") / size))
    sized = rows.join(counts, groups) if groups else rows.withColumn("__n", counts.scalar())
    return sized.groupBy(*groups, part.alias("__part")).agg(F.collect_list(F.struct("vec_id", "label", "v", *fields)).alias(name))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    k: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has vec_id, label and embedding; ``anchors`` is a condition on vec_id.
    A score is the inner product of floor(scale * x) of the components, exact in
    integers; scores that a long cannot hold become its nearest value, from which
    windows are then taken.  Higher scores come first, ties go to the smaller vec_id.  An anchor's positives are its first
    rows of the same label, and each positive gets the first ``k`` rows of other
    labels between ``lowest`` and ``highest`` hundredths of its score.  An anchor
    without positives, and a positive without negatives, have no row.

    Rows with a null vec_id, label or vector, an empty vector, a null or non-finite
    component, or a length that is not the most frequent one (the larger of equally
    frequent ones) take no part.  Repeated rows count once; of different rows of one
    vec_id the one of smallest label, then vector, counts.  Empty tables give no rows.

    Anchors meet the rows block against block: rows are cut into blocks of about 2,048,
    these are dealt to 64 shards (of at most 32 blocks, else to more), and blocks of
    anchors are repeated once per shard.  A label that a third of
    the rows share is many blocks, and at most ``k`` rows of each slot leave a task.
    """
    rows = stored(scaled_vectors(vectors, scale))
    asked = rows.where(anchors)
    same = _in_blocks(asked, ["label"], ANCHOR_BLOCK, "anchors").join(_in_blocks(rows, ["label"], ROW_BLOCK, "rows"), "label")
    near = same.select("anchors", "rows").mapInArrow(_positives(positives), "anchor_id long, vec_id long, score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives)
    order = F.struct(F.col("n"), F.col("vec_id"), F.col("score"))
    listed = stored(chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(order)).alias("positives")))

    ready = asked.join(listed, asked["vec_id"] == listed["anchor_id"]).select("vec_id", "label", "v", F.col("positives.score").alias("positives"))
    row_blocks = stored(_in_blocks(rows, [], ROW_BLOCK, "rows"))
    anchor_blocks = _in_blocks(ready, [], ANCHOR_BLOCK, "anchors", "positives").drop("__part")
    # One copy of every block of anchors for each shard of row blocks, by number.
    last = row_blocks.agg(F.max("__part")).first()[0] or 0
    shards = max(SHARDS, -(-(last + 1) // SHARD_BLOCKS))
    sharded = row_blocks.withColumn("__shard", F.col("__part") % shards)
    spread = anchor_blocks.withColumn("__shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(min(last, shards - 1)).cast("long"))))
    # Sizes are estimated before the copies are made, so a join by estimate could send all copies through the driver.
    met = spread.join(sharded.hint("shuffle_hash"), "__shard").select("anchors", "rows")
    found = met.mapInArrow(_negatives(k, lowest, highest), "anchor_id long, slot long, vec_id long, score long")
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    entry = F.struct("slot", F.col("n"), F.col("vec_id"), F.col("score"))
    slots = kept.groupBy("anchor_id").agg(F.sort_array(F.collect_list(entry)).alias("slots"))

    # Slots come in descending order of their scores, so a window is a run of them from its positive's slot on.
    windows = listed.join(slots, "anchor_id").select("anchor_id", "slots", F.posexplode("positives").alias("slot", "p"))
    below = F.filter("slots", lambda s: (s["slot"] >= F.col("slot")) & (s["score"] >= F.ceil(F.col("p.score").cast("decimal(38,0)") * lowest / 100)))
    return windows.select("anchor_id", "p", F.posexplode(F.slice(below, 1, k)).alias("at", "s")).select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("s.vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("s.score").alias("negative_score"),
    )


ORACLE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
