"""Duplicate clusters kept up over micro-batches and runs.

The state is what union-find keeps: every key that a record can be found by points
at a label, the smallest ``seq`` of its cluster at that time, and a label that has
since been joined to a smaller one points at that.  A batch reads the keys and
labels it touches, finds the components of its own records and those labels, and
adds what is new.  Old keys and members are never read again or rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from litsieve.operators.components import connected_components
from litsieve.operators.dedupe import dedupe_candidates
from litsieve.session import release, stored
from litsieve.streaming.keyed import KeyedTable
from litsieve.streaming.runs import start_batches


def _keys(spark: SparkSession, folder: str) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/keys", "key", "key string, label long")


def _labels(spark: SparkSession, folder: str) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/labels", "label", "label long, parent long")


def _members(spark: SparkSession, folder: str) -> KeyedTable:
    # Two records may share a seq, so every row stays.
    return KeyedTable(spark, f"{folder}/members", "seq", "seq long, label long", smallest=False)


def find_roots(labels: DataFrame, joined: KeyedTable, before: int) -> DataFrame:
    """``label`` and ``root``, the label it has been joined to by earlier batches.

    Pointers lead to smaller labels, and each batch shortens those it follows, so
    there are few steps; each is a join of the labels still on their way.
    """
    at = stored(labels.select("label", F.col("label").alias("root")))
    while True:
        asked = at.select(F.col("root").alias("label")).distinct()
        step = stored(joined.find(asked, before).groupBy("label").agg(F.min("parent").alias("parent")))
        if step.isEmpty():
            release(step)
            return at
        moved = at.join(step.withColumnRenamed("label", "root"), "root", "left")
        further = stored(moved.select("label", F.coalesce("parent", "root").alias("root")))
        release(at, step)
        at = further


def resolve_batch(batch: DataFrame, folder: str, number: int, skip_empty_title: bool = False) -> None:
    """Add the records of one batch to the clusters in ``folder``."""
    spark = batch.sparkSession
    keys, joined, members = _keys(spark, folder), _labels(spark, folder), _members(spark, folder)
    pairs = stored(batch.select("seq", F.explode(dedupe_candidates(skip_empty_title)).alias("key")))
    known = stored(keys.find(pairs, number).groupBy("key").agg(F.min("label").alias("label")))
    roots = find_roots(known.select("label").distinct(), joined, number)
    first = pairs.groupBy("key").agg(F.min("seq").alias("other"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    old = known.join(roots, "label").select("key", F.col("root").alias("other"))
    links = pairs.join(first.unionByName(old), "key").where("seq <> other").select(F.col("seq").alias("a"), F.col("other").alias("b"))
    found = stored(connected_components(links))

    own = found.select(F.col("node").alias("seq"), "component")
    labelled = stored(pairs.join(own, "seq", "left").select("seq", "key", F.coalesce("component", "seq").alias("label")))
    alone = batch.select("seq").distinct().join(labelled.groupBy("seq").agg(F.min("label").alias("label")), "seq", "left")
    members.put(alone.select("seq", F.coalesce("label", "seq").alias("label")), number)
    fresh = labelled.join(known.select("key"), "key", "left_anti")
    keys.put(fresh.groupBy("key").agg(F.min("label").alias("label")), number)
    # Labels that were reached, or joined to a smaller one, point straight at their new root.
    ends = roots.join(found.select(F.col("node").alias("root"), "component"), "root", "left")
    shorter = ends.select(F.explode(F.array("label", "root")).alias("label"), F.coalesce("component", "root").alias("parent"))
    joined.put(shorter.where("label <> parent").distinct(), number)
    release(pairs, known, roots, found, labelled)


def start_resolution(normalized: DataFrame, folder: str, available_now: bool = True, skip_empty_title: bool = False) -> StreamingQuery:
    """Keep the clusters of a stream of normalized records in ``folder``.

    Whatever the order and the size of the batches, :func:`current_clusters` gives
    the clusters that one run over all records would give.
    """

    def handle(batch: DataFrame, number: int) -> None:
        resolve_batch(batch, folder, number, skip_empty_title)

    return start_batches(normalized, handle, f"{folder}/state", available_now)


def current_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """``seq`` and ``cluster`` of every record so far; the cluster is its smallest ``seq``."""
    pointers = _labels(spark, folder).rows().select(F.col("label").alias("a"), F.col("parent").alias("b"))
    roots = connected_components(pointers).select(F.col("node").alias("label"), F.col("component").alias("root"))
    members = _members(spark, folder).rows().select("seq", "label")
    return members.join(roots, "label", "left").select("seq", F.coalesce("root", "label").alias("cluster"))
