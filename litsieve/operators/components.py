"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from litsieve.session import release, stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (a, b).

    Each round points the larger neighbours of every node at its smallest
    neighbour, then does the same with the smaller ones, until nothing changes.
    Long chains halve each round.  Neighbours are never gathered: minima combine
    before the shuffle, and the joins are plain equi-joins whose hot nodes Spark
    splits.  Every round is a stored table, so a lost executor costs a re-read;
    the table of the round before is deleted.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while True:
        # Large star: every larger neighbour of u goes to the smallest node around u.
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = around.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
        larger = stored(
            edges.join(lowest, F.col("b") == F.col("u"))
            .select("a", F.least("low", "u").alias("b"))
            .distinct()
        )
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = larger.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
        moved = larger.join(low, F.col("a") == F.col("u")).select("a", "b", "low")
        pairs = F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))))
        smaller = stored(moved.select(pairs.alias("e")).select("e.a", "e.b").where("a > b").distinct())
        # Done when every node has one smaller neighbour and that one has none.
        nodes = smaller.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        chained = smaller.select(F.col("b").alias("a")).distinct().join(smaller, "a", "left_semi").limit(1)
        open_nodes = nodes.where("n > 1").limit(1).select("a").unionByName(chained.select("a")).count()
        release(edges, larger)
        edges = smaller
        if not open_nodes:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
