"""Approximate nearest neighbours with an inverted multi-index.

The two halves of a vector are quantised separately; a cell is a pair of
centroids.  A query walks the pairs by summed distance with a heap until the
cells hold its share of the vectors, and the entries of those cells are reranked
by exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.llm.common import columns
from litsieve.session import stored

CENTROIDS = 32
SAMPLE = 20_000  # vectors the centroids are fitted on, at most
ROUNDS = 12
NEIGHBOURS = 10
# Share of the different vectors that a query's cells hold at least; set for a recall
# above 0.95 on vectors without much structure.
SHARE = 0.6
ENTRY_BLOCK = 256
QUERY_BLOCK = 64


def _kmeans(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids of a bounded sample, from spread-out points of its own."""
    rng = np.random.default_rng(0)
    centers = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _distances(points, centers).argmin(axis=1)
        count = np.bincount(near, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, near, points)
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centers)
    return centers


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant of each point."""
    return (centers**2).sum(axis=1) - 2 * points @ centers.T


def fit_centroids(vectors: DataFrame, dim: int, centroids: int = CENTROIDS, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of both halves, fitted on the ``sample`` vectors of smallest hash."""
    taken = vectors.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(sample).toArrow()
    points = _matrix(taken.column("embedding").combine_chunks(), dim)
    half = dim // 2
    if not len(points):
        return np.zeros((1, half)), np.zeros((1, dim - half))
    return _kmeans(points[:, :half], centroids), _kmeans(points[:, half:], centroids)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def _assign(first: np.ndarray, second: np.ndarray, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("embedding"), dim)
            half = dim // 2
            cell = _distances(points[:, :half], first).argmin(axis=1) * len(second) + _distances(points[:, half:], second).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=[*batch.schema.names, "cell"])

    return run


def _walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> list[int]:
    """Filled cells by summed distance of their two centroids, until they hold ``wanted`` vectors."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap, seen, cells, got = [(x[0] + y[0], 0, 0)], {(0, 0)}, [], 0
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(y) + int(b[j])
        if counts[cell]:
            cells.append(cell)
            got += counts[cell]
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(x) and q < len(y) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (x[p] + y[q], p, q))
    return cells


def _probes(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, half = _matrix(batch.column("embedding"), dim), dim // 2
            one, two = _distances(points[:, :half], first), _distances(points[:, half:], second)
            cells = [_walk(d, e, counts, wanted) for d, e in zip(one, two)]
            rows = pa.array(np.repeat(np.arange(len(cells)), [len(c) for c in cells]), pa.int64())
            flat = pa.array([c for own in cells for c in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(rows), batch.column("embedding").take(rows), flat], names=["query_id", "embedding", "cell"]
            )

    return run


def _rerank(dim: int, k: int):
    """The k nearest members of a block of entries, for each of a block of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for row in range(batch.num_rows):
                queries, ids = (batch.column("queries")[row].values.field(i) for i in (0, 1)), None
                query_ids, query_vectors = queries
                entries = batch.column("entries")[row].values
                vectors, members = _matrix(entries.field(0), dim), entries.field(1)
                offsets = np.asarray(members.offsets)[: len(members) + 1]
                ids = np.asarray(members.values)
                owner = np.repeat(np.arange(len(members)), np.diff(offsets))
                ids = ids[offsets[0] : offsets[-1]]
                for query_id, query in zip(np.asarray(query_ids), _matrix(query_vectors, dim)):
                    distance = np.sqrt(((vectors - query) ** 2).sum(axis=1))[owner]
                    other = ids != query_id
                    best = np.lexsort((ids[other], distance[other]))[:k]
                    out[0] += [query_id] * len(best)
                    out[1].append(ids[other][best])
                    out[2].append(distance[other][best])
            names = ["query_id", "vec_id", "score"]
            flat = [np.array(out[0], np.int64), *(np.concatenate(x) if x else np.empty(0) for x in out[1:])]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in zip(flat, kinds)], names=names)

    return run


def _usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    centroids: int = CENTROIDS,
    share: float = SHARE,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for every query, nearest first.

    ``vectors`` and ``queries`` have vec_id and embedding; a query is no candidate of
    its own.  The score is the Euclidean distance in double precision; ties go to the
    smaller vec_id.  All vectors are indexed; the centroids are fitted on a bounded
    sample.  Equal vectors are one entry with their ``k + 1`` smallest ids, which is
    all that a list of k can show of them, so a vector that a third of the rows share
    is one entry.  Cells are cut into blocks of entries and their queries into blocks
    of queries; a cell of any size is many small join rows.

    Null and zero vectors and vectors with null or non-finite components take no part,
    nor do rows without vec_id or vectors whose length is not the most frequent one
    (the larger of equally frequent ones).  Repeated rows count once.  Empty tables
    give no rows.
    """
    kind = "array<double>"
    usable = columns(vectors, vec_id="long", embedding=kind).where(_usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    length = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dim = length[0]["d"] if length else 1
    usable = usable.where(F.size("embedding") == dim)
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    first = usable.distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    entries = first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries)
    one, two = fit_centroids(entries, dim, centroids, sample)
    indexed = stored(entries.mapInArrow(_assign(one, two, dim), "embedding array<double>, ids array<long>, cell long"))
    # One row per filled cell: at most centroids squared.
    filled = indexed.groupBy("cell").count().toArrow()
    counts = np.zeros(len(one) * len(two), np.int64)
    counts[np.asarray(filled.column("cell"))] = np.asarray(filled.column("count"))
    wanted = max(share * counts.sum(), k + 1)

    block = F.pmod(F.xxhash64("embedding"), F.ceil(F.col("count") / ENTRY_BLOCK))
    sized = indexed.join(indexed.groupBy("cell").count(), "cell")
    entry_blocks = sized.groupBy("cell", block.alias("block")).agg(F.collect_list(F.struct("embedding", "ids")).alias("entries")).drop("block")
    asked = columns(queries, vec_id="long", embedding=kind).where(_usable(F.col("embedding")) & (F.size("embedding") == dim) & F.col("vec_id").isNotNull())
    asked = asked.select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    probes = stored(asked.mapInArrow(_probes(one, two, counts, wanted, dim), "query_id long, embedding array<double>, cell long"))
    probes = probes.join(probes.groupBy("cell").count(), "cell")
    part = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("count") / QUERY_BLOCK))
    query_blocks = probes.groupBy("cell", part.alias("part")).agg(F.collect_list(F.struct("query_id", "embedding")).alias("queries")).drop("part")
    found = query_blocks.join(entry_blocks, "cell").select("queries", "entries").mapInArrow(_rerank(dim, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
