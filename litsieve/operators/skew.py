"""Ranks, first rows and counts that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.operators.positions import with_rank


def rank_rows(
    rows: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    row_id: str = "seq",
    name: str = "rank",
    ranges: int | None = None,
    keep: bool = True,
) -> DataFrame:
    """Exact row numbers within ``groups`` (none: over everything).

    Returns ``row_id``, the groups and the rank.  ``order`` sorts ascending and
    must end in something unique.  Only these narrow columns are stored and sorted, in
    one range-partitioned pass; ``keep=False`` is for rows that are a stored table.
    """
    columns = [f"o{i}" for i in range(len(order))]
    keys = rows.select(row_id, *groups, *(column.alias(c) for column, c in zip(order, columns)))
    ranked = with_rank(keys, [F.col(c) for c in columns], groups, name, ranges, keep)
    return ranked.select(row_id, *groups, name)


def sort_position(seq: str, pos: str | None = None, part: str | None = None) -> Column:
    """Order of appearance as one number: part, then record, then place in the record.

    A number keeps the minimum in a hash aggregate; a struct would force a sort
    of all rows first.  ``pos`` is below 10^9 and ``part`` is a single digit.
    """
    if pos is None and part is None:
        return F.col(seq)
    place = F.col(seq).cast("decimal(19,0)") * F.lit(10**9).cast("decimal(10,0)")
    if pos is not None:
        place = place + F.col(pos).cast("decimal(10,0)")
    if part is not None:
        place = place + F.col(part).cast("decimal(1,0)") * F.lit("1" + "0" * 30).cast("decimal(31,0)")
    return place.cast("decimal(38,0)")


def top_counts(
    rows: DataFrame, key: str, position: Sequence[str], limit: int, count: str = "n"
) -> DataFrame:
    """Most frequent values; ties go to the value seen first.

    Counting and first positions combine before the shuffle; the limit is a
    top-k over the aggregated values.
    """
    return (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count), F.min(sort_position(*position)).alias("first_seen"))
        .orderBy(F.desc(count), "first_seen")
        .limit(limit)
    )


def first_rows(rows: DataFrame, order: Sequence[str], limit: int, groups: Sequence[str] = ()) -> DataFrame:
    """First ``limit`` rows of each group with their position ``item``.

    The rank filter becomes a group limit ahead of the shuffle.
    """
    if not groups:
        # A top-k leaves ``limit`` rows, which one task then numbers.
        rows = rows.orderBy(*order).limit(limit)
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn("item", F.row_number().over(window)).where(F.col("item") <= limit)


# Keys that a task holds before it passes its counts on.
HELD_KEYS = 100_000


def _combined(k: int, places: int):
    """Count and ``k`` smallest places of every key of a task."""
    names = [f"o{i}" for i in range(places)]
    entry = pa.struct([*((n, pa.int64()) for n in names), ("shown", pa.string())])

    def batch_of(held: dict) -> pa.RecordBatch:
        firsts = [[dict(zip([*names, "shown"], e)) for e in first] for _, first in held.values()]
        arrays = [pa.array(held, pa.string()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array(firsts, pa.list_(entry))]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "n", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = pc.dictionary_encode(batch.column("key"))
            codes = np.asarray(keys.indices)
            columns = [np.asarray(batch.column(n)) for n in names]
            order = np.lexsort((*reversed(columns), codes))
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            ends = np.append(starts[1:], len(order))
            words = keys.dictionary.to_pylist()
            for low, high in zip(starts.tolist(), ends.tolist()):
                rows = order[low : min(low + k, high)]
                shown = batch.column("shown").take(pa.array(rows)).to_pylist()
                found = list(zip(*(c[rows].tolist() for c in columns), shown))
                n, first = held.get(word := words[codes[order[low]]], (0, []))
                held[word] = n + high - low, sorted([*first, *found], key=lambda e: e[:places])[:k]
            if len(held) > HELD_KEYS:
                yield batch_of(held)
                held = {}
        yield batch_of(held)

    return run


def counts_with_first(rows: DataFrame, key: str, order: Sequence[str], k: int, shown: str | None = None) -> DataFrame:
    """``key``, ``n`` and ``first``: how often each key occurs and its ``k`` first rows.

    One pass: a task keeps a count and ``k`` entries per key and passes on that alone,
    so neither a common key nor its rows are shuffled or stored.  ``order`` names up to
    three integer columns; ``first`` is a sorted list of structs of them (o0, o1, ..)
    and ``shown``, a text to show.  Keys are not null.
    """
    places = [F.col(c).cast("long").alias(f"o{i}") for i, c in enumerate(order)]
    narrow = rows.select(F.col(key).alias("key"), *places, (F.col(shown) if shown else F.lit(None)).cast("string").alias("shown"))
    entry = ", ".join([*(f"o{i}: long" for i in range(len(order))), "shown: string"])
    parts = narrow.mapInArrow(_combined(k, len(order)), f"key string, n long, first array<struct<{entry}>>")
    # One list of at most k entries from each task.
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, k)
    return parts.groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("n"), merged.alias("first"))
