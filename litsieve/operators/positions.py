"""Exact positions and running sums without one task for everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.session import stored


def with_rank(
    rows: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    name: str = "rank",
    ranges: int | None = None,
    keep: bool = False,
) -> DataFrame:
    """``rows`` plus their exact row number (from 1) within ``groups``.

    One pass: the rows are range-partitioned and sorted by groups and order,
    stored with their place inside their range, and shifted by the rows of the
    same group in earlier ranges.  A group that holds a third of the rows is
    spread over a third of the ranges.  The shifts are one row per group and
    range.  ``order`` should end in something unique.

    The partitioner samples the keys before it sorts, which computes ``rows`` twice;
    ``keep`` stores them first, for rows that are a long chain and no table.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__o{i}" for i in range(len(order))]
    keyed = rows.select("*", *(column.alias(key) for key, column in zip(keys, order)))
    if keep:
        keyed = stored(keyed)
    by = [F.col(c) for c in (*groups, *keys)]
    # The place inside a sorted range is the low part of the id, the range its high part.
    placed = stored(
        keyed.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("__id", F.monotonically_increasing_id())
        .drop(*keys)
    ).withColumn("__range", F.shiftright("__id", 33))
    group = F.struct(F.col("__range"), *groups)
    before = Window.partitionBy(*(f"__g.{g}" for g in groups)).orderBy("__g.__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(group.alias("__g"))
        .agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .select("__g", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    )
    # Group values travel in a struct, so null groups find their shift too.
    return (
        placed.withColumn("__g", group)
        .join(shifts, "__g")
        .withColumn(name, F.col("__id") + F.col("__shift") + 1)
        .drop("__g", "__id", "__range", "__shift")
    )


def with_running_sum(
    rows: DataFrame,
    measure: str,
    order: Sequence[str],
    groups: Sequence[str],
    name: str = "start",
    buckets: int = 256,
) -> DataFrame:
    """``rows`` plus the sum of ``measure`` over the rows before them in their group.

    The order inside a group is by hash bucket, then ``order``: any fixed order
    does where rows only need disjoint intervals.  Each group and bucket is one
    window partition, so a hot group is spread over ``buckets`` of them.  ``rows``
    is read twice and should be stored.
    """
    cut = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    group = F.struct(F.col("__bucket"), *groups)
    cut = cut.withColumn("__g", group)
    before = Window.partitionBy(*(f"__g.{g}" for g in groups)).orderBy("__g.__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        cut.groupBy("__g")
        .agg(F.sum(measure).alias("__n"))
        .select("__g", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    )
    inside = Window.partitionBy("__g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("__before", F.coalesce(F.sum(measure).over(inside), F.lit(0)))
        .join(bases, "__g")
        .withColumn(name, F.col("__base") + F.col("__before"))
        .drop("__g", "__bucket", "__base", "__before")
    )
