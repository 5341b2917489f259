"""Source selection and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def select_sources(sources: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Enabled sources, optionally only the given ids."""
    chosen = sources.where(F.col("enabled"))
    return chosen.where(F.col("source_id").isin(*ids)) if ids else chosen


def source_locators(sources: DataFrame) -> DataFrame:
    """One row per source and address; sources without an address disappear."""
    return sources.select("*", F.posexplode("source_locator").alias("locator_pos", "url"))


# A registry part of up to so many rows and characters goes to every task.
SMALL_ROWS = 10_000
SMALL_CHARS = 4 << 20
SALTS = 32


def _small(rows: DataFrame) -> list | None:
    """The rows, if they are few and short; a row more than the bound is read at most."""
    found = rows.limit(SMALL_ROWS + 1).collect()
    chars = sum(len(str(value)) for row in found for value in row)
    return found if len(found) <= SMALL_ROWS and chars <= SMALL_CHARS else None


def enrich(records: DataFrame, sources: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join to the registry that leaves the records where they are.

    A registry within the bounds above is sent to every task.  Of a larger one only the
    sources that occur are looked at: their ids are read from one column of the records.
    Where even those are too many, the records meet the registry by source and a salt of
    their ``seq``, so a source with a third of the records is spread over many tasks.
    """
    spark = records.sparkSession
    wanted = sources.select("source_id", *columns)
    small = _small(wanted)
    if small is None and not records.isStreaming:
        wanted = wanted.join(records.select("source_id").distinct(), "source_id", "left_semi")
        small = _small(wanted)
    if small is not None:
        return records.join(F.broadcast(spark.createDataFrame(small, wanted.schema)), "source_id", "left")
    if records.isStreaming:
        return records.join(wanted, "source_id", "left")
    salted = records.withColumn("__salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)))
    copies = wanted.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["source_id", "__salt"], "left").drop("__salt")
