"""Time windows: filters, scheduled windows and window statistics.

The current time is always a parameter, so results repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from litsieve.functions.text import as_column


def in_window(time: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Both ends count; a missing end is open; a null time is outside."""
    test = time.isNotNull()
    if start is not None:
        test = test & (time >= start)
    if end is not None:
        test = test & (time <= end)
    return F.coalesce(test, F.lit(False))


def ingest_filter(
    records: DataFrame, time: Column, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Window at ingest: undated records pass."""
    return records.where(time.isNull() | in_window(time, start, end))


def window_filter(
    records: DataFrame, time: Column, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Window at normalization: undated records are dropped."""
    return records.where(in_window(time, start, end))


def scan_window(
    spark: SparkSession, path: str, start: Column | None = None, end: Column | None = None, undated: bool = False
) -> DataFrame:
    """Window over a table of ``sinks.write_ingested``; ``undated`` lets undated rows pass.

    The days prune folders, the times row groups and rows: no text outside of the window
    is read and nothing is parsed.
    """
    rows = spark.read.parquet(path)
    # Plain comparisons, which the scan can use; they leave undated rows out.
    inside = rows.where("published_day IS NOT NULL")
    for limit, test in ((start, lambda a, b: a >= b), (end, lambda a, b: a <= b)):
        if limit is not None:
            inside = inside.where(test(F.col("published_day"), F.to_date(limit)) & test(F.col("published_ts"), limit))
    return inside.unionByName(rows.where("published_day IS NULL")) if undated else inside


def observed_window(
    records: DataFrame, time: Column, start: Column | None = None, end: Column | None = None
) -> tuple[DataFrame, Observation]:
    """:func:`window_filter` that counts in its own pass.

    The observation has the counts of :func:`window_stats` once the filtered records have
    been written or read to the end.
    """
    seen = Observation()
    timed = records.withColumn("__time", time)
    inside = in_window(F.col("__time"), start, end)
    counted = timed.observe(seen, *_counts(F.col("__time"), inside))
    return counted.where(inside).drop("__time"), seen


def lookback_filter(
    records: DataFrame, time: Column, as_of: Column, hours: int, keep_undated: bool = False
) -> DataFrame:
    """Records of the last ``hours``, with no upper end."""
    recent = time >= as_of - F.make_dt_interval(hours=F.lit(hours))
    return records.where((recent | time.isNull()) if keep_undated else F.coalesce(recent, F.lit(False)))


def window_stats(
    records: DataFrame, time: Column, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """One row: total, inside, undated and outside counts."""
    timed = records.select(time.alias("time"))
    return timed.agg(*_counts(F.col("time"), in_window(F.col("time"), start, end)))


def _counts(time: Column, inside: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(inside).alias("n_inside"),
        F.count_if(time.isNull()).alias("n_undated"),
        F.count_if(time.isNotNull() & ~inside).alias("n_outside"),
    ]


def scheduled_window(now: Column | str, time_zone: str, delivery: str) -> tuple[Column, Column]:
    """Digest window of a run at ``now``.

    The end is the last local delivery time not after ``now``; the start is
    local midnight of the day before the end.
    """
    hour, minute = (int(part) for part in delivery.strip().split(":", 1))
    if not (0 <= hour <= 23 and 0 <= minute <= 59):
        raise ValueError(f"not a time of day: {delivery}")
    local = F.from_utc_timestamp(as_column(now), time_zone)
    day = F.date_trunc("day", local)
    today = day + F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))
    one_day = F.make_dt_interval(days=F.lit(1))
    end_day = F.when(local < today, day - one_day).otherwise(day)
    end_local = F.when(local < today, today - one_day).otherwise(today)
    return (
        F.to_utc_timestamp(end_day - one_day, time_zone),
        F.to_utc_timestamp(end_local, time_zone),
    )


def archive_date(window_end: Column | str, time_zone: str) -> Column:
    """Local calendar day of the window end."""
    return F.to_date(F.from_utc_timestamp(as_column(window_end), time_zone))


def digest_windows(
    events: DataFrame,
    time: str,
    length: str = "32 hours",
    step: str = "24 hours",
    offset: str = "16 hours",
) -> DataFrame:
    """Assign each row to every daily digest that covers it.

    Windows overlap, so a row may fall in two.  The end is exclusive.  The
    default offset puts midnight at UTC+8; zones with daylight saving need
    ``scheduled_window``.
    """
    return events.withColumn("digest", F.window(time, length, step, offset)).withColumns(
        {"window_start": F.col("digest.start"), "window_end": F.col("digest.end")}
    ).drop("digest")
