"""Incremental runs with Structured Streaming.

``available_now`` drains what has landed and stops, which is the scheduled
daily run; leave it off for a run that keeps going.  Progress lives in the
checkpoint folder, so a record is processed once across runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from litsieve.config import DigestRules
from litsieve.functions.dates import parse_datetime
from litsieve.operators.classify import classify
from litsieve.operators.dedupe import dedupe_key
from litsieve.operators.normalize import normalize_records
from litsieve.operators.relevance import filter_relevance
from litsieve.operators.review import review
from litsieve.session import release, stored
from litsieve.streaming.keyed import KeyedTable

# Length, step and offset of the daily digest window.
DIGEST_WINDOW = ("32 hours", "24 hours", "16 hours")


def read_landed(
    spark: SparkSession, folder: str, schema: str, fmt: str = "json", pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of files that land in a folder, with a fixed schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def _start(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def annotate_stream(raw: DataFrame, rules: DigestRules, sources: DataFrame | None = None) -> DataFrame:
    """Row-wise stages of a run: normalize, filter, classify, review.

    ``sources`` is a static table, so the join needs no state.
    """
    filtered = filter_relevance(normalize_records(raw), rules, sources)
    return review(classify(filtered, rules).drop("found"), rules)


def start_routes(
    reviewed: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write a reviewed stream partitioned by route; the file sink is exactly-once."""
    writer = (
        reviewed.writeStream.format("parquet")
        .partitionBy("final_decision")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _start(writer, available_now)


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Hand each micro-batch to ``handle`` for steps that need a whole batch."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def split_undated(stream: DataFrame, time: str = "published_at") -> tuple[DataFrame, DataFrame]:
    """Dated rows with ``event_time``, and undated rows, which no watermark can order."""
    timed = stream.withColumn("event_time", parse_datetime(time))
    return timed.where("event_time IS NOT NULL"), timed.where("event_time IS NULL")


def start_dedupe(normalized: DataFrame, folder: str, available_now: bool = True) -> StreamingQuery:
    """Keep one record of each primary key; :func:`read_deduped` reads them.

    The record of smallest ``seq`` stands for its key, whichever file, batch or run
    brings it, so the result does not hang on the order of arrival: a batch writes a
    record if its key is new or if its ``seq`` is below the one kept so far.  The keys
    are a table in hash-partitioned files next to the output; they are never forgotten,
    copies may lie any time apart, and a batch reads only the partitions it touches.  A
    batch that is repeated after a failure replaces what it wrote.  Undated records have
    no place in a digest and are set aside, not lost.  Chains over several keys are kept
    by ``streaming.resolution``.
    """

    def handle(batch: DataFrame, number: int) -> None:
        keys = KeyedTable(batch.sparkSession, f"{folder}/keys", "dedupe_key", "dedupe_key string, seq long")
        batch.persist()
        dated, rest = split_undated(batch)
        rest.drop("event_time").write.mode("overwrite").parquet(f"{folder}/undated/batch={number}")
        keyed = dated.withColumn("dedupe_key", dedupe_key())
        first = keyed.groupBy("dedupe_key").agg(F.min("seq").alias("seq"))
        seen = keys.find(first, number).groupBy("dedupe_key").agg(F.min("seq").alias("seen"))
        better = stored(first.join(seen, "dedupe_key", "left").where("seen is null or seq < seen").drop("seen"))
        keyed.join(better, ["dedupe_key", "seq"], "left_semi").write.mode("overwrite").parquet(f"{folder}/records/batch={number}")
        keys.put(better, number)
        release(better)
        batch.unpersist()

    return start_batches(normalized, handle, f"{folder}/state", available_now)


def read_deduped(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What :func:`start_dedupe` keeps; ``schema`` names the columns to read, ``seq`` and ``dedupe_key`` among them."""
    rows = spark.read.schema(schema).parquet(f"{folder}/records")
    first = rows.groupBy("dedupe_key").agg(F.min("seq").alias("seq"))
    return rows.join(first, ["dedupe_key", "seq"], "left_semi")


def window_counts(events: DataFrame, time: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """Counts per daily digest window and key; late rows past the delay are dropped.

    :func:`start_window_counts` keeps and counts them.
    """
    late = events.withWatermark(time, delay)
    return (
        late.groupBy(F.window(time, *DIGEST_WINDOW), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")
    )


def start_window_counts(
    events: DataFrame, folder: str, time: str, keys: list[str], delay: str = "1 day", available_now: bool = True
) -> StreamingQuery:
    """Counts per daily digest window and key, with the late rows beside them.

    The watermark of a batch is the latest time of all earlier batches less ``delay``.
    A row is late for a window that ended by then: its digest has been sent.  Late rows
    are counted apart and kept, one row for each window they missed, under
    ``late/batch=n``; counts of a batch are added up on reading
    (:func:`read_window_counts`), so no window has to stay in memory.
    Rows without a time are counted with a null window.
    """
    spark = events.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        batch.persist()
        marks = f"{folder}/marks"
        latest = F.lit(None).cast("timestamp")
        if number:
            # One row per batch.
            seen = spark.read.schema("latest timestamp, batch long").parquet(marks).where(F.col("batch") < number)
            latest = F.lit(seen.agg(F.max("latest")).first()[0])
        dated = batch.withColumn("digest", F.window(time, *DIGEST_WINDOW))
        undated = batch.where(F.col(time).isNull()).withColumn("digest", F.lit(None).cast(dated.schema["digest"].dataType))
        closed = F.coalesce(F.col("digest.end") <= latest - F.expr(f"INTERVAL {delay}"), F.lit(False))
        marked = dated.unionByName(undated).withColumns(
            {"late": closed, "window_start": F.col("digest.start"), "window_end": F.col("digest.end")}
        ).drop("digest")
        counts = marked.groupBy("window_start", "window_end", *keys, "late").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")
        marked.where("late").drop("late").write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        batch.agg(F.max(time).alias("latest")).write.mode("overwrite").parquet(f"{marks}/batch={number}")
        batch.unpersist()

    return start_batches(events, handle, f"{folder}/state", available_now)


def read_window_counts(spark: SparkSession, folder: str, keys: str) -> DataFrame:
    """``window_start, window_end``, the keys, ``n`` and ``n_late``; ``keys`` is the layout of the keys."""
    names = [field.split()[0] for field in keys.split(",")]
    rows = spark.read.schema(f"window_start timestamp, window_end timestamp, {keys}, late boolean, n long").parquet(f"{folder}/counts")
    late = F.sum(F.when(F.col("late"), F.col("n")).otherwise(0))
    return rows.groupBy("window_start", "window_end", *names).agg((F.sum("n") - late).alias("n"), late.alias("n_late"))


__all__ = [
    "annotate_stream",
    "read_deduped",
    "read_landed",
    "read_window_counts",
    "split_undated",
    "start_batches",
    "start_dedupe",
    "start_routes",
    "start_window_counts",
    "window_counts",
]
