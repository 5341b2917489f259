"""Replies of user callables, kept in files so that nothing is asked for twice."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.operators.providers import CallPolicy, call_with_policy

BUCKETS = 64
ENTRIES = "digest string, reply string"


@dataclass(frozen=True)
class ReplyJournal:
    """Replies by the digest of their request, in one folder per bucket of digests.

    ``folder`` is a path or URI that driver and executors share.  A task writes a file
    after every ``batch`` replies, and what it has when a call fails for good; its next
    attempt reads the files of its own buckets first.  A worker that is killed loses
    ``batch`` replies at most.  Entries are never rewritten; should two attempts ask the
    same at once, the reply that sorts first counts.
    """

    folder: str
    batch: int = 16

    def entries(self, spark: SparkSession) -> DataFrame:
        """``digest, reply``: one JSON reply per request."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], ENTRIES)
        kept = spark.read.schema(f"{ENTRIES}, bucket int").parquet(self.folder)
        return kept.groupBy("digest").agg(F.min("reply").alias("reply"))


def request_digest(columns: list[str]) -> Column:
    """Digest of what the callable sees; nulls and empty texts differ."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _asked(call: Callable[[dict], dict], columns: list[str], policy: CallPolicy, journal: ReplyJournal):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(journal.folder)
        last: list[float] = []

        def keep(bucket: int, done: list[tuple[str, str]]) -> None:
            folder, name = f"{root}/bucket={bucket}", uuid.uuid4().hex
            files.create_dir(folder)
            # Readers skip names with an underscore, so they see whole files only.
            with files.open_output_stream(f"{folder}/_{name}") as out:
                pq.write_table(pa.table({"digest": [d for d, _ in done], "reply": [r for _, r in done]}), out)
            files.move(f"{folder}/_{name}", f"{folder}/{name}.parquet")

        def known(bucket: int, digests: list[str]) -> set[str]:
            found = files.get_file_info(fs.FileSelector(f"{root}/bucket={bucket}", allow_not_found=True))
            paths = [f.path for f in found if f.path.endswith(".parquet")]
            if not paths:
                return set()
            rows = ds.dataset(paths, format="parquet", filesystem=files)
            return set(rows.to_table(columns=["digest"], filter=pc.field("digest").isin(digests))["digest"].to_pylist())

        for batch in batches:
            by_bucket: dict[int, list[dict]] = {}
            for row in batch.to_pylist():
                by_bucket.setdefault(row["bucket"], []).append(row)
            asked = 0
            for bucket, rows in by_bucket.items():
                told, done = known(bucket, [r["digest"] for r in rows]), []
                try:
                    for row in rows:
                        if row["digest"] in told:
                            continue
                        reply = call_with_policy(call, {c: row[c] for c in columns}, policy, last)
                        done.append((row["digest"], json.dumps(reply, ensure_ascii=False)))
                        asked += 1
                        if len(done) == journal.batch:
                            # A list that is being written is not written again if that fails.
                            full, done = done, []
                            keep(bucket, full)
                finally:
                    if done:
                        keep(bucket, done)
            yield pa.RecordBatch.from_arrays([pa.array([asked], pa.int64())], names=["asked"])

    return run


def ask_once(
    records: DataFrame, columns: list[str], call: Callable[[dict], dict], journal: ReplyJournal, policy: CallPolicy = CallPolicy()
) -> int:
    """Ask for every different request that the journal does not hold; the number of calls.

    ``call`` gets a dict of ``columns`` and returns a dict that JSON can hold.  Requests
    are dealt by the bucket of their digest, so another attempt of a task meets the same
    buckets, and no two tasks share one.
    """
    requests = records.select(request_digest(columns).alias("digest"), *columns).dropDuplicates(["digest"])
    missing = requests.join(journal.entries(records.sparkSession).select("digest"), "digest", "left_anti")
    bucketed = missing.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(BUCKETS)).cast("int"))
    dealt = bucketed.repartition(policy.concurrency or BUCKETS, "bucket").sortWithinPartitions("bucket")
    asked = dealt.mapInArrow(_asked(call, columns, policy, journal), "asked long")
    return asked.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]


def call_journalled(
    records: DataFrame,
    name: str,
    columns: list[str],
    result: str,
    call: Callable[[dict], dict],
    journal: ReplyJournal,
    policy: CallPolicy = CallPolicy(),
) -> DataFrame:
    """Like ``providers.call_records``, with replies from ``journal`` where it has them.

    Missing replies are asked for right away, once per different request; the records
    then meet their replies by digest.  A field that a reply lacks is null.
    """
    ask_once(records, columns, call, journal, policy)
    replies = journal.entries(records.sparkSession).select("digest", F.from_json("reply", result).alias(name))
    marked = records.withColumn("digest", request_digest(columns))
    return marked.join(replies, "digest", "left").drop("digest")
