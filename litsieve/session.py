"""Session settings and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the operators rely on; ``settings`` override them."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Batches that go to Python are bounded in bytes, not only in rows.
        "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
        # Checkpoints that nothing refers to any more are deleted.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Recording a call site for every column expression costs a millisecond each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **settings,
    }
    builder = SparkSession.builder.appName("litsieve")
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share, named by ``spark.checkpoint.dir``.

    On one machine (master ``local[...]``) a missing setting gets a folder of our
    own.  A cluster must name one: a machine-local folder would scatter the files
    over the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="litsieve-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Compute once into reliable storage and cut the lineage.

    The result is read back from the shared folder, so a lost executor costs a
    re-read and not a recomputation of the whole loop.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Like :func:`durable`, as a compressed column table.

    Later reads take single columns, and the planner knows the size on disk.
    ``compression`` is for tables of whole texts; others are small or read at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables written by :func:`stored` that no later step reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for parent in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(conf).delete(path, True)


# Rows and bytes of one Arrow batch.  A task holds a batch in the JVM and in every worker
# of its stage; Spark's own limits are 10,000 rows and 64 MB.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with batches to and from Python kept small from now on in its session.

    Limits that are already lower stay.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    size = _bytes(conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
    if not 0 < size <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def _bytes(size: str) -> int:
    """Bytes of a setting such as ``16m``; text without a unit counts bytes."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def evaluate_once(df: DataFrame, **columns) -> DataFrame:
    """Add costly columns behind a one-row generator.

    Filters on such columns stay above the generator.  Without it the optimizer
    pushes them below the projection and computes each column a second time in
    the filter, where common subexpressions are not shared.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that arrives in fewer partitions than there are.

    Such an input is small, or sits in few row groups; one shuffle of it buys
    the parallel text work that follows.  Larger inputs stay as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
