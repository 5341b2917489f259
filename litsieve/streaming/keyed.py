"""State of micro-batches as tables in hash-partitioned files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 64
# Folders of so many batches become one, and so many of those one again.
FOLD_EVERY = 64
WHOLE = "_whole"


@dataclass(frozen=True)
class KeyedTable:
    """Rows found by ``key``: a folder per micro-batch, in it one per bucket of keys.

    A batch sees what earlier batches wrote and reads only the buckets of the keys
    it asks for.  A batch that is repeated after a failure replaces its own folder,
    so every row counts once.  ``schema`` names the columns.

    Every ``fold_every`` batches their folders are folded into one, and as many of those
    into one of the next level, so a stream that never ends has few folders and a row is
    rewritten once per level.  With ``smallest`` only the smallest value of each column
    stays for a key.  A folded span counts once its marker is there; what it replaces is
    deleted a fold later, so that tables read meanwhile keep their files.
    """

    spark: SparkSession
    folder: str
    key: str
    schema: str
    smallest: bool = True
    fold_every: int = FOLD_EVERY

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(BUCKETS)).cast("int")

    def put(self, rows: DataFrame, number: int) -> None:
        """Keep ``rows`` as those of batch ``number``."""
        if number and number % self.fold_every == 0:
            self._fold(number)
        self._write(rows, str(number))

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before one."""
        names = [name for _, _, name in self._cover(before)]
        if not names:
            return self.spark.createDataFrame([], f"{self.schema}, batch string, bucket int")
        reader = self.spark.read.schema(f"{self.schema}, batch string, bucket int").option("basePath", self.folder)
        return reader.parquet(*(f"{self.folder}/batch={name}" for name in names))

    def find(self, keys: DataFrame, before: int) -> DataFrame:
        """Rows of earlier batches whose key is among ``keys``."""
        kept = self.rows(before).drop("batch")
        if before == 0:
            return kept.drop("bucket")
        wanted = keys.select(self.key).distinct()
        # One number per bucket at most.
        touched = [r["bucket"] for r in wanted.select(self.bucket().alias("bucket")).distinct().collect()]
        return kept.where(F.col("bucket").isin(touched)).join(wanted, self.key, "left_semi").drop("bucket")

    def _write(self, rows: DataFrame, name: str) -> None:
        marked = rows.withColumn("bucket", self.bucket())
        # Rows of a bucket meet in one task, which then writes one file.
        marked.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/batch={name}")

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder + name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self) -> list[tuple[int, int, str]]:
        """First batch, batch behind the last one and name of every whole folder."""
        root, files = self._path()
        if not files.exists(root):
            return []
        found = []
        for status in files.listStatus(root):
            _, _, name = status.getPath().getName().partition("batch=")
            first, _, end = name.partition("-")
            if end and files.exists(self._path(f"/batch={name}/{WHOLE}")[0]):
                found.append((int(first), int(end), name))
            elif name and not end:
                found.append((int(first), int(first) + 1, name))
        return found

    def _cover(self, before: int | None = None) -> list[tuple[int, int, str]]:
        """Folders that hold every batch once, the longest spans first."""
        chosen, at = [], 0
        for first, end, name in sorted(self._folders(), key=lambda f: (f[0], -f[1])):
            if first >= at and (before is None or end <= before):
                chosen.append((first, end, name))
                at = end
        return chosen

    def _fold(self, number: int) -> None:
        """Fold the batches that end a level at ``number``; all of them are done, as ``number`` has begun."""
        length = self.fold_every
        while number % (length * self.fold_every) == 0:
            length *= self.fold_every
        needed = self._cover(number)
        for folder in self._folders():
            if folder not in needed and folder[1] <= number:
                path, files = self._path(f"/batch={folder[2]}")
                files.delete(path, True)
        parts = [f for f in needed if f[0] >= number - length]
        if len(parts) < 2:
            return
        name = f"{number - length}-{number}"
        kept = self.spark.read.schema(f"{self.schema}, batch string, bucket int").option("basePath", self.folder)
        rows = kept.parquet(*(f"{self.folder}/batch={f[2]}" for f in parts)).drop("batch", "bucket")
        if self.smallest:
            rows = rows.groupBy(self.key).agg(*(F.min(c).alias(c) for c in rows.columns if c != self.key))
        self._write(rows, name)
        path, files = self._path(f"/batch={name}/{WHOLE}")
        files.create(path, True).close()
