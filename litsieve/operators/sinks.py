"""Writers: partitioned stage tables, exports, dated archive and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from litsieve.functions.text import as_column


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with keys in name order; empty fields are written as null."""
    df.select(*sorted(df.columns)).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_ingested(raw: DataFrame, path: str, time: Column, mode: str = "append") -> None:
    """Raw records with their parsed time, laid out by day.

    The time is parsed once, at ingest.  Rows are range-partitioned and sorted by it, so
    a day is a folder with few files whose row groups cover short stretches of time;
    undated rows have a folder of their own.
    """
    timed = raw.withColumn("published_ts", time).withColumn("published_day", F.to_date("published_ts"))
    ordered = timed.repartitionByRange("published_ts").sortWithinPartitions("published_ts")
    ordered.write.mode(mode).partitionBy("published_day").parquet(path)


def write_routes(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One table whose partitions are the routes; readers prune to one of them."""
    df.write.mode(mode).partitionBy(column).parquet(path)


def export_columns(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The fixed column list as text: lists joined, missing columns empty."""
    cells = []
    for name in columns:
        if name not in df.columns:
            cells.append(F.lit("").alias(name))
        elif isinstance(df.schema[name].dataType, T.ArrayType):
            cells.append(F.coalesce(F.array_join(name, ", "), F.lit("")).alias(name))
        else:
            cells.append(F.coalesce(as_column(name).cast("string"), F.lit("")).alias(name))
    return cells


def export_rows(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *export_columns(df, columns))


def write_csv(rows: DataFrame, path: str, rank: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """CSV in rank order: range-partitioned and sorted, so the parts read in order."""
    ordered = rows.orderBy(rank).select(*columns)
    ordered.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_archive(rows: DataFrame, path: str, date_column: str = "digest_date") -> None:
    """Add or replace the days present in ``rows`` and leave other days alone."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def expired_days(days: DataFrame, today: Column, retention_days: int = 30, name: str = "day_name") -> DataFrame:
    """Archive days to drop: dated names on or before ``today`` minus the retention.

    Names that are not dates are left alone.
    """
    day = F.when(
        F.col(name).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(name).try_cast("date")
    )
    return days.where(day.isNotNull() & (day <= F.date_sub(today, retention_days)))


def kept_days(days: DataFrame, today: Column, retention_days: int = 30, name: str = "day_name") -> DataFrame:
    """Archive days that the retention leaves: later days, and names that are no dates."""
    return days.join(expired_days(days, today, retention_days, name).select(name).distinct(), name, "left_anti")


def apply_retention(spark, path: str, today: Column, retention_days: int = 30, date_column: str = "digest_date") -> DataFrame:
    """Delete the expired days of an archive and return the days that stay.

    Days are folders, so nothing is rewritten; only the list of days reaches the driver.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf)
    names = [entry.getPath().getName() for entry in files.listStatus(root) if entry.isDirectory()]
    prefix = f"{date_column}="
    days = spark.createDataFrame([(n.removeprefix(prefix),) for n in names if n.startswith(prefix)], "day_name string")
    for row in expired_days(days, today, retention_days).collect():
        files.delete(jvm.org.apache.hadoop.fs.Path(root, prefix + row["day_name"]), True)
    return kept_days(days, today, retention_days)
