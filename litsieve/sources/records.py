"""Raw record scan and human decision files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.functions.text import as_column, strip_ends, text_or_empty
from litsieve.operators.positions import with_rank
from litsieve.schemas import RAW

DECISION_COLUMNS = (
    "journal",
    "doi",
    "article_url",
    "title_en",
    "review_final_decision",
    "review_final_category",
    "reviewer_notes",
)


def string_or_list(value: Column | str) -> Column:
    """A JSON list or a bare string, as a list; null and ``''`` give an empty list."""
    value = as_column(value)
    return (
        F.when(F.coalesce(value, F.lit("")) == "", F.array().cast("array<string>"))
        .when(value.startswith("["), F.coalesce(F.from_json(value, "array<string>"), F.array(value)))
        .otherwise(F.array(value))
    )


def scan_records(spark: SparkSession, path: str, schema: str = RAW) -> DataFrame:
    """Read JSON lines with a fixed schema; a malformed line stops the job."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for name in ("tags", "authors"):
        if name in df.columns:
            df = df.withColumn(name, string_or_list(name))
    return df


def filled_decisions(rows: DataFrame) -> DataFrame:
    """Trim the three decision columns and drop rows where all are blank."""
    cleaned = rows.withColumns(
        {
            "review_final_decision": F.lower(strip_ends(text_or_empty("review_final_decision"))),
            "review_final_category": strip_ends(text_or_empty("review_final_category")),
            "reviewer_notes": strip_ends(text_or_empty("reviewer_notes")),
        }
    )
    return cleaned.where(
        (F.col("review_final_decision") != "")
        | (F.col("review_final_category") != "")
        | (F.col("reviewer_notes") != "")
    )


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Edited review queue; columns by header name, missing ones as null.

    ``seq`` orders rows by file name and position so that the last row wins.
    """
    rows = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
        .withColumn("file_name", F.input_file_name())
    )
    for name in DECISION_COLUMNS:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    # A multi-line file is read by one task in file order, so the id rises with
    # the row of a file; the file name orders files.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    placed = with_rank(rows, [F.col("file_name"), F.col("row")], name="seq")
    return filled_decisions(placed.select("seq", *DECISION_COLUMNS))
