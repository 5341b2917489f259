"""From raw documents to packed training sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from litsieve.llm.bloom import build_filter, may_be_listed
from litsieve.llm.minhash import near_duplicates
from litsieve.llm.mixing import mix, mixed_texts
from litsieve.llm.packing import packed_documents
from litsieve.llm.toxicity import fit, toxic_text
from litsieve.session import release, shared_folder, stored

# A classifier, hashed permutations and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose score stays below the threshold; null and empty texts stay."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return docs.where(~toxic_text(spark, fit(docs, labels))("text"))


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` stored with a unique ``row_id``: ids may be null or repeat."""
    return stored(docs.withColumn("row_id", F.monotonically_increasing_id()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near duplicates stays, the one of smallest doc_id.

    Every row is judged by its own text, so different texts of one doc_id are not tied
    to each other.  Rows without a word are no near duplicates; of those with one
    doc_id and text one stays.  Rows without doc_id stay.  Only rows that may go are
    shuffled: a Bloom filter of their numbers lets the others pass.
    """
    rows = with_row_ids(docs)
    named = rows.where("doc_id is not null")
    judged = near_duplicates(named.select(F.col("row_id").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("row_id"), F.col("component_id").alias("component"), (F.col("n_shingles") > 0).alias("worded")
    )
    # The hash of the text orders rows of one id, so reruns keep the same text.
    order = F.struct("doc_id", "hash", "row_id")
    keys = named.select("row_id", "doc_id", F.xxhash64("text").alias("hash"))
    known = stored(keys.join(judged, "row_id"))
    worded = known.where("worded").groupBy("component").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    tied = known.where("worded").join(worded, "component").where("row_id <> first.row_id").select("row_id")
    same = ["doc_id", "text"]
    empty = known.where("not worded").select("row_id").join(named.select("row_id", *same), "row_id")
    again = empty.groupBy(*same).agg(F.min("row_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").alias("g")
    alike = [F.col(f"e.{c}").eqNullSafe(F.col(f"g.{c}")) for c in same]
    repeated = empty.alias("e").join(again, alike).where("row_id <> first").select("row_id")
    gone = stored(tied.unionByName(repeated))
    maybe = may_be_listed(spark, build_filter(gone, "row_id"))(F.xxhash64("row_id"))
    marked = rows.withColumn("__maybe", maybe)
    others = marked.where("not __maybe")
    checked = marked.where("__maybe").join(gone, "row_id", "left_anti")
    return others.select(docs.columns).unionByName(checked.select(docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the mix takes of every document: a row for each time it is taken, with the taken text."""
    rows = with_row_ids(docs)
    taken = mixed_texts(mix(rows, row="row_id"), rows, ("lang", "source"), row="row_id")
    text = F.col("mixed_text").alias("text")
    return taken.select("doc_id", text, "lang", "source", F.char_length("mixed_text").cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages one after the other, each stored and read again; only the last table stays."""
    docs, written = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
        stage(spark, docs, folder).write.parquet(path)
        # What this stage has read is needed no more.
        release(*written)
        docs = spark.read.parquet(path)
        written = [docs]
    return docs
