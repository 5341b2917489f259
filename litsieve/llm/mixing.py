"""Mixing sources to target weights, with DataFrame operations only.

The words of a source are one stream, cut into blocks of a fixed length.  A
source is due a number of block slots; multinomial draws spread them over the
output shards.  The k-th slot of a source takes the block that a pseudorandom
permutation of its block numbers puts at place k, so an epoch takes every block
once, and blocks are joined to slots by number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.llm.common import WORD, columns
from litsieve.operators.positions import with_running_sum
from litsieve.session import stored

BLOCK_WORDS = 512
SHARD_SLOTS = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
SEED = 7
HALF_ROUNDS = 6
# Steps of the walk back into range.  The domain has fewer than 64 numbers to spare
# up to 4,000 blocks; beyond that a step leaves the range with a chance below 1/64.
WALK = 64
# Slots that one task lists.
SLOT_CHUNK = 1 << 16


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``source, source_no, source_size, target``: one row per source.

    Sources in code-point order (null last) get the weights in turn.  The targets
    add up to ``share`` times all sizes in proportion to the weights; a target
    stops at ``limit`` times its source's size and the rest is shared out again.
    The fixed point is one level for all sources below their limit, found from
    sums over the sources in the order in which they reach it.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    rows = per_source.withColumn("source_no", F.row_number().over(ordered) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(limit)))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    # With a share above the limit every source stops at its limit.
    level = F.max(fits).over(everything)
    target = F.coalesce(F.least("most", level * F.col("weight")), F.col("most"))
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def _round(value: Column, key: Column, epoch: Column, number: int, size: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), key, epoch, F.lit(number), value), size)


def _sides(n: Column) -> tuple[Column, Column]:
    rows = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    return rows, F.ceil(n / rows).cast("long")


def _step(x: Column, n: Column, key: Column, epoch: Column, backward: bool = False) -> Column:
    """One pass of a Feistel network over the smallest near-square grid that holds n numbers."""
    rows, width = _sides(n)
    left, right = F.floor(x / width).cast("long"), F.pmod(x, width)
    for i in reversed(range(HALF_ROUNDS)) if backward else range(HALF_ROUNDS):
        sign = -1 if backward else 1
        if i % 2 == 0:
            left = F.pmod(left + sign * _round(right, key, epoch, i, rows), rows)
        else:
            right = F.pmod(right + sign * _round(left, key, epoch, i, width), width)
    return left * width + right


def permuted(x: Column, n: Column, key: Column, epoch: Column, backward: bool = False) -> Column:
    """Place ``x`` under a permutation of 0..n-1 that key and epoch choose.

    The grid may hold more than n numbers; a walk follows the permutation until it
    is back in range, which keeps it one-to-one.
    """
    first = _step(x, n, key, epoch, backward)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda at, _: F.when(at < n, at).otherwise(_step(at, n, key, epoch, backward)),
    )
    return F.when(first < n, first).otherwise(walk)


def source_plan(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks, whole epochs and slots of every source.

    The words taken add up to the rounded target: whole epochs first, then the
    first slots of one more permutation, the last of which is cut short.
    """
    b = F.lit(block_words)
    plan = targets.where("source_size > 0").select(
        "source_no",
        "source_size",
        F.xxhash64(F.lit("source"), "source").alias("key"),
        F.ceil(F.col("source_size") / b).cast("long").alias("blocks"),
        F.round("target").cast("long").alias("due"),
    )
    plan = plan.withColumn("epochs", F.floor(F.col("due") / F.col("source_size")).cast("long"))
    plan = plan.withColumn("rest", F.col("due") - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumn("missing", F.col("blocks") * b - F.col("source_size"))
    # Place of the block that is not full, in the epoch that is cut short.
    plan = plan.withColumn("short_at", permuted(F.col("blocks") - 1, F.col("blocks"), F.col("key"), F.col("epochs"), backward=True))
    needed = F.ceil(F.col("rest") / b).cast("long")
    plan = plan.withColumn(
        "more", F.when(F.col("short_at") < needed, F.ceil((F.col("rest") + F.col("missing")) / b).cast("long")).otherwise(needed)
    )
    return plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.col("more"))


def shard_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``source_no, shard, n``: multinomial counts of each source's slots over the shards.

    The draws are conditional on the totals: every slot of a source falls on a
    shard by its own hash, so the counts of a source over the shards are
    multinomial and add up to its slots.  Only counts are shuffled.
    """
    everything = Window.partitionBy()
    shards = F.greatest(F.lit(1), F.ceil(F.sum("slots").over(everything) / F.lit(shard_slots)).cast("long"))
    chunks = plan.withColumn("shards", shards).where("slots > 0").select(
        "source_no", "slots", "shards", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(SLOT_CHUNK).cast("long"))).alias("first")
    )
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = chunks.repartition(parts, "source_no", "first").select(
        "source_no", "shards", F.explode(F.sequence("first", F.least(F.col("first") + SLOT_CHUNK, "slots") - 1)).alias("k")
    )
    shard = F.pmod(F.xxhash64(F.lit(SEED), F.lit("shard"), "source_no", "k"), F.col("shards"))
    return slots.groupBy("source_no", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def slot_table(plan: DataFrame, counts: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``shard, source_no, epoch, block, words``: the block of every slot and the words it takes."""
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
    slots = placed.select("source_no", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("k"))
    slots = slots.join(plan, "source_no")
    slots = slots.withColumn("epoch", F.floor(F.col("k") / F.col("blocks")).cast("long"))
    slots = slots.withColumn("place", F.col("k") - F.col("epoch") * F.col("blocks"))
    earlier = F.col("place") * block_words - F.when(F.col("short_at") < F.col("place"), F.col("missing")).otherwise(0)
    words = F.when(F.col("epoch") < F.col("epochs"), F.lit(block_words)).otherwise(
        F.least(F.lit(block_words), F.col("rest") - earlier)
    )
    return slots.select(
        "shard",
        "source_no",
        "epoch",
        permuted(F.col("place"), F.col("blocks"), F.col("key"), F.col("epoch")).alias("block"),
        words.cast("long").alias("words"),
    )


@dataclass(frozen=True)
class Mix:
    """``documents``: doc_id, size, source_size, target, source_no, start (their first word in
    the source's stream), and the row key where there is one.  ``slots``: shard, source_no, epoch, block, words.  ``takes``: the
    part of a document in a slot: source_no, start, shard, epoch, first_word, n_words."""

    documents: DataFrame
    slots: DataFrame
    takes: DataFrame


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    row: str | None = None,
) -> Mix:
    """Choose what the mix takes of every document.

    Words are runs without ASCII white space.  Null and empty texts have size 0:
    they are listed and nothing of them is taken.  A null source is a source of its
    own.  Repeated rows are documents of their own.  A row without doc_id counts
    like any other.  ``row`` names a unique number of the rows, which ``documents`` then
    keeps.  An empty table gives an empty mix.  Draws and permutations
    depend on the data alone, so reruns agree.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = {row: "long"} if row else {}
    own = columns(docs, doc_id="long", source="string", text="string", **key)
    sizes = stored(own.select("doc_id", "source", size.alias("size"), *key))
    targets = stored(source_targets(sizes, weights, share, limit))
    named = targets.withColumnRenamed("source", "name")
    numbered = sizes.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name")
    documents = stored(with_running_sum(numbered, "size", ["doc_id", "size"], ["source_no"]))
    plan = stored(source_plan(targets, block_words))
    slots = stored(slot_table(plan, shard_counts(plan, shard_slots), block_words))
    blocks = F.sequence(
        F.floor(F.col("start") / block_words).cast("long"),
        F.floor((F.col("start") + F.col("size") - 1) / block_words).cast("long"),
    )
    pieces = documents.where("size > 0").select("source_no", "start", "size", F.explode(blocks).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("words"))
    takes = (
        pieces.join(slots, ["source_no", "block"])
        .select("source_no", "start", "shard", "epoch", (low - F.col("start")).alias("first_word"), (high - low).alias("n_words"))
        .where("n_words > 0")
    )
    return Mix(documents, slots, takes)


def taken_words(mixed: Mix) -> DataFrame:
    """Documents with ``taken``, the words the mix takes of them, repeats counted."""
    per_document = mixed.takes.groupBy("source_no", "start").agg(F.sum("n_words").alias("taken"))
    filled = mixed.documents.where("size > 0").join(per_document, ["source_no", "start"], "left")
    return filled.unionByName(mixed.documents.where("size = 0").withColumn("taken", F.lit(None).cast("long"))).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_texts(mixed: Mix, docs: DataFrame, carry: tuple[str, ...] = (), row: str = "doc_id") -> DataFrame:
    """``doc_id, epoch, mixed_text``: the taken words of every document, one row per epoch.

    ``carry`` names further columns of ``docs`` to keep.  ``row`` is the row key that
    :func:`mix` was given; without one, ``doc_id`` has to be unique and never null.
    A document of which an epoch takes everything keeps its exact text; of others the
    taken words stay with the white space before them.
    """
    ranges = mixed.takes.groupBy("source_no", "start", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("first_word", "n_words"))).alias("ranges"), F.sum("n_words").alias("n")
    )
    # An empty document starts where the next one does.
    named = ranges.join(mixed.documents.where("size > 0").select("source_no", "start", "doc_id", "size", F.col(row).alias("__row")), ["source_no", "start"])
    texts = docs.select(F.col(row).cast("long").alias("__id"), "text", *carry)
    words = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    cut = F.array_join(
        F.flatten(F.transform("ranges", lambda r: F.slice(F.col("words"), (r["first_word"] + 1).cast("int"), r["n_words"].cast("int")))), ""
    )
    found = named.join(texts, F.col("__row") == F.col("__id"))
    whole = F.col("n") == F.col("size")
    found = found.withColumn("words", F.when(~whole, words))
    return found.select("doc_id", "epoch", F.when(whole, F.col("text")).otherwise(F.ltrim(cut)).alias("mixed_text"), *carry)
