"""Chat logs to training text, with DataFrame operations only.

A log holds streamed pieces, edits and regenerations of messages.  Messages are
folded from their events, rendered with a template whose marks cannot be forged
by texts, and come out with the segments that the loss counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.llm.common import columns
from litsieve.operators.positions import with_rank

# Marks of the template, and control strings of other templates and tokenizers (fixed values).
TURN, TEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (
    TURN,
    TEXT,
    END,
    "<|startoftext|>",
    "<|endoftext|>",
    "<s>",
    "</s>",
    "<unk>",
    "<pad>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
# Kinds of events.  A delta adds to a message; the others start its text afresh.
OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"
# Events or messages that one task puts together before they travel on.
CHUNK = 64


def escaped(text: Column) -> Column:
    """Text in which no control string is left: a backslash goes behind its first character."""
    rest = "|".join("".join("\\" + c if not c.isalnum() else c for c in mark[1:]) for mark in CONTROLS)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?={rest})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _joined(chunks: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(chunks)), lambda c: c["text"]), "")


def fold_messages(log: DataFrame) -> DataFrame:
    """``conv_id, message_no, role, text``: the final text of every message.

    ``log`` has conv_id, seq, kind, message_no, role, text.  A message starts afresh
    at its last event that is no delta, and the deltas behind it follow in order of
    ``seq``.  Its role is the last one given.  The last restart is a maximum that
    combines before the shuffle; texts are put together in chunks of neighbouring
    sequence numbers first, so a message of very many deltas is not one list.
    Null kinds count as deltas, null texts as empty.
    """
    key = ["conv_id", "message_no"]
    events = columns(log, conv_id="long", seq="long", kind="string", message_no="long", role="string", text="string")
    restart = F.coalesce(F.col("kind") != DELTA, F.lit(False))
    heads = events.groupBy(*key).agg(
        F.max(F.when(restart, F.col("seq"))).alias("from"), F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role")
    )
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"h.{k}")) for k in key]
    live = (
        events.drop("role").alias("e")
        .join(heads.alias("h"), same)
        .where(F.col("from").isNull() | F.col("seq").isNull() | (F.col("seq") >= F.col("from")))
        .select(*(F.col(f"e.{k}") for k in key), "seq", "h.role", F.coalesce("text", F.lit("")).alias("text"))
    )
    chunk = F.floor(F.col("seq") / CHUNK)
    parts = live.groupBy(*key, "role", chunk.alias("chunk")).agg(_joined(F.struct("seq", "text")).alias("text"))
    return parts.groupBy(*key, "role").agg(_joined(F.struct("chunk", "text")).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments``: one text per conversation and its parts.

    Segments are ``text`` and ``loss``; put together they are ``formatted``.  The loss
    counts the texts of the assistant, each a segment of its own.  Messages are put together in chunks, then conversations.
    Null roles are rendered as empty.
    """
    role = F.coalesce("role", F.lit(""))
    learned = role == "assistant"
    turn = F.array(
        F.struct(F.concat(F.lit(TURN), escaped(role), F.lit(TEXT)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(F.coalesce("text", F.lit(""))).alias("text"), learned.alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
    )
    turns = messages.select("conv_id", "message_no", turn.alias("turn"))
    parts = turns.groupBy("conv_id", F.floor(F.col("message_no") / CHUNK).alias("chunk")).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("message_no", "turn"))), lambda t: t["turn"])).alias("turn")
    )
    whole = parts.groupBy("conv_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "turn"))), lambda t: t["turn"])).alias("segments")
    )
    return whole.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def format_log(log: DataFrame) -> DataFrame:
    """Fold a log of events and render its conversations; an empty log gives no rows."""
    return render(fold_messages(log))


def conversation_log(conversations: DataFrame) -> DataFrame:
    """Finished conversations (conv_id, turn, role, text) as the log that led to them.

    Messages of the assistant were streamed, thrown away and generated again;
    others were streamed by half and edited to their final text.  Rows of one
    conversation and turn are messages of their own, ordered by role and text.
    Messages have the exact number of their row in the conversation, from 0.
    """
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string")
    # Equal rows are counted before they travel and get copy numbers, so no two rows rank the same.
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    single = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
    # A null turn comes first.
    said = [F.coalesce(name, F.lit("")) for name in ("role", "text")]
    numbered = with_rank(single, [F.col("turn"), *said, F.col("role"), F.col("text"), F.col("copy")], ["conv_id"])
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    first, second = F.left(text, half), F.substr(text, half + 1)

    def event(kind: str, value: Column, step: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("text"), F.lit(step).alias("step"))

    start = event(OPEN, F.lit(""), 0)
    streamed = F.array(start, event(DELTA, first, 1), event(REGENERATE, F.lit(""), 2), event(DELTA, first, 3), event(DELTA, second, 4))
    typed = F.array(start, event(DELTA, first, 1), event(EDIT, text, 2))
    return numbered.withColumn("message_no", F.col("rank") - 1).select(
        "conv_id",
        "message_no",
        "role",
        F.inline(F.when(F.coalesce(F.col("role") == "assistant", F.lit(False)), streamed).otherwise(typed)),
    ).select("conv_id", (F.col("message_no") * 8 + F.col("step")).alias("seq"), "kind", "message_no", "role", "text")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, read from rendered output."""
    pattern = rf"(?s){_quoted(TURN)}(.*?){_quoted(TEXT)}(.*?){_quoted(END)}"
    all_ = lambda group: F.regexp_extract_all("formatted", F.lit(pattern), F.lit(group))
    turns = F.transform(
        F.arrays_zip(all_(1).alias("role"), all_(2).alias("text")),
        lambda t: F.concat(unescaped(t["role"]), F.lit("\n"), unescaped(t["text"]), F.lit("\n")),
    )
    learned = F.filter("segments", lambda s: s["loss"])
    loss = F.array_join(F.transform(learned, lambda s: unescaped(s["text"])), "")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _quoted(mark: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in mark)
