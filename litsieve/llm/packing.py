"""Best-fit packing planned over a histogram of lengths.

Documents are cut into pieces of at most one sequence.  The plan packs counts of
equal lengths, not pieces, so its size depends on the sequence length alone.
Pieces then take the planned slots by their rank within their length.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from litsieve.llm.common import memory_returned, public_tokenizer, text_bytes, texts, worker_value
from litsieve.operators.positions import with_rank
from litsieve.session import stored

SEQUENCE_TOKENS = 2048
TOKENIZER_FILE = "word_bpe_49k.json"
END_ID = 0
# Ids of short words are kept between texts, up to this many per worker process.
CACHE_WORDS = 300_000
CACHE_CORES = 500_000
CACHE_WORD_BYTES = 48
# Planned slots that one task lists.
SLOT_CHUNK = 1 << 16

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Printable stand-ins that byte-level vocabularies use for bytes (fixed values): printable
# characters of Latin-1 stand for themselves, the others follow from 256 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PLAIN}))}
# Marks that a letter or digit never shares a token with; the apostrophe is not among them.
_TAIL = re.compile(rb"^(.+?)([.,;:!?%$&*#]+)$", re.DOTALL)


class _Bounded(dict):
    """A cache that starts afresh when it is full."""

    def __init__(self, entries: int):
        super().__init__()
        self.entries = entries

    def keep(self, key: bytes, ids: bytes) -> bytes:
        if len(key) <= CACHE_WORD_BYTES:
            if len(self) >= self.entries:
                self.clear()
            self[key] = ids
        return ids


class _Cores(_Bounded):
    """Ids of a word without the marks behind it, as bytes of unsigned 32-bit numbers."""

    def __init__(self, path: str):
        super().__init__(CACHE_CORES)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        low = text.lower() if text.isascii() else "".join(c.lower() for c in unicodedata.normalize("NFC", text))
        # A run of Latin letters is one unit of the vocabulary's merges, without any splitting.
        if low.isalpha() and max(low) < "\u0250":
            ids = [token.id for token in self.model.tokenize("".join(map(_BYTES.__getitem__, low.encode())))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.keep(word, np.array(ids, "<u4").tobytes())


class _Words(_Bounded):
    """Ids of a word; white space never joins words, so a text is its words' ids in a row."""

    def __init__(self, path: str):
        super().__init__(CACHE_WORDS)
        self.cores = _Cores(path)

    def __missing__(self, word: bytes) -> bytes:
        split = _TAIL.match(word)
        # Marks after a letter or digit are a token of their own; after another mark they are not.
        # The lower-cased form counts: some capitals become a letter and a combining mark.
        if split and split[1].decode("utf-8", "replace").lower()[-1].isalnum():
            ids = self.cores[split[1]] + self.cores[split[2]]
        else:
            ids = self.cores[word]
        return self.keep(word, ids)

    def ids(self, data: bytes) -> bytes:
        # The vocabulary is lower case; special tokens, which are not, hold "<".
        words = (data if b"<" in data else data.lower()).split()
        return b"".join(map(self.__getitem__, words))


def _words(path: str) -> _Words:
    """One set of caches per worker process and tokenizer; tasks that follow find it warm."""
    return worker_value(("words", path), lambda: _Words(path))


def _pieces(path: str, limit: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), text_bytes(batch)):
                ids = np.frombuffer(words.ids(data or b"") + end, "<u4")
                for piece, start in enumerate(range(0, len(ids), limit)):
                    part = ids[start : start + limit]
                    row = (doc_id, piece, start, len(part), zlib.crc32(part), part)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(out, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([part.astype(np.int32) for part in out[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``limit`` ids; only longer documents are cut, the last piece is shorter.

    ``tokenizer`` is the path of a tokenizer file that drops white space.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return texts(docs, doc_id="long", text="string").mapInArrow(
        memory_returned(_pieces(tokenizer or public_tokenizer(TOKENIZER_FILE), limit, end_id, with_ids)), schema
    )


def plan_slots(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over ``counts`` of lengths.

    Returns runs of slots ``(length, first_rank, n, first_sequence, offset)``: the
    pieces of this length with ranks from ``first_rank`` go to n sequences in a
    row.  Open sequences with equal room are kept as runs of sequence numbers; a
    run is split only where a length runs out.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]
    slots, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, at = counts[length], 0, length
        while left:
            while at <= limit and not room[at]:
                at += 1
            if at > limit:
                fresh = -(-left // (limit // length))
                room[limit].append((sequences, fresh))
                sequences += fresh
                at = limit
            first, n = room[at].pop()
            each = at // length
            # Best fit goes on filling a sequence while the length fits in it.
            full = min(n, left // each)
            if not full:
                each, full = left, 1
            for i in range(each):
                slots.append((length, rank, full, first, limit - at + i * length))
                rank += full
            left -= each * full
            if full < n:
                room[at].append((first + full, n - full))
            room[at - each * length].append((first, full))
            at = length
    return slots


def pack(pieces: DataFrame, limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``; ``pieces`` has doc_id, piece and length.

    The histogram has at most ``limit`` rows, the plan a number of runs that depends
    on ``limit``; runs are spread into slots in chunks, and pieces meet their slot
    by length and rank, a key that never repeats.  Ranks come from sorted ranges,
    so a length that a third of the pieces share is spread over many tasks.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").count().collect()
    slots = plan_slots({row["length"]: row["count"] for row in histogram}, limit)
    runs = spark.createDataFrame(slots, "length long, first_rank long, n long, first_sequence long, offset long")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SLOT_CHUNK).cast("long")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = runs.withColumn("low", chunk).repartition(parts, "length", "first_rank", "low")
    numbers = F.explode(F.sequence("low", F.least(F.col("low") + SLOT_CHUNK, "n") - 1))
    planned = spread.withColumn("i", numbers).select(
        "length",
        (F.col("first_rank") + F.col("i") + 1).alias("rank"),
        (F.col("first_sequence") + F.col("i")).alias("sequence_id"),
        "offset",
    )
    ranked = with_rank(pieces, [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], ["length"])
    return ranked.join(planned, ["length", "rank"]).select(*pieces.columns, "sequence_id", "offset")


def packed_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its place in a sequence.

    Null and empty texts are one piece that holds the end id alone.  Repeated rows
    are packed once each.  A row without doc_id is packed under a null doc_id.  An
    empty table gives no pieces.  ``with_ids`` adds the ids of each piece.
    """
    return pack(stored(token_pieces(docs, tokenizer, limit, end_id, with_ids)), limit)
