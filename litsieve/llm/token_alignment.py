"""Alignment of two tokenizers over the same text, window by window.

A text is tokenised whole by both.  Where a space-marked token of either starts at the
same byte, the tokens before it end together, so such places cut a text into windows of
token ids.  A window is aligned once and remembered by its ids; most windows are words.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from litsieve.llm.common import public_tokenizer, text_bytes, texts, worker_value
from litsieve.session import release, stored

BYTE_LEVEL_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
# Windows and linked pairs that a worker remembers; it starts afresh beyond.
MEMO_WINDOWS = 250_000
MEMO_PAIRS = 4_000_000
# Longer texts are tokenised in parts; both tokenizers always split before a space between letters.
PART_CHARS = 1 << 20
PART_END = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
# Pairs whose counts go to every task: 17 bytes each.
HEAD_PAIRS = 1 << 17

LONGS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of every entry of a byte-level vocabulary.

    Printable characters of Latin-1 stand for their own byte, the others follow from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    bytes_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    special = {token["id"] for token in rules["added_tokens"]}
    vocabulary = {i: bytes(map(bytes_of.__getitem__, key)) for key, i in rules["model"]["vocab"].items() if i not in special}
    return [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]


def piece_tokens(model) -> list[bytes]:
    """Bytes of every piece: U+2581 is a space, <0xHH> a byte."""
    pieces = ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]


class _Tokens:
    """Ids of a text with the lengths of the tokens and whether a space leads them."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.spaced = np.array([e[:1] == b" " for e in entries])

    def whole(self, ids: np.ndarray, data: np.ndarray) -> bool:
        """Whether the tokens' bytes in a row are ``data``."""
        low, n = self.starts[ids], self.lengths[ids]
        return int(n.sum()) == len(data) and np.array_equal(self.flat[_ranges(low, low + n)], data)

    def spaces(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the space-marked tokens and the bytes they start at."""
        at = np.flatnonzero(self.spaced[ids])
        return at, (np.cumsum(self.lengths[ids]) - self.lengths[ids])[at]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each low up to its high."""
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())


class _Aligner:
    """Both tokenizers of a worker process and the windows they have aligned."""

    def __init__(self, byte_level: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a = _Tokens(byte_level_tokens(byte_level))
        self.b = _Tokens(piece_tokens(self.pieces))
        # The merges of a byte-level vocabulary are in the order of its ids.
        ranks = {entry: i for i, entry in enumerate(self.a.entries) if entry}
        self.bytes_bpe = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # Decimal digits of every id.
        numbers = [str(i).encode() for i in range(max(len(self.a.entries), len(self.b.entries)))]
        self.width = np.array(list(map(len, numbers)), np.int64)
        self.digit_at = np.cumsum(self.width) - self.width
        self.digits = np.frombuffer(b"".join(numbers), np.uint8)
        self.forget()

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        first, second, start = [], [], 0
        while start < len(text):
            cut = PART_END.search(text, start + PART_CHARS) if len(text) > start + PART_CHARS else None
            end = cut.start() if cut else len(text)
            # Both put a space in front, so a later part goes without its own.
            one, two = text[start:end], text[start + (start > 0) : end]
            first.append(self.bytes_bpe.encode_to_numpy(one if start else " " + one, disallowed_special=()))
            second.append(np.array(self.pieces.encode(two, num_threads=1), np.uint32))
            start = end
        return np.concatenate(first), np.concatenate(second)

    def windows(self, ids: tuple[np.ndarray, np.ndarray], cuts: np.ndarray) -> range:
        """Align windows of a text that are not known yet; returns their numbers.

        ``cuts`` has their first and last tokens of both sides, one row each.  The
        windows are put in a row: both sides of one have the same bytes.
        """
        counts = cuts[:, 1] - cuts[:, 0], cuts[:, 3] - cuts[:, 2]
        tokens = [i[_ranges(cuts[:, s], cuts[:, s + 1])] for i, s in zip(ids, (0, 2))]
        ends = [np.cumsum(t.lengths[i]) for t, i in zip((self.a, self.b), tokens)]
        last = ends[0][np.cumsum(counts[0]) - 1]
        # Between two neighbouring ends of either side lies one link.
        every = np.union1d(*ends)
        first, second = (np.searchsorted(e, every) for e in ends)
        pairs = tokens[0][first].astype(np.int64) << 32 | tokens[1][second]
        closes = every[(ends[0][first] == every) & (ends[1][second] == every)]
        links, groups = (np.diff(np.searchsorted(e, last, "right"), prepend=0) for e in (every, closes))
        starts = len(self.pairs) + np.cumsum(links) - links
        for column, values in ((self.pairs, pairs), (self.starts, starts), (self.links, links), (self.groups, groups)):
            column.frombytes(values.astype(np.int64).tobytes())
        # Tokens by group, those of the first side before those of the second.
        place = np.concatenate([2 * np.searchsorted(closes, e) + s for s, e in enumerate(ends)])
        order = np.argsort(place, kind="stable")
        place = place[order]
        window = np.concatenate([np.repeat(np.arange(len(cuts)), n) for n in counts])[order]
        # An id, then what stands behind it: within a side, after the first or second side of a group.
        mark = np.where(np.diff(place, append=-1) == 0, ord(","), np.where(place % 2 == 0, ord("|"), ord(";")))
        named = np.concatenate(tokens)[order]
        wide = self.width[named]
        behind = np.cumsum(wide + 1) - 1
        text = np.empty(behind[-1] + 1, np.uint8)
        digits = np.ones(len(text), bool)
        digits[behind] = False
        text[behind] = mark
        text[digits] = self.digits[_ranges(self.digit_at[named], self.digit_at[named] + wide)]
        stops = len(self.text) + behind[np.flatnonzero(np.diff(window, append=-1))] + 1
        self.text.frombytes(text.tobytes())
        self.text_stops.frombytes(stops.astype(np.int64).tobytes())
        return range(len(self.starts) - len(cuts), len(self.starts))

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        # Texts of the groups of all windows in a row, and where each ends.
        self.text, self.text_stops = array("B"), array("q", [0])
        self.starts, self.groups, self.links, self.pairs = (array("q") for _ in range(4))

    def align(self, data: bytes | None) -> tuple:
        """Counts, digest, pairs and times of one text."""
        nothing = (0, 0, 0, 0, "", [], [])
        if not data:
            return nothing
        a_ids, b_ids = self.ids(data.decode("utf-8", "replace"))
        spaced = np.frombuffer(b" " + data, np.uint8)
        # The merges of a byte-level vocabulary only join bytes: all are there if their number is right.
        if int(self.a.lengths[a_ids].sum()) != len(spaced) or not self.b.whole(b_ids, spaced):
            return nothing
        if len(self.starts) > MEMO_WINDOWS or len(self.pairs) > MEMO_PAIRS:
            self.forget()
        (a_at, a_byte), (b_at, b_byte) = self.a.spaces(a_ids), self.b.spaces(b_ids)
        near = np.searchsorted(b_byte, a_byte)
        shared = near < len(b_byte)
        shared[shared] = b_byte[near[shared]] == a_byte[shared]
        edges = np.stack([a_at[shared], b_at[near[shared]]])
        edges = np.concatenate([[[0], [0]]] * (edges[0, :1].sum() > 0 or not edges.size) + [edges, [[len(a_ids)], [len(b_ids)]]], axis=1)
        cuts = np.stack([edges[0, :-1], edges[0, 1:], edges[1, :-1], edges[1, 1:]], axis=1)
        a_raw, b_raw, memo = a_ids.tobytes(), b_ids.tobytes(), self.memo
        # No id has all bits set, so the key tells both sides apart.
        a_bytes, b_bytes = (4 * edges).tolist()
        keys = [a_raw[i:j] + b"\xff\xff\xff\xff" + b_raw[k:m] for i, j, k, m in zip(a_bytes, a_bytes[1:], b_bytes, b_bytes[1:])]
        numbers = list(map(memo.get, keys))
        if None in numbers:
            missing = [at for at, number in enumerate(numbers) if number is None]
            fresh: dict[bytes, int] = {}
            for at in missing:
                fresh.setdefault(keys[at], at)
            memo.update(zip(fresh, self.windows((a_ids, b_ids), cuts[list(fresh.values())])))
            for at in missing:
                numbers[at] = memo[keys[at]]
        stops = np.frombuffer(self.text_stops, np.int64)
        text = np.frombuffer(self.text, np.uint8)[_ranges(stops[numbers], stops[np.array(numbers) + 1])]
        digest = hashlib.sha256(text[:-1]).hexdigest()
        used, times = np.unique(numbers, return_counts=True)
        starts, links, groups = (np.frombuffer(c, np.int64)[used] for c in (self.starts, self.links, self.groups))
        flat = np.frombuffer(self.pairs, np.int64)[_ranges(starts, starts + links)]
        pairs, place = np.unique(flat, return_inverse=True)
        each = np.bincount(place, np.repeat(times, links)).astype(np.int64)
        return len(a_ids), len(b_ids), int(groups @ times), int(links @ times), digest, pairs, each


def _align(byte_level: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_value(("aligner", byte_level, pieces), lambda: _Aligner(byte_level, pieces))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            whole = list(zip(*map(aligner.align, text_bytes(batch)))) or [()] * 7
            arrays = [batch.column("row"), batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(whole, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", *LONGS, "groups_sha256", "pairs", "times"])

    return run


def aligned_documents(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Counts, digest of the groups and linked id pairs (``a << 32 | b``) with their times, by row of ``docs``."""
    rows = texts(docs, doc_id="long", text="string").withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(_align(byte_level, pieces), ALIGNED)


def _looked_up(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Sums over the pairs of the head; the others stay listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, times = batch.column("pairs"), np.asarray(batch.column("times").flatten())
            flat = np.asarray(lists.flatten())
            owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
            at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
            known = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            sums = [np.zeros(len(lists), np.int64) for _ in range(2)]
            for total, value in zip(sums, (counts, best)):
                if known.any():
                    np.add.at(total, owner[known], value[at[known]] * times[known])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~known], minlength=len(lists)))]), pa.int32())
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~known], pa.int64())) for x in (flat, times)]
            kept = [batch.column(c) for c in ("row", "doc_id", *LONGS, "groups_sha256")]
            names = ["row", "doc_id", *LONGS, "groups_sha256", "count_sum", "n_best", "pairs", "times"]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, sums), *rest], names=names)

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold a pair linked, and whether no pair of its first id has more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    first = F.shiftright("pair", 32)
    # One row for each id of the first vocabulary.
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def token_alignment(
    docs: DataFrame,
    byte_level: str | None = None,
    pieces: str | None = None,
    head: int = HEAD_PAIRS,
) -> DataFrame:
    """Per document: tokens of both sides, groups, links and how common the links are.

    ``byte_level`` and ``pieces`` are paths of a byte-level BPE file and a sentencepiece
    model.  Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256.  Null and empty texts, and texts that either tokenizer does not give
    back byte by byte behind a space, have zeros and an empty digest.  Every row is a
    document of its own: repeated rows count again, rows without doc_id too.  An empty
    table gives no rows.

    Texts are tokenised once; each row's different pairs are stored and counted.  The
    commonest pairs, at most ``head``, are looked up in a table that every task has, so
    no pair left for the join is in more than one of ``head`` of all entries.
    """
    known = byte_level or public_tokenizer(BYTE_LEVEL_FILE), pieces or public_tokenizer(PIECE_FILE)
    aligned = stored(aligned_documents(docs, *known))
    counts = stored(pair_counts(aligned))
    # Counts in steps of a quarter of a doubling: at most some 250 rows.
    step = F.floor(F.log2("n") * 4)
    top, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        top += row["count"]
        if top > head:
            break
        least = row["step"]
    common = step >= least if least is not None else F.lit(False)
    table = counts.where(common).toArrow().sort_by("pair")
    columns = [np.asarray(table.column(c).combine_chunks().cast(pa.int64())) for c in ("pair", "n", "best")]
    schema = ALIGNED.replace("pairs ", "count_sum long, n_best long, pairs ")
    summed = stored(aligned.mapInArrow(_looked_up(*columns), schema))
    release(aligned)
    rare = summed.select("row", F.inline(F.arrays_zip("pairs", "times"))).join(counts.where(~common), F.col("pairs") == F.col("pair"))
    rest = rare.groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("c"), F.sum(F.col("best").cast("long") * F.col("times")).alias("b"))
    total = [(F.col(whole) + F.coalesce(F.col(part), F.lit(0))).alias(whole) for whole, part in (("n_best", "b"), ("count_sum", "c"))]
    return summed.join(rest, "row", "left").select("doc_id", *LONGS, *total, "groups_sha256")
