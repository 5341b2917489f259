"""Removal of long repeated byte strings by deep-shallow sorting of suffixes.

Texts are packed into blocks.  Every string of ``length`` bytes has an anchor, its
inner k-gram of smallest hash, so equal strings have equal anchors.  The strings in a
row with one anchor are a segment.  Segments whose anchor occurs once hold no repeat;
of equal segments only the first can hold a first occurrence.  The suffixes of the
others are sorted: word by word to a shallow depth, then blind tries order the groups
that still agree.  Suffixes that agree over ``length`` bytes are one string.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from litsieve.llm.common import mixed, text_bytes, texts
from litsieve.session import shared_folder, stored

LENGTH = 100
ANCHOR = 32
BLOCK_BYTES = 1 << 21
# Positions of a slice of a block fit the low bits of a key, its hash the others.
SLICE_BYTES = 1 << 22
PLACE_BITS = 24
# Segments of one anchor that are sorted together; more are dealt to several parts.
PART_SEGMENTS = 1024
# Bytes of segments that one sort takes.
SORT_BYTES = 1 << 22
WORD = 8

BLOCKS = "block long, doc_ids array<long>, sizes array<long>, packed binary"
SEGMENT = "hash long, whole long, doc_id long, block long, at long, n long"


def _pack(limit: int):
    """Blocks of whole texts, about ``limit`` bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 33
        ids, sizes, parts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            whole = [[number], [ids], [sizes], [packer.compress(b"".join(parts))]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(whole, kinds)], names=["block", "doc_ids", "sizes", "packed"])

        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), text_bytes(batch)):
                if ids and size + len(data or b"") > limit:
                    yield block()
                    number, ids, sizes, parts, size = number + 1, [], [], [], 0
                ids.append(doc_id)
                sizes.append(len(data or b""))
                parts.append(data or b"")
                size += sizes[-1]
        if ids:
            yield block()

    return run


def blocks(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` packed into blocks, as a table bucketed by block.

    Later steps join lists to the blocks; the bucketing keeps the texts where they are.
    """
    spark = docs.sparkSession
    packed = texts(docs, doc_id="long", text="string").mapInArrow(_pack(limit), BLOCKS)
    name = f"blocks_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{name}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.format("parquet").option("compression", "none").option("path", path).bucketBy(parts, "block").saveAsTable(name)
    return spark.table(name)


def _unpacked(packed: bytes, size: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(size, 1))


# Random value of every byte and odd multipliers, from a fixed seed.
_DRAWN = np.random.default_rng(20_240_229).integers(0, 1 << 63, 272, np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(data: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all runs of each of ``widths`` bytes, which are growing powers of two."""
    out, h, n, step = [], _DRAWN[data], 1, 256
    for width in widths:
        while n < width:
            h = h[:-n] * _DRAWN[step] + h[n:]
            n, step = 2 * n, step + 1
            if n == 8:
                h = mixed(h)
        out.append(mixed(h))
    return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, low = 1, values
    while 2 * n <= width:
        low, n = np.minimum(low[:-n], low[n:]), 2 * n
    return np.minimum(low[: len(low) - (width - n)], low[width - n :]) if n < width else low


def segments(data: bytes, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Segments of texts that end at ``ends`` in ``data``.

    Returns the anchor's hash, a hash of all bytes, the first string's place and the
    number of strings of each.  Strings never cross an end.
    """
    empty = np.empty(0, np.int64)
    found = []
    for base in range(0, max(len(data) - length + 1, 0), SLICE_BYTES):
        part = np.frombuffer(data, np.uint8)[base : base + SLICE_BYTES + length - 1]
        short, wide = _grams(part, (anchor, 2 * anchor))
        place = np.arange(len(short), dtype=np.uint64)
        keys = short >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | place
        at = (_sliding_min(keys, length - anchor + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        starts = np.arange(len(at))
        owner = np.searchsorted(ends, starts + base, side="right")
        inside = np.flatnonzero(starts + base + length <= ends[owner])
        if not len(inside):
            continue
        run = np.flatnonzero(np.concatenate([[True], (np.diff(at[inside]) != 0) | (np.diff(inside) != 1) | (np.diff(owner[inside]) != 0)]))
        low = inside[run]
        n = np.diff(np.append(run, len(inside)))
        # Three runs of 2 * anchor bytes cover a segment: it has at most 2 * length - anchor bytes.
        rest = n + length - 1 - 2 * anchor
        whole = mixed(wide[low] * _DRAWN[270] + mixed(wide[low + rest // 2]) * _DRAWN[271] + mixed(wide[low + rest] + n.astype(np.uint64)))
        found.append((short[at[low]].view(np.int64), whole.view(np.int64), low + base, n))
    return tuple(map(np.concatenate, zip(*found))) if found else (empty,) * 4


def _block_rows(batches: Iterator[pa.RecordBatch], *others: str) -> Iterator[tuple]:
    """Number, document ids, ends, bytes and other columns of every block."""
    for batch in batches:
        for i in range(batch.num_rows):
            sizes = np.asarray(batch.column("sizes")[i].values, np.int64)
            ends = np.cumsum(sizes)
            data = _unpacked(batch.column("packed")[i].as_py(), int(ends[-1]))
            yield batch.column("block")[i].as_py(), batch.column("doc_ids")[i].values, ends, data, *(batch.column(c)[i] for c in others)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=names)


def _anchors(length: int, anchor: int):
    """Different anchors of every block, with the times they occur there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, ends, data in _block_rows(batches):
            hashes, times = np.unique(segments(data, ends, length, anchor)[0], return_counts=True)
            yield _batch("hash long, block long, times long", hashes, np.full(len(hashes), block), times)

    return run


def _owners(doc_ids: pa.Array, ends: np.ndarray, at: np.ndarray) -> pa.Array:
    return doc_ids.take(pa.array(np.searchsorted(ends, at, side="right")))


def _repeated(length: int, anchor: int):
    """Segments of listed anchors; of equal ones in a block only the first is not ``later``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, doc_ids, ends, data, wanted in _block_rows(batches, "hashes"):
            hashes, whole, at, n = segments(data, ends, length, anchor)
            listed = np.isin(hashes, np.asarray(wanted.values))
            hashes, whole, at, n = (x[listed] for x in (hashes, whole, at, n))
            ids = np.asarray(_owners(doc_ids, ends, at).fill_null(-(1 << 63)))
            order = np.lexsort((at, ids, whole, hashes))
            same = np.zeros(len(order), bool)
            same[1:] = (np.diff(hashes[order]) == 0) & (np.diff(whole[order]) == 0)
            later = np.empty(len(order), bool)
            later[order] = same
            yield _batch(f"{SEGMENT}, later boolean", hashes, whole, _owners(doc_ids, ends, at), np.full(len(at), block), at, n, pa.array(later))

    return run


def _with_bytes(length: int):
    """Listed segments with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, doc_ids, ends, data, wanted in _block_rows(batches, "wanted"):
            at, n, hashes, part, parts = (np.asarray(wanted.values.field(f)) for f in ("at", "n", "hash", "part", "parts"))
            cut = pa.array([data[a : a + m + length - 1] for a, m in zip(at.tolist(), n.tolist())], pa.binary())
            yield _batch(f"{SORTED}, bytes binary", hashes, part, parts, _owners(doc_ids, ends, at), np.full(len(at), block), at, cut)

    return run


SORTED = "hash long, part long, parts long, doc_id long, block long, at long"


class BlindTrie:
    """Strings of one length; inner nodes know only where their strings part.

    A node is ``(depth, children by byte)``, a leaf the list of its equal strings.
    """

    def __init__(self, get, length: int):
        self.get, self.length, self.root = get, length, None

    def insert(self, item: int) -> None:
        text, node = self.get(item), self.root
        if node is None:
            self.root = [item]
            return
        # Blindly down to any leaf, then compare once with what is stored there.
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(text[depth]) or next(iter(children.values()))
        other = self.get(node[0])
        if text == other:
            node.append(item)
            return
        differ = int.from_bytes(text) ^ int.from_bytes(other)
        common = self.length - 1 - (differ.bit_length() - 1) // 8
        above, key, node = None, 0, self.root
        while isinstance(node, tuple) and node[0] < common:
            above, key = node[1], text[node[0]]
            node = above[key]
        if isinstance(node, tuple) and node[0] == common:
            node[1][text[common]] = [item]
            return
        fork = (common, {other[common]: node, text[common]: [item]})
        if above is None:
            self.root = fork
        else:
            above[key] = fork

    def leaves(self) -> Iterator[list[int]]:
        """Lists of equal strings in ascending order."""
        stack = [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][byte] for byte in sorted(node[1], reverse=True)]
            else:
                yield node


def deep_shallow(data: bytes, places: np.ndarray, length: int, shallow: int | None = None) -> Iterator[list[int]]:
    """Groups of two or more ``places`` whose suffixes agree over ``length`` bytes.

    Shallow: a multikey sort, one word of eight bytes at a time over all open groups at
    once; a suffix that is alone in its group is done.  Deep: a blind trie for each
    group that still agrees after ``shallow`` bytes.
    """
    shallow = length * 4 // 5 // WORD * WORD if shallow is None else shallow
    padded = data + bytes(WORD)
    words = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    order, group = np.asarray(places), np.zeros(len(places), np.int64)
    for depth in range(0, shallow, WORD):
        key = words[order + depth].astype(np.uint64)
        turn = np.lexsort((key, group))
        order, group, key = order[turn], group[turn], key[turn]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(group) != 0) | (key[1:] != key[:-1])
        # Suffixes alone in their group stay out of the next round.
        shared = ~(fresh & np.append(fresh[1:], True))
        order, group = order[shared], np.cumsum(fresh)[shared]
        if not len(order):
            return
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(group) != 0, [True]])).tolist() if len(order) else []
    flat = order.tolist()
    for low, high in zip(bounds, bounds[1:]):
        trie = BlindTrie(lambda p: data[p + shallow : p + length], length - shallow)
        for place in flat[low:high]:
            trie.insert(place)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                yield leaf


def _sort(length: int):
    """Strings of a part that occur earlier in it, as ranges; first strings of split anchors by digest."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        whole = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(whole, kinds)], names=["doc_id", "block", "low", "high", "digest"])

    def sort(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        # In the order of documents and places, so smaller places come first.
        group.sort(key=lambda r: (r[3] is not None, r[3] or 0, r[4], r[5]))
        data = b"".join(r[6] for r in group)
        sizes = np.array([len(r[6]) for r in group])
        starts = np.cumsum(sizes) - sizes
        n = sizes - length + 1
        places = np.concatenate([np.arange(s, s + m) for s, m in zip(starts, n)])
        earlier = np.zeros(len(data) + 1, bool)
        for leaf in deep_shallow(data, places, length):
            leaf.sort()
            earlier[leaf[1:]] = True
        edges = np.flatnonzero(np.diff(earlier, prepend=False)).tolist()
        rows = []
        owners = np.searchsorted(starts, edges[::2], side="right") - 1
        for low, high, s in zip(edges[::2], edges[1::2], owners.tolist()):
            _, _, _, doc_id, block, at, _ = group[s]
            shift = at - int(starts[s])
            rows.append((doc_id, block, low + shift, high + shift + length - 1, None))
        for s, (_, _, parts, doc_id, block, at, text) in enumerate(group):
            if parts > 1:
                for i in np.flatnonzero(~earlier[starts[s] : starts[s] + n[s]]).tolist():
                    rows.append((doc_id, block, at + i, at + i + length, xxhash.xxh3_128_digest(text[i : i + length])))
            if len(rows) > 100_000:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SORT_BYTES and row[:2] != last:
                    yield from sort(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[6]), row[:2]
        if held:
            yield from sort(held)

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(with_text: bool):
    """Documents of a block without the ranges to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc_ids, ends, data, ranges in _block_rows(batches, "ranges"):
            low, high = [np.asarray(ranges.values.field(f)) if ranges.is_valid else np.empty(0, np.int64) for f in ("low", "high")]
            # Ranges never cross documents; those that overlap or touch are one span.
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order]) if len(order) else high
            owner = np.searchsorted(ends, low, side="right")
            first = np.ones(len(low), bool)
            first[1:] = (low[1:] > high[:-1]) | (np.diff(owner) != 0)
            starts = np.flatnonzero(first)
            spans = list(zip(low[starts].tolist(), high[np.append(starts[1:], len(low)) - 1].tolist() if len(low) else [], owner[starts].tolist()))
            out: list[list] = [[], [], [], [], []]
            at, begin = 0, 0
            for i, end in enumerate(ends.tolist()):
                kept, pos, n, removed = [], begin, 0, 0
                while at < len(spans) and spans[at][2] == i:
                    kept.append(data[pos : spans[at][0]])
                    pos, n, removed, at = spans[at][1], n + 1, removed + spans[at][1] - spans[at][0], at + 1
                kept.append(data[pos:end])
                rest = b"".join(kept)
                values = end - begin, removed, n, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace") if with_text else None
                for column, value in zip(out, values):
                    column.append(value)
                begin = end
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [doc_ids, *(pa.array(c, t) for c, t in zip(out, kinds))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + with_text], names=names[: 5 + with_text])

    return run


def repeated_ranges(packed: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, part_segments: int = PART_SEGMENTS) -> DataFrame:
    """``block, low, high``: byte ranges of a table of blocks covered by strings that start earlier too."""
    # Three runs of 2 * anchor bytes have to cover a segment.
    if anchor & (anchor - 1) or not 2 * anchor <= length <= 7 * anchor // 2:
        raise ValueError("anchor is a power of two, length two to three and a half times as much")
    by_hash = Window.partitionBy("hash")
    # A block lists an anchor once, so the rows of an anchor are at most the blocks.
    anchors = packed.mapInArrow(_anchors(length, anchor), "hash long, block long, times long")
    repeated = anchors.withColumn("n", F.sum("times").over(by_hash)).where("n > 1")
    lists = repeated.groupBy("block").agg(F.collect_list("hash").alias("hashes"))
    found = stored(packed.join(lists, "block").mapInArrow(_repeated(length, anchor), f"{SEGMENT}, later boolean"))

    order = Window.partitionBy("hash", "whole").orderBy(F.asc_nulls_first("doc_id"), "block", "at")
    placed = stored(found.where("not later").withColumn("place", F.row_number().over(order)))
    firsts = placed.where("place = 1")
    shared = firsts.groupBy("hash").agg(F.count(F.lit(1)).alias("segments")).where("segments > 1")
    parts = F.ceil(F.col("segments") / part_segments)
    dealt = firsts.join(shared, "hash").withColumns({"parts": parts, "part": F.pmod("whole", parts)})
    wanted = dealt.groupBy("block").agg(F.collect_list(F.struct("hash", "part", "parts", "at", "n")).alias("wanted"))
    cut = packed.join(wanted, "block").mapInArrow(_with_bytes(length), f"{SORTED}, bytes binary")
    tasks = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_parts = cut.repartition(tasks, "hash", "part").sortWithinPartitions("hash", "part")
    ranges = stored(sorted_parts.mapInArrow(_sort(length), "doc_id long, block long, low long, high long, digest binary"))

    again = Window.partitionBy("digest").orderBy(F.asc_nulls_first("doc_id"), "block", "low")
    across = ranges.where("digest is not null").withColumn("place", F.row_number().over(again)).where("place > 1")
    whole = [F.col("block"), F.col("at").alias("low"), (F.col("at") + F.col("n") + length - 1).alias("high")]
    span = ["block", "low", "high"]
    copies = found.where("later").select(*whole).unionByName(placed.where("place > 1").select(*whole))
    return copies.unionByName(ranges.where("digest is null").select(*span)).unionByName(across.select(*span))


def suffix_dedup(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    with_text: bool = False,
    block_bytes: int = BLOCK_BYTES,
    part_segments: int = PART_SEGMENTS,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in
    a smaller doc_id, or in the same document at an earlier place.  Texts are UTF-8
    bytes; matches never cross documents and are judged on the input.  ``n_spans``
    counts the maximal removed runs; ``with_text`` adds what is left, where a cut
    inside a character shows as U+FFFD.

    Null texts are empty.  Every row is a document: of rows with one doc_id the one
    read first is the earlier one, and rows without doc_id come before all others.  An
    empty table gives no rows.  Equal segments are told by 128 bits of hashes; all
    other strings are compared by their bytes.

    No key gathers more than a row per block: anchors and equal segments are combined
    in their block before any shuffle.  An anchor with very many different segments
    is sorted in parts, whose first strings then meet by digest.
    """
    packed = blocks(docs, block_bytes)
    ranges = repeated_ranges(packed, length, anchor, part_segments)
    lists = ranges.groupBy("block").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    return packed.join(lists, "block", "left").mapInArrow(_cut(with_text), RESULT + (", kept_text string" if with_text else ""))
