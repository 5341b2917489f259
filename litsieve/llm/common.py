"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

# A word is a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; extra columns can then clash with nothing."""
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in types.items()))


# Rows of one Arrow batch.  Spark's 10,000 are tens of megabytes of text, held by the
# JVM and by Python at once in every task.
TEXT_BATCH_ROWS = 1000
TEXT_BATCH_BYTES = 16 << 20


def texts(df: DataFrame, **types: str) -> DataFrame:
    """Like :func:`columns`, for tables whose texts go to Python: batches are kept small."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_BATCH_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", TEXT_BATCH_BYTES)
    return columns(df, **types)


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def return_memory() -> None:
    """Give freed memory back to the system.

    Arrow's pool and the C library keep it otherwise, and a worker process outlives its
    task: two idle workers then hold memory beside the ones at work.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


def memory_returned(run: Callable) -> Callable:
    """A task function that gives back what it has freed when its batches are done."""

    def returning(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            return_memory()

    return returning


def worker_value(key, make: Callable, small: bool = False):
    """What ``make`` gives, once per worker process: tasks that follow find it.

    Functions reach the workers by value, each with globals of its own, so the values
    are kept in a module that belongs to the process.  Workers outlive stages: of large
    values one is kept at a time, so the caches of one operator make room for the next.
    """
    kept = sys.modules.setdefault("litsieve_worker", types.ModuleType("litsieve_worker")).__dict__
    held = kept.setdefault("small" if small else "large", {})
    if key not in held:
        if not small and held:
            held.clear()
            return_memory()
        held[key] = make()
    return held[key]


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes | None]:
    """UTF-8 bytes of a text column, without a Python string per row."""
    column = batch.column(name)
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for value in binary:
        yield value.as_py()


def word_hashes(data: bytes, piece: int = 1 << 20) -> np.ndarray:
    """64-bit hash of every word; very long texts are split piece by piece."""
    parts, at = [], 0
    while at < len(data):
        end = at + piece
        # A piece ends before white space, so no word is cut.
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        words = data[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(data: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    words = word_hashes(data.translate(LOWER_ASCII)) if data else np.empty(0, np.uint64)
    if not len(words):
        return words
    last = max(1, len(words) - width + 1)
    total = np.full(last, min(len(words), width), np.uint64)
    for i in range(min(len(words), width)):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + last]
    return np.unique(mixed(total))
