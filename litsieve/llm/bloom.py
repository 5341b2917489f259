"""Blocked Bloom filter of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from litsieve.llm.common import return_memory

# A block is eight words of 32 bits; an entry sets one bit in each.
BITS_PER_ENTRY = 16
BLOCK_BITS = 256
MAX_BLOCKS = 1 << 18  # 8 MB; longer lists raise the share of false positives, which the join removes
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)


def _positions(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of every hash, and its bit in each of the block's words."""
    bits = hashes.astype(np.uint64)
    block = (bits >> np.uint64(32)) % np.uint64(blocks)
    low = bits.astype(np.uint32)[:, None] * SALTS[None, :]
    return block.astype(np.int64), np.uint32(1) << (low >> np.uint32(27))


def build_filter(listed: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """Words of the filter, one row per block.

    Every task sets bits in blocks of its own; equal blocks are merged with a
    bitwise or before they reach the driver, which gets ``max_blocks`` rows at most.
    """
    hashed = listed.select(F.xxhash64(key).alias("h"))
    n = hashed.count()
    blocks = min(max_blocks, max(1, -(-n * BITS_PER_ENTRY // BLOCK_BITS)))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = _positions(np.asarray(batch.column(0)), blocks)
            own, place = np.unique(block, return_inverse=True)
            words = np.zeros((len(own), len(SALTS)), np.uint32)
            np.bitwise_or.at(words, place, bits)
            arrays = [pa.array(own), *(pa.array(words[:, i].astype(np.int64)) for i in range(len(SALTS)))]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", *(f"w{i}" for i in range(len(SALTS)))])

    schema = "block long, " + ", ".join(f"w{i} long" for i in range(len(SALTS)))
    merged = hashed.mapInArrow(partial, schema).groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(SALTS))))
    words = np.zeros((blocks, len(SALTS)), np.uint32)
    found = merged.toArrow()
    for i in range(len(SALTS)):
        words[np.asarray(found.column("block")), i] = np.asarray(found.column(f"w{i}")).astype(np.uint32)
    del found
    return_memory()
    return words


def may_be_listed(spark, words: np.ndarray):
    """Column function on a 64-bit hash; the filter's size is bounded by ``max_blocks``."""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def probe(hashes: pd.Series) -> pd.Series:
        block, bits = _positions(hashes.to_numpy(np.int64), len(shared.value))
        return pd.Series(((shared.value[block] & bits) == bits).all(axis=1))

    return probe
