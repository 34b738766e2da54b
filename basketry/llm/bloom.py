"""Blocked Bloom filters built by Spark and tested with numpy inside tasks.

A filter is an array of 512-bit blocks; a key's low bits choose a block and seven 9-bit slices of its hash choose bits in it,
so a test touches one cache line. The size is the caller's, and bounded: with too many keys it passes more, never fewer,
and callers remove what passes wrongly by an exact join or grouping.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.words import U, mixed

WORDS, SLICES, CHUNK = 8, 7, 512
MOST_BLOCKS = 1 << 18  # 16 MB


def blocks_for(keys: int, bits_per_key: int = 12, most: int = MOST_BLOCKS) -> int:
    """A power of two of blocks, ``most`` at most."""
    need = max(1, keys * bits_per_key // 512)
    return min(most, 1 << (need - 1).bit_length())


def _places(keys: np.ndarray, blocks: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For int64 keys: the words, and the bits in them, that a key sets."""
    first, hashes = (keys & (blocks - 1)) * WORDS, mixed(keys.view(U))
    for i in range(SLICES):
        bit = ((hashes >> U(9 * i)) & U(511)).astype(np.int64)
        yield first + (bit >> 6), np.left_shift(np.int64(1), bit & 63)


def _set_bits(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """This task's chunks of the filter; all keys of a chunk are here."""
    chunks: dict[int, np.ndarray] = {}
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for word, bit in _places(keys, blocks):
            order = np.argsort(word // CHUNK, kind="stable")
            word, bit = word[order], bit[order]
            numbers, at = np.unique(word // CHUNK, return_index=True)
            for number, a, z in zip(numbers.tolist(), at, [*at[1:], len(word)], strict=True):
                np.bitwise_or.at(chunks.setdefault(number, np.zeros(CHUNK, np.int64)), word[a:z] % CHUNK, bit[a:z])
    yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int64()), pa.array([c.tobytes() for c in chunks.values()], pa.binary())], ["chunk", "bits"])


def build(keys: DataFrame, blocks: int) -> np.ndarray:
    """The filter of the first column: 64-bit integers, nulls aside. Keys of a chunk of blocks meet in one task; the driver gets each chunk once."""
    key = F.col(keys.columns[0]).cast("long")
    dealt = keys.where(key.isNotNull()).select(key.alias("key")).repartition(F.shiftright(F.col("key").bitwiseAND(blocks - 1), 6))
    got = dealt.mapInArrow(partial(_set_bits, blocks=blocks), "chunk long, bits binary").toArrow()
    out = np.zeros((-(-blocks * WORDS // CHUNK), CHUNK), np.int64)
    for number, bits in zip(got["chunk"].to_pylist(), got["bits"].to_pylist(), strict=True):
        out[number] = np.frombuffer(bits, np.int64)
    return out.ravel()[: blocks * WORDS]


def maybe(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For int64 keys: False only where a key is surely absent."""
    found = np.ones(len(keys), bool)
    for word, bit in _places(keys, len(words) // WORDS):
        found &= (words[word] & bit) != 0
    return found
