"""Vectorised word views of Arrow text columns.

Tasks see a text column as one UTF-8 buffer; words, their owners and their 64-bit hashes are found with numpy over that
buffer, a few megabytes at a time, so no Python object is made per word. Nulls count as empty texts.

Hashes are polynomials over 2**64 with a final mix; equal words always get equal hashes, and two of ``n`` different words
share one with a chance of about ``n * n / 2**65``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

U = np.uint64
ROWS_PER_BATCH, BYTES_PER_BATCH, CHUNK_BYTES = 2000, 16 << 20, 2 << 20
_BYTE_BASE, _WORD_BASE = U(0x9E6C63D0876A9A35), U(0xC2B2AE3D27D4EB4F)

_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def byte_table(delimiters: np.ndarray, lower: bool) -> np.ndarray:
    """What each byte stands for: 0 for a delimiter, else itself, or its lower case for A-Z if ``lower``."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[delimiters] = 0
    return table


def _not_alphanumeric() -> np.ndarray:
    out = np.ones(256, bool)
    out[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
    return out


# A NUL byte is a delimiter in ALNUM; in the other two it is a word byte and is told apart by NUL_AS.
PLAIN, LOWER = byte_table(_SPACES, False), byte_table(_SPACES, True)
ALNUM = byte_table(_not_alphanumeric(), True)
NUL_AS = 255  # 0xFF never occurs in UTF-8
PLAIN[0] = LOWER[0] = NUL_AS


def bounded_batches(spark: SparkSession, most: int = BYTES_PER_BATCH) -> None:
    """Keeps Arrow batches of texts small: tasks hold one batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def release() -> None:
    """Gives memory that this process has freed back to the system: Python workers live on and would hold it while others need it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # the C library may not have it
        ctypes.CDLL(None).malloc_trim(0)


class Trimmed:
    """A function for ``mapInArrow`` that gives memory back when its task ends."""

    def __init__(self, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        self.task = task

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from self.task(batches)
        finally:
            release()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each row starts (one more than rows)."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if large else np.int32
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of the rows ``first`` to ``first + rows``: ``starts`` and ``ends`` in ``data``, the bytes of ``raw`` by the table; row r has the bytes at[r] to at[r + 1] and the words bounds[r] to bounds[r + 1]."""

    first: int
    rows: int
    raw: np.ndarray
    at: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))

    def left(self) -> np.ndarray:
        """For each word, how many words its row has from it on, itself included."""
        return np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self.starts))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def chunks(texts: pa.Array, table: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a column, in runs of rows with ``most`` bytes each (one row at least)."""
    data, at = raw(texts)
    row, rows = 0, len(texts)
    while row < rows:
        to = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield _words(data[at[row] : at[to]], at[row : to + 1] - at[row], row, table)
        row = to


def _words(data: np.ndarray, at: np.ndarray, first: int, table: np.ndarray) -> Words:
    rows, none, unread = len(at) - 1, np.zeros(0, np.int64), data
    data = table[data]
    inside = data != 0
    if not inside.any():
        return Words(first, rows, unread, at, data, none, none, np.zeros(rows + 1, np.int64), np.zeros(0, U))
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(data))]
    begins[edge] = inside[edge]
    stops[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, at)
    gaps = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, gaps)
    np.minimum(place, np.repeat(ends - starts, gaps), out=place)
    factors = powers(_BYTE_BASE, int(place.max()) + 1)
    hashes = np.add.reduceat(data[starts[0] :].astype(U) * factors[place], starts - starts[0])
    return Words(first, rows, unread, at, data, starts, ends, bounds, mixed(hashes))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words from each word on; as if the words went on with zeros at the end."""
    # By the binary digits of length: out covers `done` words, step covers `size` words.
    out, done, step, size = np.zeros_like(hashes), 0, hashes, 1
    while True:
        if length & size:
            out = out + _shift(step, done) * _power(_WORD_BASE, done)
            done += size
        size *= 2
        if size > length:
            return mixed(out)
        step = step + _shift(step, size // 2) * _power(_WORD_BASE, size // 2)


def _power(base: np.uint64, n: int) -> np.uint64:
    return U(pow(int(base), n, 1 << 64))


def _shift(x: np.ndarray, n: int) -> np.ndarray:
    if not n:
        return x
    out = np.zeros_like(x)
    out[:-n] = x[n:]
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each place on (fewer at the end)."""
    size, best = 1, x.copy()
    while size * 2 <= width:
        best[:-size] = np.minimum(best[:-size], best[size:].copy())
        size *= 2
    if (more := width - size) and more < len(best):
        out = best.copy()
        out[:-more] = np.minimum(best[:-more], best[more:])
        return out
    return best


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
