"""Benchmark decontamination with suffix arrays of the training documents.

Documents are cut into shards of a few megabytes inside tasks. A shard's suffix array sorts the suffixes of its word
sequence, by doubling, as far as the longest benchmark item reaches; a suffix ends where its document ends or a word
follows that no item has. Every suffix of every benchmark item is looked up by binary search, one word after the other:
the range of suffixes that agree with it shrinks until nothing agrees, which gives the longest verbatim matches and their
places; the range after a whole window holds all places where the window occurs.

The benchmark comes in blocks of a bounded number of words. One block needs one pass without a shuffle; of several, each has
a pass of its own whose findings are written, its broadcast is destroyed, and the findings of a document are united.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.store import kept
from basketry.llm.words import ALNUM, Trimmed, Words, bounded_batches, chunks

WINDOW, BLOCK_WORDS, SHARD = 13, 1 << 20, 4 << 20
CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"


@dataclass
class Block:
    """Part of a benchmark: its items' words as codes, one item after the other; test suffix i begins at word i and ends with its item."""

    vocabulary: np.ndarray  # sorted word hashes; a word's code is its place plus 1
    codes: np.ndarray
    item: np.ndarray
    left: np.ndarray  # words of the suffix
    size: np.ndarray  # words of the window that begins here; 0 if the item has fewer left
    names: list[str]


def _codes(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.int64)


def _block(items: list[tuple[str, np.ndarray]], window: int) -> Block:
    vocabulary = np.unique(np.concatenate([h for _, h in items]))
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    n = np.array([len(h) for _, h in items])
    left = np.repeat(np.cumsum(n), n) - np.arange(n.sum())
    size = np.repeat(np.minimum(n, window), n)
    return Block(vocabulary, _codes(vocabulary, np.concatenate([h for _, h in items])), np.repeat([number[name] for name, _ in items], n), left, np.where(left >= size, size, 0), names)


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Broadcast]:
    """The benchmark (``item_id``, ``text``), broadcast in blocks of about ``block_words`` words, each fetched when it is asked for. Items with a null id or without words are left out."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    parts = -(-total // block_words)
    for i in range(parts):
        got = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).toArrow()
        items = []
        for name, text in zip(got["item_id"].to_pylist(), got["text"].to_pylist(), strict=True):
            for w in chunks(pa.array([text]), ALNUM):
                if len(w.hashes):
                    items.append((name, w.hashes))
        if items:
            yield benchmark.sparkSession.sparkContext.broadcast(_block(items, window))


def suffix_array(codes: np.ndarray, known: np.ndarray, reach: int) -> np.ndarray:
    """The words with a code, in the order of the suffixes that begin there, compared over ``reach`` words; ``known``: a suffix's words, from each place on."""
    order = np.flatnonzero(codes)
    order = order[np.argsort(codes[order], kind="stable")]
    if not len(order):
        return order
    new = np.r_[True, codes[order[1:]] != codes[order[:-1]]]
    rank, slots, done = np.zeros(len(codes) + 1, np.int64), np.arange(len(order)), 1
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
    while done < reach:
        # Only places whose suffixes still agree, and go on, are sorted again; they stand side by side.
        place = order[slots]
        first, second = rank[place], np.where(known[place] > done, rank[np.minimum(place + done, len(codes))], 0)
        by = np.lexsort((second, first))
        place, first, second = place[by], first[by], second[by]
        order[slots] = place
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))
        rank[place] = slots[start] + 1
        alone = new & np.r_[new[1:], True]
        slots = slots[~alone & (second > 0)]
        if not len(slots):
            break
        done *= 2
    return order


def _expanded(bounds_low: np.ndarray, bounds_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range: its number, repeated, and its entries."""
    size = bounds_high - bounds_low
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(bounds_low, size)


@dataclass
class Matches:
    """Of a shard: places where windows begin, and the test suffixes they begin; and for each word with a match its longest one and that one's item."""

    place: np.ndarray
    test: np.ndarray
    longest: np.ndarray
    item: np.ndarray


def search(w: Words, block: Block) -> Matches:
    """Looks up all test suffixes in the shard's suffix array."""
    codes, total = _codes(block.vocabulary, w.hashes), len(w.hashes)
    stop = np.where(codes == 0, np.arange(total), total)
    known = np.minimum(np.minimum.accumulate(stop[::-1])[::-1] - np.arange(total), w.left())
    order = suffix_array(codes, known, int(block.left.max()))
    longest, item = np.zeros(total, np.int64), np.zeros(total, np.int64)
    heads = codes[order]
    test = np.arange(len(block.codes))
    low, high = np.searchsorted(heads, block.codes, "left"), np.searchsorted(heads, block.codes, "right")
    places, tests, depth = [], [], 1
    while True:
        some = high > low
        test, low, high = test[some], low[some], high[some]
        if not len(test):
            break
        # Ranges of one depth are the same or apart; of tests with the same range the item that sorts last speaks.
        by = np.lexsort((block.item[test], low))
        last = by[np.r_[low[by][1:] != low[by][:-1], True]]
        of, slot = _expanded(low[last], high[last])
        longest[order[slot]], item[order[slot]] = depth, block.item[test[last]][of]
        whole = np.flatnonzero(block.size[test] == depth)
        if len(whole):
            of, slot = _expanded(low[whole], high[whole])
            places.append(order[slot])
            tests.append(test[whole][of])
        on = block.left[test] > depth
        test, low, high = test[on], low[on], high[on]
        want = block.codes[test + depth]
        low, high = _narrowed(codes, known, order, low, high, depth, want), _narrowed(codes, known, order, low, high, depth, want + 1)
        depth += 1
    none = np.zeros(0, np.int64)
    return Matches(np.concatenate([none, *places]), np.concatenate([none, *tests]), longest, item)


def _narrowed(codes: np.ndarray, known: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, want: np.ndarray) -> np.ndarray:
    """In each range, the first suffix whose word after ``depth`` words is not below the wanted one."""
    low, high = low.copy(), high.copy()
    todo = np.flatnonzero(high > low)
    while len(todo):
        middle = (low[todo] + high[todo]) >> 1
        place = order[middle]
        word = np.where(known[place] > depth, codes[np.minimum(place + depth, len(codes) - 1)], 0)
        below = word < want[todo]
        low[todo[below]], high[todo[~below]] = middle[below] + 1, middle[~below]
        todo = todo[high[todo] > low[todo]]
    return low


@dataclass
class Found:
    n_words: int
    hits: list[tuple[int, int]]  # from and to, not overlapping
    items: list[str]
    longest: int = 0
    longest_item: str | None = None
    longest_at: int | None = None

    @property
    def n_hit(self) -> int:
        return sum(z - a for a, z in self.hits)


def _search(texts: pa.Array, block: Block | None) -> Iterator[Found]:
    for w in chunks(texts, ALNUM, SHARD):
        total = len(w.hashes)
        if not total or block is None:
            yield from (Found(int(n), [], []) for n in np.diff(w.bounds))
            continue
        m, row = search(w, block), w.row_of()
        marks = np.zeros(total + 1, np.int64)
        np.add.at(marks, m.place, 1)
        np.add.at(marks, m.place + block.size[m.test], -1)
        hit = np.cumsum(marks[:-1]) > 0
        edge = np.r_[True, row[1:] != row[:-1]]
        starts = np.flatnonzero(hit & (edge | ~np.r_[False, hit[:-1]]))
        stops = np.flatnonzero(hit & np.r_[edge[1:] | ~hit[1:], True]) + 1
        hits: dict[int, list[tuple[int, int]]] = {}
        for r, a, z in zip(row[starts].tolist(), starts.tolist(), stops.tolist(), strict=True):
            hits.setdefault(r, []).append((a - int(w.bounds[r]), z - int(w.bounds[r])))
        items: dict[int, list[str]] = {}
        for r, i in np.unique(np.stack([row[m.place], block.item[m.test]], axis=1), axis=0).tolist():
            items.setdefault(r, []).append(block.names[i])
        most = np.zeros(w.rows, np.int64)
        np.maximum.at(most, row, m.longest)
        best = np.flatnonzero((m.longest == most[row]) & (m.longest > 0))
        best = best[np.lexsort((best, -m.item[best], row[best]))]
        at = dict(reversed([(r, i) for r, i in zip(row[best].tolist(), best.tolist(), strict=True)]))
        for r in range(w.rows):
            i = at.get(r)
            yield Found(int(w.bounds[r + 1] - w.bounds[r]), hits.get(r, []), items.get(r, []), int(most[r]), None if i is None else block.names[m.item[i]], None if i is None else i - int(w.bounds[r]))


def _report(batches: Iterator[pa.RecordBatch], block: Broadcast | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(_search(batch.column(2), block.value if block else None))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([x.n_words for x in found], pa.int64()),
                pa.array([x.n_hit for x in found], pa.int64()),
                pa.array([[{"a": a, "z": z} for a, z in x.hits] for x in found], pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))),
                pa.array([x.items for x in found], pa.list_(pa.string())),
                pa.array([x.longest for x in found], pa.int64()),
                pa.array([x.longest_item for x in found], pa.string()),
                pa.array([x.longest_at for x in found], pa.int64()),
            ],
            ["doc_id", "text_key", "n_words", "n_hit", "hits", "items", "longest_words", "longest_item", "longest_at"],
        )


REPORT = "doc_id long, text_key long, n_words long, n_hit long, hits array<struct<a: long, z: long>>, items array<string>, longest_words long, longest_item string, longest_at long"


def _united(parts: list[DataFrame]) -> DataFrame:
    """The findings of several blocks by document; equal rows are one document."""
    every = reduce(DataFrame.union, parts)
    best = F.max(F.struct("longest_words", "longest_item", -F.col("longest_at")))
    one = every.groupBy("doc_id", "text_key", "n_words").agg(F.flatten(F.collect_set("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), best.alias("best"))
    n_hit = F.expr("aggregate(array_sort(hits), struct(0L AS n, 0L AS z), (done, x) -> struct(done.n + greatest(0L, x.z - greatest(x.a, done.z)) AS n, greatest(done.z, x.z) AS z), done -> done.n)")
    return one.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), "hits", "items", "best.longest_words", "best.longest_item", (-F.col("best.col3")).alias("longest_at"))


def _findings(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, bool]:
    """What each row has of the benchmark, by ``doc_id, text_key``; and whether rows are all there, or equal ones are one."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    blocks, parts = benchmark_blocks(benchmark, window, block_words), []
    block = next(blocks, None)
    while True:
        found, after = own.mapInArrow(Trimmed(partial(_report, block=block)), REPORT), next(blocks, None)
        if after is None and not parts:
            return found, True
        parts.append(kept(found, "benchmark-hits"))
        block.destroy()
        block = after
        if block is None:
            return _united(parts), False


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document: how much of it occurs in the benchmark, and its longest verbatim match (of any length) with its place.

    Words are runs of ASCII letters (lower-cased), digits and other characters above ASCII. A window is ``window`` words in
    sequence of an item, or the whole of a shorter item; words of a document inside an occurrence of a window are hit. A
    document is contaminated if a twentieth of its words is hit. Null and empty texts have no words and no hits; null ids
    stay; repeated rows are judged one by one; an empty benchmark hits nothing; ties of the longest match go to the item id
    that sorts last, then to the first place. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    found, by_row = _findings(docs, benchmark, window, block_words)
    if not by_row:
        rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
        found = rows.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")))
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), F.expr(CONTAMINATED).alias("contaminated"), "longest_words", "longest_item", "longest_at")



def _clean(batches: Iterator[pa.RecordBatch], block: Broadcast | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _search(batch.column(batch.schema.get_field_index("text")).cast(pa.string()), block.value if block else None)
        yield batch.filter(pa.array([not (x.n_hit > 0 and 20 * x.n_hit >= x.n_words) for x in found], pa.bool_()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that are not contaminated, with all their columns unchanged."""
    bounded_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark, window, block_words)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        return docs.mapInArrow(Trimmed(partial(_clean, block=first)), docs.schema)
    first.destroy()
    second.destroy()
    found, _ = _findings(docs, benchmark, window, block_words)
    bad = found.where(CONTAMINATED).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left_anti")
