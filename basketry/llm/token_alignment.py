"""Cross-tokenizer alignment by byte-owner arrays.

Both vocabularies' tokens are spread over the bytes of a text: ``np.repeat`` of the token numbers gives each byte its owner.
Runs of equal owner pairs are the overlaps of tokens, and bytes at which both owners change are the cuts between groups.

No token of either vocabulary reaches across a single space between two other characters, so a text is cut there first.
The pieces (mostly words) are encoded and aligned once and remembered by the task, and a text is put together from them.
A piece whose bytes do not come back has its whole text encoded at once instead.

Linked id pairs are counted over all documents on Spark. The commonest pairs, up to a fixed number, reach the tasks by
broadcast; occurrences of all others are joined with the table of counts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.store import kept
from basketry.llm.words import bounded_batches

FOLDER, BYTE_LEVEL, PIECES = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
MOST_PIECES, CHUNK = 200_000, 1 << 21  # pieces that a task remembers; characters of texts put together at once
MOST_PAIRS = 1 << 20  # linked pairs that are broadcast, with their counts: 17 bytes each
B_BITS, PAIR_BITS = 24, 48  # a pair is the A id, then the B id

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_UNEVEN = re.compile(r" \s|\s |\A | \Z")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a character: the visible ones of Latin-1 as themselves, the others in order from U+0100."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def _vocabularies(folder: str):
    """A worker's tokenisers, and the bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    with open(f"{folder}/{BYTE_LEVEL}", encoding="utf-8") as f:
        found = json.load(f)["model"]["vocab"]
    a, b = Tokenizer.from_file(f"{folder}/{BYTE_LEVEL}"), sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
    a.encode_special_tokens = True
    of, a_bytes = _byte_of_char(), [b""] * a.get_vocab_size()
    for entry, i in found.items():
        a_bytes[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
    names = [b.id_to_piece(i) for i in range(b.vocab_size())]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return a, b, a_bytes, b_bytes, np.array([len(x) for x in a_bytes]), np.array([len(x) for x in b_bytes])


def pieces(text: str) -> list[str]:
    """A text cut at the single spaces between characters that are not white space; the spaces go."""
    return _BETWEEN.split(text) if _UNEVEN.search(text) else text.split(" ")


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for one in lists for x in one), np.int64, int(sizes.sum())), sizes


def _by_unit(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the values of each unit."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Aligned:
    """Texts as units, encoded and aligned: counts by unit, the written groups, and the linked pairs of unit u at ``bounds[u]:bounds[u + 1]``. Units whose bytes do not come back are not ``whole`` and have no tokens."""

    def __init__(self, units: list[str], folder: str):
        a, b, a_bytes, b_bytes, a_len, b_len = _vocabularies(folder)
        ids_a, n_a = _flat([e.ids for e in a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)])
        ids_b, n_b = _flat(b.encode(units, num_threads=1))
        said = [b" " + u.encode() for u in units]
        size = np.fromiter(map(len, said), np.int64, len(said))
        self.whole = (_by_unit(a_len[ids_a], n_a) == size) & (_by_unit(b_len[ids_b], n_b) == size) & np.array([bool(u) for u in units], bool)
        text = b"".join(said)
        if not self.whole.all() or b"".join(map(a_bytes.__getitem__, ids_a.tolist())) != text or b"".join(map(b_bytes.__getitem__, ids_b.tolist())) != text:
            self._only_whole(said, ids_a, n_a, ids_b, n_b, a_bytes, b_bytes)
            ids_a, ids_b = ids_a[np.repeat(self.whole, n_a)], ids_b[np.repeat(self.whole, n_b)]
            n_a, n_b, size = n_a * self.whole, n_b * self.whole, size * self.whole
        self.n_a, self.n_b = n_a, n_b

        a_owner = np.repeat(np.arange(len(ids_a), dtype=np.int32), a_len[ids_a])
        b_owner = np.repeat(np.arange(len(ids_b), dtype=np.int32), b_len[ids_b])
        a_new, b_new = np.ones(len(a_owner), bool), np.ones(len(b_owner), bool)
        a_new[1:], b_new[1:] = a_owner[1:] != a_owner[:-1], b_owner[1:] != b_owner[:-1]
        overlap, cut = a_new | b_new, a_new & b_new
        self.n_links, self.n_groups = _by_unit(overlap, size), _by_unit(cut, size)
        self.pairs = (ids_a[a_owner[overlap]] << B_BITS) | ids_b[b_owner[overlap]]
        self.bounds = np.r_[0, np.cumsum(self.n_links)]
        group = np.cumsum(cut) - 1
        self.groups = self._written(ids_a, ids_b, group[a_new], group[b_new])

    def _only_whole(self, said, ids_a, n_a, ids_b, n_b, a_bytes, b_bytes) -> None:
        at_a, at_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
        for u in np.flatnonzero(self.whole).tolist():
            of_a, of_b = ids_a[at_a[u] : at_a[u + 1]].tolist(), ids_b[at_b[u] : at_b[u + 1]].tolist()
            self.whole[u] = b"".join(map(a_bytes.__getitem__, of_a)) == said[u] == b"".join(map(b_bytes.__getitem__, of_b))

    def _written(self, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
        ids, group = np.r_[ids_a, ids_b], np.r_[group_a, group_b]
        side = np.r_[np.zeros(len(ids_a), np.int8), np.ones(len(ids_b), np.int8)]
        order = np.lexsort((side, group))
        ids, group, side = ids[order], group[order], side[order]
        same_group, same_side = np.r_[group[1:] == group[:-1], False][: len(ids)], np.r_[side[1:] == side[:-1], False][: len(ids)]
        after = np.where(same_group, np.where(same_side, 0, 1), 2)
        said = [f"{i}{',|;'[k]}" for i, k in zip(ids.tolist(), after.tolist(), strict=True)]
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(said[s:e])[:-1] for s, e in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist(), strict=True)]


class Memory:
    """Pieces that a task has aligned, by number; forgotten when there are too many."""

    def __init__(self, folder: str):
        self.folder = folder
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.known: Aligned | None = None

    def add(self, new: list[str]) -> None:
        more = Aligned(new, self.folder)
        if self.known is None:
            self.known = more
            return
        old = self.known
        for name in ("whole", "n_a", "n_b", "n_links", "n_groups", "pairs"):
            setattr(old, name, np.concatenate([getattr(old, name), getattr(more, name)]))
        old.groups += more.groups
        old.bounds = np.r_[0, np.cumsum(old.n_links)]

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's pieces; what is new is aligned."""
        if len(self.number) > MOST_PIECES:
            self.forget()
        number, before = self.number, len(self.number)
        cut = [pieces(t) if t else [] for t in texts]
        out = [np.fromiter((number.setdefault(u, len(number)) for u in one), np.int64, len(one)) for one in cut]
        if len(number) > before:
            self.add(list(number)[before:])
        return out


def _rows(texts: list[str], memory: Memory) -> list[list]:
    """Columns of ALIGNED without the ids, for texts that are put together from remembered pieces."""
    units = memory.numbers(texts)
    known = memory.known
    if known is None:
        return [[0] * len(texts)] * 4 + [[""] * len(texts), [[]] * len(texts), [[]] * len(texts)]
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    flat = np.concatenate(units) if units else np.zeros(0, np.int64)
    sums = [_by_unit(x[flat], sizes) for x in (known.n_a, known.n_b, known.n_groups, known.n_links)]
    groups = [";".join(map(known.groups.__getitem__, one.tolist())) for one in units]

    keys, times = np.unique((np.repeat(np.arange(len(units)), sizes) << 32) | flat, return_counts=True)
    row, unit = keys >> 32, keys & 0xFFFFFFFF
    n = known.n_links[unit]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(known.bounds[unit], n)
    of, times = (np.repeat(row, n) << PAIR_BITS) | known.pairs[at], np.repeat(times, n)
    order = np.argsort(of, kind="stable")
    of, times = of[order], times[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, first) if len(first) else times
    of = of[first]
    ends = np.searchsorted(of >> PAIR_BITS, np.arange(len(units) + 1))
    pairs = of & ((1 << PAIR_BITS) - 1)
    out = [*(s.tolist() for s in sums), groups, [pairs[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)], [times[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]]
    for i in np.flatnonzero(_by_unit(~known.whole[flat], sizes)).tolist():  # some piece's bytes differ: the whole text decides
        one = Aligned([texts[i]], memory.folder)
        distinct, n = np.unique(one.pairs, return_counts=True)
        for column, value in zip(out, [int(one.n_a[0]), int(one.n_b[0]), int(one.n_groups[0]), int(one.n_links[0]), one.groups[0], distinct, n], strict=True):
            column[i] = value
    return out


def _align(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    memory = Memory(folder)
    for batch in batches:
        ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        row = 0
        while row < len(texts):
            to, size = row, 0
            while to < len(texts) and (to == row or size + len(texts[to]) <= CHUNK):
                size += len(texts[to])
                to += 1
            columns = _rows(texts[row:to], memory)
            arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays([ids.slice(row, to - row), *arrays], _NAMES)
            row = to


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
_NAMES = [c.split()[0] for c in ALIGNED.split(", ")]
_KINDS = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def alignments(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): numbers of tokens, groups and links, the groups themselves, and the linked pairs.

    A reads a space and the text, B the text, to which it adds the space; strings of special tokens are plain text.
    ``groups`` has the token ids between two places where tokens of both end, like ``a1,a2|b1;a3|b2,b3``. ``pairs`` has the
    distinct linked ids (A id times 2^24 plus B id), ``times`` how many links each has. Texts that are null, empty, or whose
    tokens' bytes differ from a space and the text have zeros, an empty string and empty arrays. Null ids and repeated rows
    stay; other columns are not read; an empty table gives an empty result. ``folder`` holds the vocabularies on every machine.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(partial(_align, folder=folder), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many rows of ``aligned`` the ids are linked, and whether no other B id is linked with the A id in more."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))  # as many rows as B has ids at most
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_a))


def _least_common(counts: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs are in so many documents."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("k")).collect()  # 63 rows at most
    total, least = 0, 1 << 62
    for row in by_size:
        total += row["n"]
        if total > most:
            break
        least = 1 << row["k"]
    return least


def _look_up(batches: Iterator[pa.RecordBatch], common: Broadcast) -> Iterator[pa.RecordBatch]:
    pairs, counts, best = common.value
    for batch in batches:
        found = batch.column(1)
        sizes = found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat, times = found.flatten().to_numpy(zero_copy_only=False), batch.column(2).flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
        hit = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
        n, is_best = (counts[at], best[at]) if len(pairs) else (np.zeros(len(flat), np.int64), hit)
        left = _by_unit(~hit, sizes)
        offsets = pa.array(np.r_[0, np.cumsum(left)].astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(_by_unit(np.where(hit, times * n, 0), sizes)), pa.array(_by_unit(np.where(hit & is_best, times, 0), sizes)),
            pa.ListArray.from_arrays(offsets, pa.array(flat[~hit])), pa.ListArray.from_arrays(offsets, pa.array(times[~hit]))], ["row", "count_sum", "n_best", "pairs", "times"])


def link_counts(aligned: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``aligned`` (of ``alignments``; its ``groups`` are not needed) without its arrays, with ``n_best`` (links whose pair is in as many documents as any pair of the A id) and ``count_sum`` (documents of each link's pair, summed). Every row counts as a document."""
    spark = aligned.sparkSession
    rows = kept(aligned.withColumn("row", F.monotonically_increasing_id()), "alignments")
    counts = kept(pair_counts(rows), "pair-counts")
    common = counts.where(F.col("n") >= _least_common(counts, most_pairs)).orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast(tuple(common.column(c).to_numpy() for c in ("pair", "n", "best")))
    looked = rows.select("row", "pairs", "times").mapInArrow(partial(_look_up, common=sent), "row long, count_sum long, n_best long, pairs array<long>, times array<long>")
    looked = kept(looked, "common-links")
    rare = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    rare = rare.join(counts, "pair").select("row", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"))
    sums = looked.select("row", "count_sum", "n_best").union(rare).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return rows.drop("pairs", "times").join(sums, "row").drop("row")
