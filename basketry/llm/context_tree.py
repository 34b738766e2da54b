"""Language-model scores by context-tree weighting, with a unigram score beside them.

A byte is eight binary decisions. Each decision has, for each context of 0 to ``DEPTH`` bytes before it, a
Krichevsky-Trofimov estimate from the training texts' counts; the estimates of all depths are mixed with the weights that
context-tree weighting gives them: at a node, 1/2 its own block probability against 1/2 the product of its children's. The
score of a text is the log10 probability of its bytes and an end mark; ``bits_per_byte`` is its code length.

Counting, weighting and scoring are Spark jobs. Tasks count strings of ``DEPTH`` context bytes and the next byte, whose
number grows with the corpus; the counts of one pair of last context bytes meet in one task, which has all deeper contexts
of that pair; the two depths above have a bounded number of nodes (256 * 255 and 255). The outcome is one log probability
for each counted string. The commonest strings and words, a bounded number, are broadcast, and texts are read once with
them; what a text has besides is joined with the table of all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.store import dropped, kept
from basketry.llm.toxicity import held_out
from basketry.llm.words import LOWER, U, Words, bounded_batches, chunks, mixed, signed

DEPTH, FOLD, HELD, PER_TASK = 6, 1, 1 << 22, 200_000
MOST_STRINGS, MOST_WORDS = 1 << 22, 1 << 20  # broadcast at most: 16 bytes for each, and an index
MARK = 255  # no byte of UTF-8: fills the context before a text, and ends it
STRING, WORD, END = 0, 1, 2


def _lowered(w: Words) -> np.ndarray:
    upper = (w.raw >= 65) & (w.raw <= 90)
    return w.raw + (upper.astype(np.uint8) << 5)


def _strings(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every row, and its end mark: the context (nearest byte first) and the byte, in one number. And where the rows begin."""
    sizes = np.diff(w.at)
    text = np.full(len(w.raw) + DEPTH * (w.rows + 1), MARK, np.uint8)
    shift = np.repeat(DEPTH * np.arange(1, w.rows + 1), sizes)
    text[np.arange(len(w.raw)) + shift] = _lowered(w)
    begins = w.at[:-1] + DEPTH * np.arange(1, w.rows + 1)
    bounds = np.r_[0, np.cumsum(sizes + 1)]
    place = np.arange(bounds[-1]) + np.repeat(begins - bounds[:-1], sizes + 1)
    out = text[place].astype(U)
    for i in range(1, DEPTH + 1):
        out |= text[place - i].astype(U) << U(8 * (DEPTH + 1 - i))
    return out, bounds


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(n, new) if len(new) else n


def _counted(keys: np.ndarray, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs in training rows (0: in others only)."""
    learned, n = np.unique(keys[trains], return_counts=True)
    others = np.unique(keys[~trains])
    return _merged([(learned, n), (others, np.zeros(len(others), np.int64))])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of strings, words and ends. A task unites what it has counted until ``HELD`` entries are held."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {STRING: [], WORD: []}
    ends = 0

    def sent(kind: int) -> pa.RecordBatch:
        keys, n = _merged(held[kind]) if held[kind] else (np.zeros(0, U), np.zeros(0, np.int64))
        held[kind].clear()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(signed(keys)), pa.array(n)], ["kind", "key", "n"])

    for batch in batches:
        trains = ~batch.column(0).to_numpy(zero_copy_only=False)
        ends += int(trains.sum())
        for w in chunks(batch.column(1), LOWER):
            own = trains[w.first : w.first + w.rows]
            keys, bounds = _strings(w)
            held[STRING].append(_counted(keys, np.repeat(own, np.diff(bounds))))
            held[WORD].append(_counted(w.hashes, np.repeat(own, np.diff(w.bounds))))
            for kind, parts in held.items():
                if sum(len(k) for k, _ in parts) > HELD:
                    parts[:] = [_merged(parts)]
                    if len(parts[0][0]) > HELD // 2:
                        yield sent(kind)
    yield sent(STRING)
    yield sent(WORD)
    yield pa.RecordBatch.from_arrays([pa.array([END], pa.int32()), pa.array([0], pa.int64()), pa.array([ends], pa.int64())], ["kind", "key", "n"])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series eight further on."""
    y, less = x + 8, np.zeros_like(x)
    for i in range(8):
        less += np.log(x + i)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - less


def log_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1.0)


@dataclass
class Layer:
    """Nodes of one depth and one bit: ``keys`` (context, bits before this one), counts, and the log of the weighted block probability."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray

    def own_weight(self) -> np.ndarray:
        """How much the estimate here counts against those of deeper contexts."""
        return np.exp(np.log(0.5) + log_block(self.zeros, self.ones) - self.weighted)


def _layer(contexts_and_bytes: np.ndarray, n: np.ndarray, bit: int, deeper: Layer | None) -> Layer:
    """Of sorted (context, byte) numbers with counts. A parent's key is its children's without the farthest context byte, which stands above the bits."""
    node = contexts_and_bytes >> U(8 - bit)
    new = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    is_one = ((contexts_and_bytes >> U(7 - bit)) & U(1)) == 1
    ones = np.add.reduceat(np.where(is_one, n, 0), new).astype(float)
    zeros = np.add.reduceat(n, new) - ones
    keys, own = node[new], log_block(zeros, ones)
    if deeper is None:
        return Layer(keys, zeros, ones, own)
    low = U((1 << bit) - 1)
    parent = ((deeper.keys >> U(8 + bit)) << U(bit)) | (deeper.keys & low)
    below = np.bincount(np.searchsorted(keys, parent), deeper.weighted, len(keys))
    return Layer(keys, zeros, ones, np.logaddexp(own, below) + np.log(0.5))


def _shortened(keys: np.ndarray, depth: int) -> np.ndarray:
    return ((keys >> U(8 * (DEPTH + 1 - depth))) << U(8)) | (keys & U(255))


def _tree(keys: np.ndarray, n: np.ndarray, top: int) -> Iterator[tuple[int, list[tuple[Layer, np.ndarray]]]]:
    """Each bit with its layers from depth ``DEPTH`` up to ``top``, each with the node of every key. One bit's layers are held at a time."""
    strings = [(short := _shortened(keys, depth), *_merged([(short, n)])) for depth in range(DEPTH, top - 1, -1)]
    for bit in range(8):
        layers: list[tuple[Layer, np.ndarray]] = []
        for short, distinct, own in strings:
            layer = _layer(distinct, own, bit, layers[-1][0] if layers else None)
            layers.append((layer, np.searchsorted(layer.keys, short >> U(8 - bit))))
        yield bit, layers


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """A task's strings, about ``PER_TASK`` of them or those of one pair of bytes, and their counts."""
    got = list(batches)
    if not got:
        return np.zeros(0, U), np.zeros(0, np.int64)
    keys, n = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in (0, 1))
    return keys.view(U), n


def _pair_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of depth 2 of this task's pairs: bit, key, counts and weighted block probability."""
    keys, n = _gathered(batches)
    for bit, layers in _tree(keys, n, 2) if len(keys) else ():
        x = layers[-1][0]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x.keys), bit, np.int32)), pa.array(signed(x.keys)), pa.array(x.zeros), pa.array(x.ones), pa.array(x.weighted)], ["bit", "key", "zeros", "ones", "weighted"])


def _string_scores(batches: Iterator[pa.RecordBatch], upper: Broadcast) -> Iterator[pa.RecordBatch]:
    """The log10 probability of each string's byte after its context."""
    keys, n = _gathered(batches)
    if not len(keys):
        return
    total = np.zeros(len(keys))
    for bit, layers in _tree(keys, n, 2):
        one = ((keys >> U(7 - bit)) & U(1)) == 1
        above = [(x, np.searchsorted(x.keys, _shortened(keys, d) >> U(8 - bit))) for d, x in ((1, upper.value[1][bit]), (0, upper.value[0][bit]))]
        p = np.zeros(len(keys))
        for i, (x, at) in enumerate([*layers, *above]):
            here = (np.where(one, x.ones[at], x.zeros[at]) + 0.5) / (x.zeros[at] + x.ones[at] + 1)
            weight = np.ones(len(keys)) if i == 0 else x.own_weight()[at]
            p = weight * here + (1 - weight) * p
        total += np.log10(p)
    yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n), pa.array(total)], ["key", "n", "value"])


def _upper(pairs: DataFrame) -> list[list[Layer]]:
    """The layers of depths 0 and 1, by bit: at most 255 and 256 * 255 nodes."""
    parent = F.expr("shiftleft(shiftright(key, 8 + bit), bit) | (key & (shiftleft(1L, bit) - 1))")
    sums = [F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]
    got = pairs.groupBy("bit", parent.alias("key")).agg(*sums).toArrow()
    bits, keys, zeros, ones, below = (got[c].to_numpy() for c in ("bit", "key", "zeros", "ones", "weighted"))
    out: list[list[Layer]] = [[], []]
    for bit in range(8):
        order = np.flatnonzero(bits == bit)
        order = order[np.argsort(keys[order])]
        one = Layer(keys[order].view(U), zeros[order], ones[order], np.logaddexp(log_block(zeros[order], ones[order]), below[order]) + np.log(0.5))
        root, which = np.unique(one.keys & U((1 << bit) - 1), return_inverse=True)
        z, o, b = (np.bincount(which, x, len(root)) for x in (one.zeros, one.ones, one.weighted))
        out[1].append(one)
        out[0].append(Layer(root, z, o, np.logaddexp(log_block(z, o), b) + np.log(0.5)))
    return out


@dataclass
class Lookup:
    """Values by 64-bit key, sorted by the key's mixed hash and indexed by its first bits; a lookup takes a step or two."""

    hashes: np.ndarray
    values: np.ndarray
    first: np.ndarray
    bits: int

    @staticmethod
    def of(keys: np.ndarray, values: np.ndarray) -> Lookup:
        hashes = mixed(keys.view(U))
        order = np.argsort(hashes)
        bits = max(1, int(len(keys)).bit_length())
        hashes = hashes[order]
        return Lookup(hashes, values[order], np.searchsorted(hashes >> U(64 - bits), np.arange(1 << bits, dtype=U)).astype(np.int32), bits)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys' values (0 where there is none), and whether they have one."""
        out, known = np.zeros(len(keys)), np.zeros(len(keys), bool)
        if not len(self.hashes):
            return out, known
        hashes = mixed(keys)
        at = self.first[hashes >> U(64 - self.bits)].astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            here = at[todo]
            todo, here = todo[here < len(self.hashes)], here[here < len(self.hashes)]
            found, want = self.hashes[here], hashes[todo]
            hit = found == want
            out[todo[hit]], known[todo[hit]] = self.values[here[hit]], True
            on = found < want
            todo = todo[on]
            at[todo] += 1
        return out, known


def _others(kind: int, row: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """Distinct (row, key) pairs, in the order of the rows, with their kind and how often each occurs."""
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])]) if len(row) else np.zeros(0, np.int64)
    return [row[new], np.full(len(new), kind, np.int32), signed(keys[new]), np.diff(new, append=len(row)).astype(np.int32)]


def _score_rows(batches: Iterator[pa.RecordBatch], strings: Broadcast, words: Broadcast) -> Iterator[pa.RecordBatch]:
    """By row, the sums over its common strings and words; and its other strings and words with their numbers."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        sums: list[list[np.ndarray]] = []
        others: list[list[np.ndarray]] = []
        for w in chunks(batch.column(2), LOWER):
            keys, bounds = _strings(w)
            row, word_row = np.repeat(np.arange(w.rows), np.diff(bounds)), w.row_of()
            value, known = strings.value.get(keys)
            more, seen = words.value.get(w.hashes)
            sums.append([np.add.reduceat(value, bounds[:-1]), np.diff(w.bounds), np.bincount(word_row[seen], minlength=w.rows), np.bincount(word_row, more, w.rows), np.diff(w.at)])
            parts = [_others(STRING, row[~known], keys[~known]), _others(WORD, word_row[~seen], w.hashes[~seen])]
            mine, kinds, rest, times = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(mine, kind="stable")
            others.append([w.first + mine[order], kinds[order], rest[order], times[order]])
        flat = [np.concatenate(x).astype(t) for x, t in zip(zip(*sums, strict=True), (float, np.int64, np.int64, float, np.int64), strict=True)] if sums else [np.zeros(0)] * 5
        arrays = [batch.column(0), batch.column(1), pa.array(number + np.arange(batch.num_rows)), *[pa.array(x, t) for x, t in zip(flat, (pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)]]
        number += batch.num_rows
        mine, *rest = [np.concatenate(x) for x in zip(*others, strict=True)] if others else [np.zeros(0, np.int64)] * 4
        at = pa.array(np.searchsorted(mine, np.arange(batch.num_rows + 1)).astype(np.int32))
        arrays += [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in zip(rest, (pa.int32(), pa.int64(), pa.int32()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "row_no", "value", "n_words", "known_words", "known", "n_bytes", "kinds", "keys", "times"])


ROW = "doc_id long, held_out boolean, row_no long, value double, n_words long, known_words long, known double, n_bytes long, kinds array<int>, keys array<long>, times array<int>"


def _octave(n: Column) -> Column:
    """Classes of counts, eight to an octave, so a table of them stays small."""
    return F.floor(8 * F.log2(n + F.lit(1.0)))


def _common(values: DataFrame, most: int) -> tuple[Lookup, DataFrame]:
    """From ``key, n, value``: the commonest, ``most`` at most, on the driver; and all others as a table. Where the line is, the counts decide."""
    sizes = dict(values.groupBy(_octave(F.col("n")).alias("c")).count().collect())
    line = max(sizes, default=0) + 1
    while sizes and line > min(sizes) and sum(k for c, k in sizes.items() if c >= line - 1) <= most:
        line -= 1
    got = values.where(_octave(F.col("n")) >= line).select("key", "value").toArrow()
    return Lookup.of(got["key"].to_numpy(), got["value"].to_numpy()), values.where(_octave(F.col("n")) < line)


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``, one row for each row of ``docs`` (``doc_id``, ``text``).

    Texts are lower-cased (A-Z). Tokens: words, as runs without ASCII white space, and an end. ``base_score`` adds up
    log10((c + 0.5) / (N + 0.5 * (V + 1))) over tokens, c being a token's count, N all and V the distinct ones in the texts
    that are not held out (remainder 1); ``n_known`` counts tokens with c > 0. ``score``: the log10 probability of the
    text's bytes and their end; ``bits_per_byte``: its code length over bytes and end. Null texts count as empty; rows with
    a null id train; repeated rows count and are scored each; an empty table gives an empty result. Rows are numbered once,
    in a written table, so a lost executor cannot mix them up. Other columns are not read.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    bounded_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), FOLD).alias("held_out"), F.col("text").cast("string").alias("text"))
    counts = own.select("held_out", "text").mapInArrow(_counts, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = kept(counts, "lm-counts")
    of_kind = {r.kind: r for r in counts.groupBy("kind").agg(F.count("*").alias("entries"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("learned")).collect()}
    entries = of_kind[STRING].entries if STRING in of_kind else 0
    ends = of_kind[END].n if END in of_kind else 0
    n = (of_kind[WORD].n if WORD in of_kind else 0) + ends
    v = (of_kind[WORD].learned if WORD in of_kind else 0) + (ends > 0)

    pair = F.shiftrightunsigned("key", 8 * (DEPTH - 1))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // PER_TASK))
    dealt = counts.where(F.col("kind") == STRING).select("key", "n").repartition(tasks, pair)
    pairs = kept(dealt.mapInArrow(_pair_nodes, "bit int, key long, zeros double, ones double, weighted double"), "lm-pairs")
    upper = sc.broadcast(_upper(pairs))
    scores = kept(dealt.mapInArrow(partial(_string_scores, upper=upper), "key long, n long, value double"), "lm-strings")
    dropped(pairs)

    strings, other_strings = _common(scores, MOST_STRINGS)
    words, other_words = _common(counts.where((F.col("kind") == WORD) & (F.col("n") > 0)).select("key", "n", F.log10(F.col("n") + 0.5).alias("value")), MOST_WORDS)
    rows = kept(own.mapInArrow(partial(_score_rows, strings=sc.broadcast(strings), words=sc.broadcast(words)), ROW), "lm-rows")

    rest = rows.select("row_no", F.explode(F.arrays_zip("kinds", "keys", "times")).alias("x")).select("row_no", F.col("x.kinds").alias("kind"), F.col("x.keys").alias("key"), F.col("x.times").alias("times"))
    others = other_strings.select(F.lit(STRING).alias("kind"), "key", "value").union(other_words.select(F.lit(WORD).alias("kind"), "key", "value"))
    rest = rest.join(others, ["kind", "key"], "left")
    is_word = F.col("kind") == WORD
    rest = rest.groupBy("row_no").agg(
        F.sum(F.when(~is_word, F.col("times") * F.col("value"))).alias("more_value"),
        F.sum(F.when(is_word, F.col("times") * F.coalesce("value", F.lit(float(np.log10(0.5)))))).alias("more_known"),
        F.sum(F.when(is_word & F.col("value").isNotNull(), F.col("times"))).alias("more_words"),
    )
    out = rows.drop("kinds", "keys", "times").join(rest, "row_no", "left").withColumn("n_tokens", F.col("n_words") + 1)
    out = out.withColumn("score", F.col("value") + F.coalesce("more_value", F.lit(0.0)))
    base = F.col("known") + F.coalesce("more_known", F.lit(0.0)) + float(np.log10(ends + 0.5)) - F.col("n_tokens") * float(np.log10(n + 0.5 * (v + 1)))
    known = F.col("known_words") + F.coalesce("more_words", F.lit(0)) + F.lit(int(ends > 0))
    bits = -F.col("score") / float(np.log10(2)) / (F.col("n_bytes") + 1)
    return out.select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score", bits.alias("bits_per_byte"))
