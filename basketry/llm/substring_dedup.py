"""Substring deduplication by level-wise doubling of repeated windows.

The first level looks at short windows, each next one at windows of twice the length, up to the wanted one. Of each wanted
window only its least window of the level (by hash) is taken, so equal wanted windows always bring an equal one, and few
words bring one. What repeats in another document is the candidate set of the next level: only wanted windows whose least
windows of all levels so far repeat are extended. At the wanted length windows are grouped, which decides exactly. Longer
repeats are unions of windows of the wanted length, so no candidate is left to extend there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import bloom
from basketry.llm.store import dropped, kept
from basketry.llm.words import PLAIN, Trimmed, Words, bounded_batches, chunks, signed, sliding_min, windows

LENGTH, FIRST = 50, 8


def levels(length: int, first: int = FIRST) -> list[int]:
    """Lengths that end with ``length``, each half of the next (rounded up), the least ``first`` words or fewer."""
    out = [length]
    while out[0] > max(first, 1):
        out.insert(0, -(-out[0] // 2))
    return out


def _least(w: Words, length: int, level: int, at: np.ndarray) -> np.ndarray:
    """Of the wanted windows that start at the words ``at``: the hash of their least window of the level."""
    return signed(sliding_min(windows(w.hashes, level), length - level + 1))[at]


def _candidates(w: Words, length: int, below: list[tuple[int, Broadcast]]) -> np.ndarray:
    """The words at which wanted windows start whose least window of each level below repeats."""
    at = np.flatnonzero(w.left() >= length)
    for level, again in below:
        if not len(at):
            break
        at = at[bloom.maybe(again.value, _least(w, length, level, at))]
    return at


def _level_windows(batches: Iterator[pa.RecordBatch], length: int, level: int, below: list[tuple[int, Broadcast]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for w in chunks(batch.column(2), PLAIN):
            at = _candidates(w, length, below)
            if not len(at):
                continue
            row, key = w.row_of()[at], _least(w, length, level, at)
            new = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(ids[w.first + row[new]])], ["window", "doc_id"])


def _full_windows(batches: Iterator[pa.RecordBatch], length: int, below: list[tuple[int, Broadcast]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for w in chunks(batch.column(2), PLAIN):
            at = _candidates(w, length, below)
            if not len(at):
                continue
            row = w.row_of()[at]
            spot = (keys[w.first + row].astype(np.int64) << 32) | (at - w.bounds[row])
            yield pa.RecordBatch.from_arrays([pa.array(signed(windows(w.hashes, length))[at]), pa.array(ids[w.first + row]), pa.array(spot)], ["window", "doc_id", "spot"])


def _text_key(text: Column) -> Column:
    """Tells texts of rows with equal ids apart."""
    return F.hash(text)


def repeated_windows(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, place``: the word at which a window of ``length`` words starts whose words also start somewhere in a document with a smaller id.

    Words are runs of characters other than ASCII white space, unchanged. Null texts and texts of fewer words have no
    windows; rows with a null id are left out. Rows with equal ids count as one document, which repeats nothing of its
    own; ``text_key`` (32 bits) says which of them a place is in.
    """
    if length < 2:
        raise ValueError("windows have two words at least")
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), _text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text"))
    again = [F.min("doc_id").alias("least"), F.max("doc_id").alias("most")]
    below: list[tuple[int, Broadcast]] = []
    for level in levels(length)[:-1]:
        found = own.mapInArrow(Trimmed(partial(_level_windows, length=length, level=level, below=list(below))), "window long, doc_id long")
        repeated = kept(found.groupBy("window").agg(*again).where("least < most").select("window"), f"repeated-{level}")
        below.append((level, spark.sparkContext.broadcast(bloom.build(repeated, bloom.blocks_for(repeated.count())))))
        dropped(repeated)
    full = kept(own.mapInArrow(Trimmed(partial(_full_windows, length=length, below=below)), "window long, doc_id long, spot long"), "windows")
    # Written, so the join's other side is no aggregate and adaptive execution can split a window with very many rows.
    firsts = kept(full.groupBy("window").agg(*again).where("least < most").select("window", "least"), "first-windows")
    places = full.join(firsts, "window").where("doc_id > least")
    return places.select("doc_id", F.shiftright("spot", 32).cast("int").alias("text_key"), F.col("spot").bitwiseAND((1 << 32) - 1).cast("int").alias("place"))


def _cut(batches: Iterator[pa.RecordBatch], length: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = batch.column("places")
        values, at = places.flatten().to_numpy(), np.zeros(len(places) + 1, np.int64)
        np.cumsum([0 if n is None else n for n in pc.list_value_length(places).to_pylist()], out=at[1:])
        n, removed, digests, left = [], [], [], []
        for w in chunks(batch.column("text"), PLAIN):
            whole = w.data.tobytes().replace(b"\xff", b"\0")
            for r in range(w.rows):
                a, b = w.bounds[r], w.bounds[r + 1]
                gone = np.zeros(b - a + 1, np.int32)
                starts = values[at[w.first + r] : at[w.first + r + 1]]
                starts = starts[starts + length <= b - a]
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + length, -1)
                stay = a + np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                text = b" ".join([whole[s:e] for s, e in zip(w.starts[stay].tolist(), w.ends[stay].tolist(), strict=True)])
                n.append(b - a)
                removed.append(b - a - len(stay))
                digests.append(hashlib.sha256(text).hexdigest())
                left.append(text.decode() if keep_text else None)
        more = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["n_words", "n_removed", "kept_sha256"]
        if keep_text:
            more, names = [*more, pa.array(left, pa.string())], [*names, "kept_text"]
        keep = [c for c in batch.schema.names if c not in ("text", "places")]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *more], [*keep, *names])


def substring_dedup(docs: DataFrame, length: int = LENGTH, keep_text: bool = True) -> DataFrame:
    """Every document (``doc_id``, ``text``) without the words of windows that a document with a smaller id has too.

    ``doc_id, n_words, n_removed, kept_sha256`` and, if asked for, ``kept_text`` (kept words joined by one space): one row
    for each row of ``docs``. Windows are judged on the input. A null or empty text has no words and keeps the empty text;
    a row with a null id keeps all words; of rows with equal ids none removes words of the other. Other columns are not read.
    """
    places = repeated_windows(docs, length).groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))
    joined = own.join(places, ["doc_id", "text_key"], "left").select("doc_id", "text", "places")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return joined.mapInArrow(Trimmed(partial(_cut, length=length, keep_text=keep_text)), schema)


def _replaced(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        text, places = (batch.column(names.index(c)) for c in ("text", PLACES))
        cut = next(_cut(iter([pa.RecordBatch.from_arrays([text.cast(pa.string()), places], ["text", "places"])]), length, True))
        touched = pc.greater(cut.column("n_removed"), 0)
        new = pc.if_else(touched, cut.column("kept_text"), text.cast(pa.string())).cast(text.type)
        arrays = [new if c == "text" else batch.column(c) for c in names if c != PLACES]
        yield pa.RecordBatch.from_arrays(arrays, [c for c in names if c != PLACES])


PLACES = "__repeated_places"


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with all their columns; where ``substring_dedup`` removes words, ``text`` is what it keeps, and elsewhere unchanged. Nulls stay null."""
    places = repeated_windows(docs, length).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_set("place").alias(PLACES))
    joined = docs.join(places, (F.col("doc_id") == F.col("__id")) & (_text_key(F.col("text")) == F.col("__key")), "left").drop("__id", "__key")
    return joined.mapInArrow(Trimmed(partial(_replaced, length=length)), docs.schema)
