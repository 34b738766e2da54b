"""Nearest vectors and similar pairs by cosine: exact in blocks, or through an inverted file of lists around centres.

Centres come from spherical k-means over a bounded sample; every row is indexed. Rows of a list and the queries that visit
it meet in blocks of bounded size, so a list that holds a third of all rows is many tasks, and only the best of a block are
shuffled on. How many lists a query visits is measured on the sample for a wanted recall; visiting all lists is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.sources.scratch import written

SAMPLE, MOST_LISTS, ROUNDS, TRIED = 16384, 4096, 12, 256  # sampled rows, lists, rounds of k-means, sampled queries that measure the recall
ROWS, QUERIES, STRIP = 16384, 4096, 64  # rows and queries of a block; queries scored at once


def units(rows: DataFrame) -> DataFrame:
    """``id, unit``: vectors of length 1 (those of length 0 stay 0); rows without an id, a vector or with a null or infinite part are left out."""
    vector = F.col("vector").cast("array<double>")
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda t, x: t + x * x))
    usable = rows.where("id IS NOT NULL AND vector IS NOT NULL").select(F.col("id").cast("long").alias("id"), vector.alias("vector"), length.alias("length")).where(F.col("length") < float("inf"))
    return usable.select("id", F.transform("vector", lambda x: F.when(F.col("length") > 0, x / F.col("length")).otherwise(x)).alias("unit"))


@dataclass(frozen=True)
class Lists:
    """Centres of an inverted file, and how many lists a search visits."""

    centres: np.ndarray
    probes: int

    def nearest(self, matrix: np.ndarray, n: int) -> np.ndarray:
        """The numbers of each row's ``n`` nearest centres, nearest first."""
        if not self.centres.shape[1]:  # nothing was sampled
            return np.zeros((len(matrix), 1), np.int64)
        return np.argsort(-(matrix @ self.centres.T), axis=1, kind="stable")[:, :n]


def _matrix(rows: list) -> np.ndarray:
    return np.array([r["unit"] for r in rows], np.float64).reshape(len(rows), len(rows[0]["unit"]) if rows else 0)


def _centres(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.bincount(own, minlength=lists) == 0
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300)
    return centres


def _sampled(rows: DataFrame, sample: int, seed: int) -> np.ndarray:
    """Up to ``sample`` rows by the order of their ids' hashes: the same in every run."""
    return _matrix(rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("unit").collect())


def _lists(rows: DataFrame, sample: int, lists: int | None, seed: int) -> tuple[np.ndarray, np.ndarray]:
    taken = _sampled(rows, sample, seed)
    if not len(taken):
        return taken, np.zeros((0, 0))
    wanted = lists or int(np.sqrt(rows.count()))
    return taken, _centres(taken, max(1, min(wanted, MOST_LISTS, -(-len(taken) // 8))), seed)


def fit_nearest(rows: DataFrame, k: int = 30, recall: float = 0.95, sample: int = SAMPLE, lists: int | None = None, seed: int = 0) -> Lists:
    """Lists over rows (``id, unit``) whose search finds a share ``recall`` of the ``k`` nearest rows, as measured for some of the sample against the whole sample. About the square root of the rows as lists, unless told."""
    taken, centres = _lists(rows, sample, lists, seed)
    if not len(taken):
        return Lists(np.zeros((1, 0)), 1)
    asked = taken[:TRIED]
    scores = asked @ taken.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    best = np.argsort(-scores, axis=1)[:, : min(k, len(taken) - 1)]
    home = np.argmax(taken @ centres.T, axis=1)
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1, kind="stable"), axis=1)  # by query and list: when it is visited
    needed = np.sort(np.take_along_axis(place, home[best], 1).ravel()) + 1
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else 1
    return Lists(centres, probes)


def fit_pairs(rows: DataFrame, least: float, recall: float = 0.999, sample: int = SAMPLE, lists: int | None = None, seed: int = 0) -> Lists:
    """Lists over rows (``id, unit``) in which a search meets a share ``recall`` of the neighbours with cosine ``least``, as measured with sampled rows and copies turned away just so far."""
    taken, centres = _lists(rows, sample, lists, seed)
    if not len(taken):
        return Lists(np.zeros((1, 0)), 1)
    rng = np.random.default_rng(seed + 1)
    base = taken[rng.choice(len(taken), 16 * TRIED)]
    away = rng.standard_normal(base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    home = np.argmax((least * base + np.sqrt(1 - least * least) * away) @ centres.T, axis=1)
    own = base @ centres.T
    needed = np.sort((own > own[np.arange(len(own)), home][:, None]).sum(axis=1)) + 1
    return Lists(centres, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]))


def _listed(batches: Iterator[pa.RecordBatch], index: Lists, n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        matrix = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        found = index.nearest(matrix, n) if batch.num_rows else np.zeros((0, n), np.int64)
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * found.shape[1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(found.ravel().astype(np.int32)))], ["id", "unit", "lists"])


def _visiting(rows: DataFrame, index: Lists | None, n: int) -> DataFrame:
    """``id, unit, list`` for the ``n`` lists next to each row; without an index there is one list."""
    if index is None:
        return rows.select("id", "unit", F.lit(0).alias("list"))
    return rows.select("id", "unit").mapInArrow(partial(_listed, index=index, n=min(n, len(index.centres))), "id long, unit array<double>, lists array<int>").select("id", "unit", F.explode("lists").alias("list"))


def _blocks(queries: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides (``id, unit, list``) with the blocks in which every query of a list meets every row of it: at most about QUERIES and ROWS of them."""
    counted = queries.groupBy("list").agg(F.count("*").alias("q")).join(rows.groupBy("list").agg(F.count("*").alias("r")), "list")
    parts = written(counted.select("list", F.ceil(F.col("q") / QUERIES).cast("int").alias("qs"), F.ceil(F.col("r") / ROWS).cast("int").alias("rs")), "list-parts")  # one row for each list
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    q = queries.join(parts, "list").select("list", own("qs").alias("q_part"), every("rs").alias("r_part"), "id", "unit")
    r = rows.join(parts, "list").select("list", every("qs").alias("q_part"), own("rs").alias("r_part"), "id", "unit")
    return q, r


def _sides(q: pa.Table, r: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    out = []
    for t in (q, r):
        ids = t["id"].to_numpy()
        matrix = t["unit"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        out += [ids[order], matrix[order]]
    return tuple(out)


def _best_of_block(q: pa.Table, r: pa.Table, k: int) -> pa.Table:
    """Each query's ``k`` best rows of a block; of equal ones the smaller ids."""
    (q_ids, q_matrix, ids, matrix), found = _sides(q, r) if q.num_rows and r.num_rows else (np.zeros(0),) * 4, [[], [], []]
    for at in range(0, len(q_ids), STRIP):
        asked = q_ids[at : at + STRIP]
        scores = q_matrix[at : at + STRIP] @ matrix.T
        scores[asked[:, None] == ids[None, :]] = -np.inf
        n = min(k, len(ids))
        limit = -np.partition(-scores, n - 1, axis=1)[:, n - 1 : n]
        above, equal = scores > limit, scores == limit
        keep = (above | (equal & (np.cumsum(equal, axis=1) <= n - above.sum(axis=1, keepdims=True)))) & np.isfinite(scores)
        row, column = np.nonzero(keep)
        for out, x in zip(found, (asked[row], ids[column], scores[row, column]), strict=True):
            out.append(x)
    kinds = (np.int64, np.int64, np.float64)
    return pa.table([pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind)) for x, kind in zip(found, kinds, strict=True)], ["query", "neighbour", "similarity"])


def _nearest(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    def best(q: pa.Table, r: pa.Table) -> pa.Table:
        return _best_of_block(q, r, k)

    q, r = (x.groupBy("list", "q_part", "r_part") for x in _blocks(queries, rows))
    found = q.cogroup(r).applyInArrow(best, "query long, neighbour long, similarity double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest_vectors(queries: DataFrame, rows: DataFrame, k: int = 30) -> DataFrame:
    """``query, neighbour, similarity, rank``: the ``k`` rows (``id, vector``) with the largest cosine for each query, itself aside. Exact: every query meets every row, in blocks.

    Null vectors are left out; vectors of length 0 have cosine 0; ties go to the smaller id.
    """
    asked, usable = written(units(queries), "vector-queries"), written(units(rows), "vectors")
    return _nearest(_visiting(asked, None, 1), _visiting(usable, None, 1), k)


def nearest_indexed(queries: DataFrame, rows: DataFrame, k: int = 30, recall: float = 0.95, sample: int = SAMPLE, lists: int | None = None) -> DataFrame:
    """As ``nearest_vectors``, but each query visits only as many lists as find a share ``recall`` of the neighbours in a sample of the rows. Every row is indexed."""
    asked, usable = written(units(queries), "vector-queries"), written(units(rows), "vectors")
    index = fit_nearest(usable, k, recall, sample, lists)
    return _nearest(_visiting(asked, index, index.probes), written(_visiting(usable, index, 1), "vector-lists"), k)


def _pairs_of_block(q: pa.Table, r: pa.Table, least: float) -> pa.Table:
    (q_ids, q_matrix, ids, matrix), found = _sides(q, r) if q.num_rows and r.num_rows else (np.zeros(0),) * 4, [[], [], []]
    for at in range(0, len(q_ids), STRIP):
        scores = q_matrix[at : at + STRIP] @ matrix.T
        row, column = np.nonzero(scores >= least)
        a, b = q_ids[at + row], ids[column]
        for out, x in zip(found, (np.minimum(a, b), np.maximum(a, b), scores[row, column]), strict=True):
            out.append(x[a != b])
    kinds = (np.int64, np.int64, np.float64)
    return pa.table([pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind)) for x, kind in zip(found, kinds, strict=True)], ["a", "b", "similarity"])


def similar_groups(rows: DataFrame, least: float, recall: float = 0.999, sample: int = SAMPLE, lists: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Groups of equal vectors, and the pairs of groups with cosine ``least`` or more: (``id, group``) and (``a, b, similarity``).

    A group is named by its smallest id, and copies are not expanded into pairs. Each group's vector stands in its own list
    and visits those next to it, so a pair is met from both sides: with a recall of 0.999 for one, about one in a million
    of the pairs just at ``least`` is missed, and hardly any nearer one. ``match.similar_pairs`` is exact. Vectors of length 0 and
    null ones belong to no group.
    """

    def scored(q: pa.Table, r: pa.Table) -> pa.Table:
        return _pairs_of_block(q, r, least)

    usable = written(units(rows).where(F.exists("unit", lambda x: x != 0)).distinct(), "vectors")
    named = written(usable.groupBy("unit").agg(F.min("id").alias("id")).select("id", "unit"), "distinct-vectors")
    members = usable.join(named.withColumnRenamed("id", "group"), "unit").select("id", "group")
    # Repeated ids with different vectors make groups of one name; their pairs stand for the name's.
    index = fit_pairs(named, least, recall, sample, lists)
    own = written(_visiting(named, index, 1), "vector-lists")
    q, r = (x.groupBy("list", "q_part", "r_part") for x in _blocks(_visiting(named, index, index.probes), own))
    pairs = q.cogroup(r).applyInArrow(scored, "a long, b long, similarity double")
    return members.distinct(), pairs.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
