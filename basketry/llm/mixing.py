"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be copied ``target / source size`` times; the whole part is certain, the rest is a
probability. Two players play for it: words worth of probability move from one to the other, in a direction drawn so that
no expectation changes, until one of them is settled. One player is the largest document that is open, the other one is
the rest of its bucket together, whose documents give and take in proportion; so large documents are settled against many
small ones, and the document left at the end is a small one. The moves keep the bucket's expected words. The documents left
over in the buckets meet again in a reduction tree, some tens of buckets at a time. The last one of a source is rounded to
the nearer side, so a source misses its target by half of that document at most.

Draws are hashes of the document, the seed and the tree's level, and buckets depend on the documents only, so reruns and
other cluster sizes give the same mix. Rows that agree in id, source and size are numbered, so each plays for itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.store import kept

WEIGHTS, SHARE, MOST_COPIES, BUCKET, FAN_IN, BLOCK = (5, 2, 1), 1.5, 2, 2_000, 32, 4096


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all sizes; a target stops at ``most`` times its source, and others take the excess by weight.

    Sources fill up in the order of size by weight. With the full ones set aside, one level per weight is left for the
    others: the first level that fills no further source holds.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.row_number().over(order) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", turn).withColumn("limit", most * F.col("source_size"))
    everywhere, filled = Window.partitionBy(F.lit(1)), Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    ranked = ranked.withColumns({
        "budget": share * F.sum("source_size").over(everywhere),
        "before": F.coalesce(F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    level = F.max(F.when((F.col("budget") - F.col("before")) * F.col("weight") <= F.col("limit") * F.col("open"), (F.col("budget") - F.col("before")) / F.col("open"))).over(everywhere)
    ranked = ranked.withColumn("level", level)
    return ranked.select("source", "source_size", F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("limit")), "limit").alias("target"))


FIELDS = [("key", pa.string()), ("bucket", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("size", pa.int64()), ("source_size", pa.int64()), ("target", pa.float64()),
          ("whole", pa.int64()), ("mass", pa.float64()), ("draw", pa.float64()), ("copied", pa.bool_())]
SCHEMA = "key string, bucket long, doc_id long, copy long, size long, source_size long, target double, whole long, mass double, draw double, copied boolean"
NAMES = [n for n, _ in FIELDS]
SIZE, MASS, DRAW = (NAMES.index(c) for c in ("size", "mass", "draw"))
NEAR = 1e-9  # part of a size that counts as nothing


def settle(sizes: Sequence[float], masses: Sequence[float], draws: Sequence[float]) -> tuple[list[bool | None], list[float]]:
    """Plays the documents of a bucket, given from the largest to the smallest: whether each is copied (None: still open, one at most), and the masses.

    A document's mass is its size times its probability. What the rest gives or takes changes all its probabilities by one
    linear map, ``scale * p + shift``, so a move costs the same however large the rest is.
    """
    rest_size, rest_mass = list(accumulate(reversed(sizes), initial=0))[-2::-1], list(accumulate(reversed(masses), initial=0.0))[-2::-1]
    scale, shift, out, left = 1.0, 0.0, [], []
    for size, mass, rest, before, draw in zip(sizes, masses, rest_size, rest_mass, draws, strict=True):
        own = scale * mass + shift * size
        others = scale * before + shift * rest
        room = rest - others
        if NEAR * size < own < size - NEAR * size and others > NEAR * rest and room > NEAR * rest:
            up, down = min(size - own, others), min(own, room)
            if draw * (up + down) < down:
                own += up
                by = 0.0 if up == others else 1 - up / others
                scale, shift = scale * by, shift * by
            else:
                own -= down
                by = 0.0 if down == room else 1 - down / room
                scale, shift = scale * by, 1 - (1 - shift) * by
        left.append(own)
        out.append(False if own <= NEAR * size else True if own >= size - NEAR * size else None)
    return out, left


def _pivot(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Settles documents. Rows come sorted by key, bucket and falling size; ``mass`` is the part of a document's size that is still at play. One bucket is held at a time; one row of it at most stays open, none at the last level."""
    held: list[tuple] = []

    def played() -> list[tuple]:
        copied, masses = settle([r[SIZE] for r in held], [r[MASS] for r in held], [r[DRAW] for r in held])
        if last:
            copied = [2 * m >= r[SIZE] if c is None else c for r, c, m in zip(held, copied, masses, strict=True)]
        return [(*r[:MASS], m, *r[DRAW:-1], c) for r, c, m in zip(held, copied, masses, strict=True)]

    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:2] != row[:2]:
                out += played()
                held = []
            held.append(row)
        yield _batch(out)
    yield _batch(played() if held else [])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(FIELDS)], schema=pa.schema(FIELDS))


def _draw(*of: Column) -> Column:
    """A number in [0, 1) that depends on the given values only."""
    return F.xxhash64(*of).bitwiseAND((1 << 53) - 1).cast("double") / float(1 << 53)


def _level(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    of = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("copy"), F.lit(seed), F.lit(level)]
    rows = rows.withColumns({"draw": _draw(*of), "copied": F.lit(None).cast("boolean")})
    rows = rows.select(*NAMES).repartition("key", "bucket").sortWithinPartitions("key", "bucket", F.desc("size"), "doc_id", "copy")
    return kept(rows.mapInArrow(partial(_pivot, last=last), SCHEMA), f"mix-level-{level}")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _numbered(groups: DataFrame) -> DataFrame:
    """One row for each of the ``n`` rows of a group, numbered from 1; first by blocks, so no array is long."""
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / BLOCK))))
    begin, end = F.col("block") * BLOCK + 1, F.least(F.col("n"), (F.col("block") + 1) * BLOCK)
    return blocks.withColumn("copy", F.explode(F.sequence(begin, end))).drop("block", "n")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_copies: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``, one row for each row of ``docs`` (``doc_id, source, text``).

    ``size`` is a document's number of words, ``taken`` is ``copies * size``. A null source is a source of its own; null
    and empty texts have size 0 and no copies; repeated rows and rows with null ids play each for themselves; an empty
    table gives an empty result. The table of sources is small beside the documents and is sorted in one task. Other
    columns are not read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"))
    own = kept(own.groupBy("doc_id", "key", "size").agg(F.count("*").alias("n")), "mix-sizes")
    by_source = own.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"))
    name = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("source")
    goals = targets(by_source.select(name, "source_size"), weights, share, most_copies)
    goals = kept(goals.withColumn("key", _key(F.col("source"))).drop("source").join(by_source.select("key", "documents"), "key"), "mix-targets")
    most = goals.agg(F.max("documents")).first()[0] or 0

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    buckets = F.ceil(F.col("documents") / BUCKET)
    plays = _numbered(own).join(goals, "key").withColumns({
        "whole": F.floor(rate).cast("long"), "mass": (rate - F.floor(rate)) * F.col("size"), "bucket": F.pmod(F.xxhash64("doc_id", "size", "copy"), buckets)})
    plays = plays.drop("documents")

    level, groups, settled = 0, -(-most // BUCKET), []
    while True:
        out = _level(plays, level, groups <= 1, seed)
        settled.append(out.where("copied IS NOT NULL"))
        if groups <= 1:
            break
        plays = out.where("copied IS NULL").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        level, groups = level + 1, -(-groups // FAN_IN)
    done = settled[0]
    for more in settled[1:]:
        done = done.union(more)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("copied").cast("long")).otherwise(F.lit(0).cast("long"))
    return done.select("doc_id", name, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_copies: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns and the number of their ``copies`` (a column of that name is replaced).

    Of rows that agree in id, source and size, those whose text's hash is smaller are taken first; nulls agree with nulls.
    """
    taken = mix(docs, weights, share, most_copies, seed).where("copies > 0").groupBy(F.col("doc_id").alias("__id"), _key(F.col("source")).alias("__key"), F.col("size").alias("__size"))
    taken = taken.agg(F.count("*").alias("__n"), F.min("copies").alias("__least"), F.max("copies").alias("__most"), F.sum("copies").alias("__sum"))
    rows = docs.drop("copies").withColumns({"__own_key": _key(F.col("source")), "__own_size": word_count(F.col("text"))}).where("__own_size > 0")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own_key") == F.col("__key")) & (F.col("__own_size") == F.col("__size"))
    rows = rows.join(taken, same)
    place = F.row_number().over(Window.partitionBy("doc_id", "__own_key", "__own_size").orderBy(F.xxhash64("text")))
    # Copies of a group's rows differ by one at most: the first rows have one more than the others.
    more = F.col("__sum") - F.col("__n") * F.col("__least")
    copies = F.when(F.col("__least") == F.col("__most"), F.when(place <= F.col("__n"), F.col("__least")).otherwise(0)).otherwise(F.when(place <= more, F.col("__most")).when(place <= F.col("__n"), F.col("__least")).otherwise(0))
    return rows.withColumn("copies", copies).where("copies > 0").select(*[c for c in docs.columns if c != "copies"], "copies")
