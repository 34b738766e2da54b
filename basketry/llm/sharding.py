"""Sharding by a Feistel permutation of global row numbers, in DataFrame functions only.

Rows get dense numbers in an order that depends on their values alone. A keyed Feistel network permutes a grid just larger
than the number of rows; a row that lands outside walks on along the permutation's cycle until it is back inside. The place
``p`` that a row ends at gives its shard (``p`` modulo the number of shards) and its slot there (``p`` divided by it), so
the shuffle is the same in every run, on any number of machines, and anyone can compute where row number ``n`` is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.store import dropped, kept

SHARDS, ROUNDS, OVERHEAD = 24, 6, 8
SHORT_WALK, TRIED = 16, 2000  # steps that are tried before the long walk; grid heights that are tried
IN_PARTITION = 33  # bits that monotonically_increasing_id gives to a row's place in its partition


def grid(rows: int) -> tuple[int, int]:
    """Height and width of the smallest nearly square grid found with at least ``rows`` cells: fewer than its height lie beyond them."""
    low = max(1, math.isqrt(rows))
    return min(((a, max(1, -(-rows // a))) for a in range(low, low + TRIED)), key=lambda x: (x[0] * x[1] - rows, x[0]))


def permuted(place: Column, height: int, width: int, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """Where a Feistel network on the grid sends a cell: each round adds to one coordinate a number that depends on the other, which can be undone."""
    across = F.pmod(place, F.lit(width)).cast("long")
    begin = F.struct(((place - across) / width).cast("long").alias("down"), across.alias("across"))

    def turned(at: Column, number: Column) -> Column:
        # 60 bits of an MD5 sum, which any engine has, of the seed, the round and the coordinate that stays.
        stays = F.when(number % 2 == 0, at["across"]).otherwise(at["down"])
        drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), number.cast("string"), stays.cast("string"))), 1, 15), 16, 10).cast("long")
        down = F.when(number % 2 == 0, F.pmod(at["down"] + drawn, F.lit(height).cast("long"))).otherwise(at["down"])
        across = F.when(number % 2 == 1, F.pmod(at["across"] + drawn, F.lit(width).cast("long"))).otherwise(at["across"])
        return F.struct(down.alias("down"), across.alias("across"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), begin, turned, lambda at: at["down"] * width + at["across"])


def placed(numbered: DataFrame, rows: int, seed: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """``numbered`` (``number``: 0 to ``rows - 1``) with the ``place`` in that range that each row is sent to: the permutation, applied until it lands there.

    A cycle meets each cell beyond the rows once before it comes back, so a walk has at most one step more than there are
    such cells, fewer than the square root of the rows; hardly any takes more than two.
    """
    height, width = grid(rows)
    beyond = height * width - rows
    out = numbered.withColumn("place", permuted(F.col("number"), height, width, seed, rounds))
    for steps in sorted({min(SHORT_WALK, beyond), beyond} - {0}):
        walk = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("place"), lambda at, _: F.when(at < rows, at).otherwise(permuted(at, height, width, seed, rounds)))
        out = out.withColumn("place", F.when(F.col("place") < rows, F.col("place")).otherwise(walk))
    return out


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32`` with the row's ``number`` from 0, and the number of rows. Rows are in order of id (null first), size and checksums of the text, so only rows that are equal in all of these change places between runs."""
    text = F.col("text").cast("string")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.md5(F.coalesce(text, F.lit(""))).alias("text_md5"))
    own = kept(own.withColumn("tie", F.monotonically_increasing_id()), "shard-rows")
    # The last key has no equal values, so a range never has to hold all copies of a row.
    order = ["doc_id", "size", "text_crc32", "text_md5", "tie"]
    ranges = own.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = kept(ranges.select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("at")), "shard-order")
    dropped(own)

    part = F.shiftright("at", IN_PARTITION)
    parts = ranges.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row for each range
    parts = kept(parts.select("part", "n", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")), "shard-ranges")
    rows = parts.agg(F.sum("n")).first()[0] or 0
    out = ranges.withColumn("part", part).join(parts.select("part", "before"), "part")
    return out.select("doc_id", "size", "text_crc32", (F.col("before") + F.col("at").bitwiseAND((1 << IN_PARTITION) - 1)).alias("number")), rows


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): ``doc_id, size, text_crc32, number, place, shard, slot``.

    ``size`` is 8 plus the UTF-8 bytes of the text (null: none), ``text_crc32`` the unsigned checksum of these bytes. Row
    number ``number`` goes to ``shard`` 0 to ``shards - 1`` and its ``slot`` from 0 without gaps, so shards' counts are at
    most one apart, whatever the ids and texts are; equal texts are not kept together. Null ids come first, repeated rows
    have numbers of their own, an empty table gives an empty result, and other columns are not read.
    """
    rows, total = numbered(docs)
    place = F.col("place")
    return placed(rows, total, seed, rounds).withColumns({"shard": F.pmod(place, F.lit(shards)).cast("int"), "slot": ((place - F.pmod(place, F.lit(shards))) / shards).cast("long")})
