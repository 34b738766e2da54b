"""Connected components of a table of links, by alternating large-star and small-star steps on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.store import dropped, kept


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One step, written: all neighbours of a node that are larger than it (``large``), or all that are smaller and itself, are linked with the least of both. The least is written before the links are joined with it, so that Spark can split the links of a node that very many have."""
    if large:
        links = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        out = links.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = kept(links.groupBy("a").agg(F.min("b").alias("m")), "least")
        out = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    out = kept(out.distinct(), "links")
    dropped(least)
    return out


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``, longs) that is not the least of its component. Self-links and repeated links do no harm; links with a null are left out."""
    edges = _starred(links.where("a <> b").select("a", "b").distinct(), large=False)
    mark = _mark(edges)
    while True:
        far = _starred(edges, large=True)
        dropped(edges)
        edges = _starred(far, large=False)
        dropped(far)
        if (now := _mark(edges)) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now
