"""Weighted trees: validation, roll-up from leaves to the top, and mapping codes to leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.exprs import nonzero, weighted_geomean, weighted_mean
from basketry.sources.scratch import written


def roll_up(leaves: DataFrame, levels: Sequence[str], period: str, geometric_first: bool = False) -> DataFrame:
    """Indices of all levels, the nearest above the leaves first in ``levels``: ``period, level, code, index, weight``.

    ``leaves`` has the period, a column for each level, ``index`` and ``weight``. At each step members without an index leave
    their weight to the others, within their group; the group itself keeps the weight of all its members. Levels are few and
    known, so the tree needs no recursion.
    """
    out, rows = None, leaves
    for i, level in enumerate(levels):
        above = [period, *levels[i:]]
        mean = weighted_geomean if geometric_first and i == 0 else weighted_mean
        rows = rows.groupBy(*above).agg(mean("index", "weight").alias("index"), F.sum("weight").alias("weight"))
        here = rows.select(period, F.lit(level).alias("level"), F.col(level).cast("string").alias("code"), "index", "weight")
        out = here if out is None else out.unionByName(here)
    return out


def nodes_of(weights: DataFrame) -> DataFrame:
    """A tree from ``code, weight`` with dotted codes: adds ``parent, depth, division, is_leaf``."""
    parent = F.when(F.instr("code", ".") > 0, F.regexp_replace("code", r"\.[^.]*$", ""))
    nodes = weights.withColumns({"parent": parent, "depth": F.size(F.split("code", r"\.")), "division": F.split_part("code", F.lit("."), F.lit(1))})
    parents = nodes.select(F.col("parent").alias("__p")).where("__p IS NOT NULL").distinct()
    return nodes.join(parents, F.col("code") == F.col("__p"), "left").withColumn("is_leaf", F.col("__p").isNull()).drop("__p")


def faults(nodes: DataFrame, tolerance: float = 0.02, total: float = 100.0, total_tolerance: float = 0.01) -> DataFrame:
    """``code, fault`` for each broken rule: a parent that is missing, a weight not above 0 or above its parent's, children that don't add up to their parent, leaves that don't add up to the whole, repeated codes."""
    own = nodes.select("code", "parent", "weight", "is_leaf")
    up = own.select(F.col("code").alias("__code"), F.col("weight").alias("__weight"))
    joined = own.join(up, F.col("parent") == F.col("__code"), "left")
    per_node = joined.select("code", F.explode(F.array_compact(F.array(
        F.when(F.col("parent").isNotNull() & F.col("__code").isNull(), F.lit("no parent")),
        F.when(F.coalesce(F.col("weight"), F.lit(0.0)) <= 0, F.lit("weight not above 0")),
        F.when(F.col("weight") > F.col("__weight") + tolerance, F.lit("weight above parent"))))).alias("fault"))
    sums = own.where("parent IS NOT NULL").groupBy("parent").agg(F.sum("weight").alias("__sum")).join(up, F.col("parent") == F.col("__code"))
    uneven = sums.where(F.abs(F.col("__sum") - F.col("__weight")) > tolerance).select(F.col("parent").alias("code"), F.lit("children do not add up").alias("fault"))
    whole = own.where("is_leaf").agg(F.sum("weight").alias("s")).where(F.abs(F.col("s") - total) > total_tolerance).select(F.lit("*").alias("code"), F.lit("leaves do not add up").alias("fault"))
    twice = own.groupBy("code").count().where("count > 1").select("code", F.lit("repeated code").alias("fault"))
    return per_node.unionByName(uneven).unionByName(whole).unionByName(twice)


def heads(code: str = "code", most: int = 5):
    """A dotted code and its shorter heads, the longest first."""
    parts = F.split(code, r"\.")
    return F.transform(F.sequence(F.least(F.size(parts), F.lit(most)), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def map_to_leaf(items: DataFrame, nodes: DataFrame, hints: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Adds ``leaf`` to items (``item, code, name``).

    The code itself if it is a leaf; else under an ambiguous code the first of ``hints`` (code, word in the name, leaf) whose
    word occurs; else the longest head that is a leaf; else the heaviest leaf of the division (of several, the first code).
    Codes join with the tree on all their heads at once, which is one equi-join.
    """
    leaves = nodes.where("is_leaf").select(F.col("code").alias("__leaf"), "division", "weight")
    heaviest = leaves.groupBy("division").agg(F.min_by("__leaf", F.struct(-F.col("weight"), F.col("__leaf"))).alias("__heaviest"))
    hinted = F.coalesce(*[F.when((F.col("code") == c) & F.contains(F.lower("name"), F.lit(word)), F.lit(leaf)) for c, word, leaf in hints], F.lit(None).cast("string"))
    keyed = items.withColumn("__hint", hinted).select("*", F.posexplode(heads("code")).alias("__far", "__head"))
    found = keyed.join(F.broadcast(leaves.select("__leaf")), F.col("__head") == F.col("__leaf"), "left")
    best = found.groupBy("item").agg(F.min_by("__leaf", F.when(F.col("__leaf").isNotNull(), F.col("__far"))).alias("__near"), F.bool_or((F.col("__far") == 0) & F.col("__leaf").isNotNull()).alias("__exact"), F.first("__hint").alias("__hint"))
    out = items.join(best, "item", "left").withColumn("__division", F.split_part("code", F.lit("."), F.lit(1))).join(F.broadcast(heaviest), F.col("__division") == F.col("division"), "left")
    leaf = F.when(F.col("__exact"), F.col("__near")).otherwise(F.coalesce("__hint", "__near", "__heaviest"))
    return out.select(*items.columns, leaf.alias("leaf"))


def splice(annual: DataFrame, months: DataFrame) -> DataFrame:
    """Each month's splice factor: the last ``effective_from <= month`` of ``annual`` (``effective_from, factor``), else 1. The table has a row a year, so it is broadcast."""
    joined = months.join(F.broadcast(annual), F.col("effective_from") <= F.col("month"), "left")
    return joined.groupBy(*months.columns).agg(F.coalesce(F.max_by("factor", "effective_from"), F.lit(1.0)).alias("factor"))


def december_factors(daily: DataFrame) -> DataFrame:
    """From ``day, headline``: a row for each year: the December mean by 100, effective from January, and the December day with most observations (the first of several)."""
    december = daily.where("month(day) = 12").groupBy(F.year("day").alias("year"))
    out = december.agg((F.avg("headline") / 100).alias("factor"), F.min_by("day", F.struct(-F.col("observations"), F.col("day"))).alias("base_day"))
    return out.select(F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).alias("effective_from"), "factor", "base_day")


def coverage(weights: DataFrame, present: DataFrame) -> DataFrame:
    """The share of a tree's leaf weight that has an index."""
    joined = weights.join(present.withColumn("__has", F.lit(True)), "code", "left")
    return joined.agg((100 * F.sum(F.when(F.col("__has"), F.col("weight"))) / nonzero(F.sum("weight"))).alias("coverage"))


# -- trees of any depth


def _unlimited(spark: SparkSession) -> None:
    """A tree may have millions of leaves; paths that never meet a node twice end by themselves."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "-1")


def paths(nodes: DataFrame) -> DataFrame:
    """``code, root, depth, path`` of every node (``code, parent``) that a root (a node without a parent) leads to, by a recursive query. A node of several parents has several rows; a path never meets a node twice, so cycles end."""
    _unlimited(nodes.sparkSession)
    return nodes.sparkSession.sql("""
        WITH RECURSIVE walk(code, root, depth, path) AS (
            SELECT code, code, 0, array(code) FROM {nodes} WHERE parent IS NULL AND code IS NOT NULL
            UNION ALL
            SELECT n.code, w.root, w.depth + 1, array_append(w.path, n.code) FROM walk w JOIN {nodes} n ON n.parent = w.code WHERE NOT array_contains(w.path, n.code))
        SELECT code, root, depth, path FROM walk""", nodes=nodes.select("code", "parent").distinct())  # fmt: skip


def leaves_below(nodes: DataFrame) -> DataFrame:
    """``code, leaf`` for every node and each leaf below it; a leaf is below itself."""
    parents = nodes.select(F.col("parent").alias("code")).where("code IS NOT NULL").distinct()
    walked = paths(nodes).join(parents, "code", "left_anti")
    return walked.select(F.explode("path").alias("code"), F.col("code").alias("leaf")).distinct()


def path_faults(nodes: DataFrame) -> DataFrame:
    """``code, fault``: nodes that no root leads to, because a parent is missing (``lost``) or their parents lead back to themselves (``cycle``; ``below a cycle`` for what hangs on one), and nodes with several parents."""
    own = nodes.where("code IS NOT NULL").select("code", "parent").distinct()
    reached = paths(own).select("code").distinct()
    unreached = own.join(reached, "code", "left_anti")
    up = own.sparkSession.sql("""
        WITH RECURSIVE up(code, at, path, state) AS (
            SELECT code, parent, array(code), 'open' FROM {nodes}
            UNION ALL
            SELECT u.code, n.parent, array_append(u.path, u.at),
                   CASE WHEN u.at = u.code THEN 'cycle' WHEN array_contains(u.path, u.at) THEN 'below a cycle' WHEN n.code IS NULL THEN 'lost' ELSE 'open' END
            FROM up u LEFT JOIN {all} n ON n.code = u.at WHERE u.state = 'open' AND u.at IS NOT NULL)
        SELECT code, min_by(state, CASE state WHEN 'cycle' THEN 0 WHEN 'below a cycle' THEN 1 ELSE 2 END) AS fault FROM up WHERE state <> 'open' GROUP BY code""", nodes=unreached, all=own)  # fmt: skip
    several = own.groupBy("code").count().where("count > 1").select("code", F.lit("several parents").alias("fault"))
    return up.unionByName(several)


def roll_up_tree(leaves: DataFrame, nodes: DataFrame, period: str) -> DataFrame:
    """``period, code, index, weight`` of all nodes of a tree (``code, parent``) whose branches may end at any depth; ``leaves`` has the period, ``code``, ``index`` and ``weight``.

    From the deepest level upward, as in ``roll_up``: members without an index leave their weight to the others of their group, and a group keeps
    the weight of all its members. A period whose group has no member is missing. Raises ValueError for a tree with faults in its paths.
    """
    if bad := path_faults(nodes).limit(5).collect():
        raise ValueError(f"not a tree: {[tuple(r) for r in bad]}")
    placed = written(paths(nodes).select("code", "depth").join(nodes.select("code", "parent").distinct(), "code"), "tree-nodes")
    depth = placed.agg(F.max("depth")).first()[0] or 0
    done = leaves.select(period, "code", "index", "weight").join(placed.select("code"), "code", "left_semi").select(period, "code", "index", "weight")
    for level in range(depth, 0, -1):
        done = written(done, "tree-indices")
        below = done.join(placed.where(F.col("depth") == level).select("code", "parent"), "code")
        above = below.groupBy(period, F.col("parent").alias("code")).agg(weighted_mean("index", "weight").alias("index"), F.sum("weight").alias("weight"))
        done = done.unionByName(above)
    return done
