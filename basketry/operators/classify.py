"""Classification by a ladder of sources, each with its confidence, and the rules that it uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import any_of, col
from basketry.operators.joins import latest
from basketry.operators.rules import rule_hits
from basketry.sources.scratch import written

# The ladder's steps from the strongest, with their confidence, and default classes of divisions.
LADDER = [("cache", 1.0), ("override", 1.0), ("purity", 0.95), ("trap", 1.0), ("model", 0.85), ("global_override", 0.95), ("text_rule", 0.9), ("category", 0.9), ("store_default", 0.8)]
DEFAULT_CLASSES = {"01": "01.1.9", "02": "02.1.1", "03": "03.1.2", "04": "04.1.1", "05": "05.6.1", "06": "06.1.1", "07": "07.2.2", "08": "08.2.0", "09": "09.3.1", "10": "10.1.0", "11": "11.1.1", "12": "12.1.3"}
UNKNOWN = "UNCLASSIFIED"


def ladder(found: DataFrame, steps: Sequence[tuple[str, float]] = LADDER) -> DataFrame:
    """Adds ``division, code, method, confidence``: the first step that has a division. A step's columns are ``<step>_division`` and, if it knows the class, ``<step>_code``."""
    have = [(s, c) for s, c in steps if f"{s}_division" in found.columns]
    known = lambda s: F.col(f"{s}_division").isNotNull() & (F.col(f"{s}_division") != "")
    pick = lambda value: F.coalesce(*[F.when(known(s), value(s, c)) for s, c in have])
    code = pick(lambda s, _: F.coalesce(F.col(f"{s}_code") if f"{s}_code" in found.columns else F.lit(None).cast("string"), default_class(F.col(f"{s}_division")), F.lit(UNKNOWN)))
    return found.withColumns({
        "division": F.coalesce(pick(lambda s, _: F.col(f"{s}_division")), F.lit(UNKNOWN)), "code": F.coalesce(code, F.lit(UNKNOWN)),
        "method": F.coalesce(pick(lambda s, _: F.lit(s)), F.lit("none")), "confidence": F.coalesce(pick(lambda _, c: F.lit(c)), F.lit(0.0))})


def default_class(division: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in DEFAULT_CLASSES.items() for x in pair])
    return F.try_element_at(table, col(division))


def model_cache(answers: DataFrame) -> DataFrame:
    """The latest usable answer by normalised name (``name, code, classified_at``): no catch-all codes; division 13 reads as 12."""
    usable = answers.where("code NOT LIKE '99.9.9%'").withColumn("name", F.lower(F.trim("name")))
    last = latest(usable, ["name"], [F.desc("classified_at"), F.asc("code")])
    division = F.split_part("code", F.lit("."), F.lit(1))
    return last.select("name", F.when(division == "13", F.lit("12")).otherwise(division).alias("model_division"), F.when(division == "13", F.regexp_replace("code", "^13", "12")).otherwise(F.col("code")).alias("model_code"))


def to_reclassify(items: DataFrame, done: DataFrame, key: str, strong: Sequence[str] = ("cache", "override")) -> DataFrame:
    """Items without a settled class: never seen, unknown, or decided by another step than the strong ones."""
    settled = done.where((F.col("division") != UNKNOWN) & F.col("method").isin(*strong)).select(key)
    return items.join(settled, key, "left_anti")


def rewritten(code: Column | str, name: Column | str, rules: Sequence[tuple[str, str, str]]) -> Column:
    """A finer code by name: the first of ``rules`` (class, pattern, code) for the class whose pattern is in the name; else the code."""
    return F.coalesce(*[F.when((col(code) == c) & col(name).rlike(f"(?i){pattern}"), F.lit(to)) for c, pattern, to in rules], col(code))


def overrides(items: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``override_division`` and ``override_kind`` to items (``item, store, barcode, product_key, name``) by ``rules`` (``kind, value, store, division``).

    Kinds from the strongest: ``barcode``, ``product_key``, ``name`` with a store, ``name`` without one (everywhere). A name rule holds where its words
    stand in the name as whole words, in any case. Of several rules of one kind the longest value wins, then the smallest. Words and codes
    become keys of one equi-join, so rules may be many; names give one key for each run of words up to the longest rule's.
    """

    def words(text: str) -> Column:
        return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"([\p{L}\p{M}\p{N}_]+)"), F.lit(1))

    known = rules.select("kind", "value", F.nullif("store", F.lit("")).alias("store"), "division").where("trim(value) <> '' AND division IS NOT NULL")
    text = F.array_join(words("value"), " ")
    rank = F.when(F.col("kind") == "barcode", 0).when(F.col("kind") == "product_key", 1).when(F.col("store").isNotNull(), 2).otherwise(3)
    key = F.when(rank < 2, F.concat_ws("|", rank.cast("string"), F.trim("value"))).when(rank == 2, F.concat(F.lit("2|"), "store", F.lit("|"), text)).otherwise(F.concat(F.lit("3|"), text))
    keyed = known.where("kind IN ('barcode', 'product_key', 'name')").select(key.alias("__key"), rank.alias("__rank"), (-F.length("value")).alias("__long"), "value", "division", "kind")
    keyed = keyed.groupBy("__key").agg(F.min(F.struct("__rank", "__long", "value", "division", "kind")).alias("__rule"))
    longest = max(1, known.where("kind = 'name'").agg(F.max(F.size(words("value")))).first()[0] or 1)
    w = words("name")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))))
    named = F.concat(F.transform(runs, lambda r: F.concat(F.lit("2|"), "store", F.lit("|"), r)), F.transform(runs, lambda r: F.concat(F.lit("3|"), r)))
    keys = F.array_distinct(F.array_compact(F.concat(F.array(F.concat(F.lit("0|"), F.trim("barcode")), F.concat(F.lit("1|"), F.trim("product_key"))), named)))
    # Rules and items found grow with the input: neither is gathered on the driver for a broadcast.
    best = items.select("item", F.explode(keys).alias("__key")).join(keyed.hint("merge"), "__key").groupBy("item").agg(F.min("__rule").alias("__rule"))
    return items.join(best.hint("merge"), "item", "left").select(*items.columns, F.col("__rule.division").alias("override_division"), F.col("__rule.kind").alias("override_kind"))


def pattern_overrides(items: DataFrame, rules: DataFrame) -> DataFrame:
    """``overrides`` by name where values are regular expressions between word boundaries, in any case: adds ``override_division`` to items (``item, store, name``) by ``rules`` (``value, store, division``).

    A rule of the item's store goes before one for all stores (null or blank), then the longest value wins, then the smallest. Rules are
    tried behind their literals (``rules.rule_hits``), so they may be many.
    """
    known = rules.where("trim(value) <> '' AND division IS NOT NULL").select("value", F.nullif("store", F.lit("")).alias("scope"), "division")
    known = known.withColumn("pattern", F.concat(F.lit(r"\b(?:"), F.lower("value"), F.lit(r")\b")))
    # Of the rules of one pattern and scope the same one always wins, so only that is kept, and a pattern is tried once whatever its rules.
    first = F.struct((-F.length("value")).alias("shorter"), "value", "division")
    known = written(known.groupBy("pattern", "scope").agg(F.min(first).alias("first")), "override-rules")
    number = F.row_number().over(Window.orderBy("pattern"))  # a row a pattern
    tried = known.select("pattern").distinct().select(number.alias("rule"), "pattern", F.lit(None).cast("string").alias("negative_pattern"))
    rows = items.select(F.struct("item", "store").alias("row"), "name").repartition("row")  # a table of few files is dealt to all tasks
    hits = rule_hits(rows, written(tried, "override-patterns"), "row", "name").select("row.item", "row.store", "pattern")
    scopes = F.explode(F.array(F.struct(F.lit(False).alias("everywhere"), F.col("store").alias("scope")), F.struct(F.lit(True).alias("everywhere"), F.lit("").alias("scope"))))
    named = known.select("pattern", F.col("scope").isNull().alias("everywhere"), F.coalesce("scope", F.lit("")).alias("scope"), "first")
    found = hits.select("item", "pattern", scopes.alias("k")).select("item", "pattern", "k.*").join(named, ["pattern", "everywhere", "scope"])
    best = found.groupBy("item").agg(F.min(F.struct("everywhere", "first")).alias("best")).select("item", F.col("best.first.division").alias("override_division"))
    return items.join(best, "item", "left")


def guarded(division: Column | str, store: Column | str, only: dict[str, Sequence[str]], never: dict[str, Sequence[str]]) -> Column:
    """A model's division, or null where a store cannot have it: divisions of ``only`` belong to these stores alone, those of ``never`` to none of these."""
    d, s = col(division), F.coalesce(col(store), F.lit(""))
    barred = [(d == k) & ~s.isin(*stores) for k, stores in only.items()] + [(d == k) & s.isin(*stores) for k, stores in never.items()]
    return F.when(~F.coalesce(any_of(*barred), F.lit(False)), d) if barred else d


def store_rule_chain(name: str, store: str, rules: Sequence[tuple[str, str | None, Sequence[str], str]]) -> Column:
    """Text rules in order (pattern, pattern that forbids, stores left out, label): the first that holds; else null."""
    out = F.lit(None).cast("string")
    for pattern, forbidden, without, label in reversed(rules):
        hit = F.col(name).rlike(f"(?i){pattern}")
        hit = hit & ~F.col(name).rlike(f"(?i){forbidden}") if forbidden else hit
        hit = hit & ~F.coalesce(F.col(store), F.lit("")).isin(*without) if without else hit
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def classified(clean: DataFrame, classes: DataFrame, keys: Sequence[str] = ("item", "store")) -> DataFrame:
    """Clean rows with their class (``division, code, method``); rows without one keep nulls. Repeated classes count once, the smallest code first."""
    one = classes.groupBy(*keys).agg(F.min(F.struct("code", "division", "method")).alias("__c"))
    return clean.join(one, list(keys), "left").select(*clean.columns, *[F.col(f"__c.{c}").alias(c) for c in ("division", "code", "method")])
