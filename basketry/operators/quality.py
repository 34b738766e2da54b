"""Gates and assertions: each returns a status, or the rows that break a rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def circuit_breaker(daily: DataFrame, least_count: int = 10, volume: float = 0.70, velocity: float = 0.15, days: int = 7) -> DataFrame:
    """A status for each store and day from ``store, day, records, median_price``, all at once.

    EMPTY without records; VOLUME if the count is below ``volume`` of the median count of the ``days`` before (that median
    being at least ``least_count``); PRICE if the median price moved more than ``velocity`` from the last day before; else
    PASSED. Days without a row count as absent, not as zero.
    """
    number = F.datediff("day", F.lit("1970-01-01"))
    before = Window.partitionBy("store").orderBy(number).rangeBetween(-days, -1)
    along = Window.partitionBy("store").orderBy("day")
    out = daily.withColumns({"usual": F.array_sort(F.collect_list("records").over(before)), "last_price": F.lag("median_price").over(along)})
    n = F.size("usual")
    middle = F.when(n > 0, (F.get("usual", F.floor((n - 1) / 2).cast("int")) + F.get("usual", F.floor(n / 2).cast("int"))) / 2.0)
    out = out.withColumn("usual", middle)
    moved = F.abs(F.col("median_price") - F.col("last_price")) / F.nullif(F.col("last_price"), F.lit(0.0))
    status = F.when(F.col("records") == 0, "EMPTY").when((F.col("usual") >= least_count) & (F.col("records") < volume * F.col("usual")), "VOLUME").when(moved > velocity, "PRICE").otherwise("PASSED")
    return out.select("store", "day", "records", "median_price", "usual", "last_price", status.alias("status"))


def repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def outside(rows: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows with a value that is null, not above ``low``, or above ``high``."""
    return rows.where(F.col(value).isNull() | (F.col(value) <= low) | (F.col(value) > high))


def unit_math(rows: DataFrame, absolute: float = 5.0, relative: float = 0.005) -> DataFrame:
    """Rows whose unit price times amount is not their price, within both tolerances."""
    off = F.abs(F.col("unit_price") * F.col("amount") - F.col("price"))
    return rows.where((off > absolute) & (off > relative * F.col("price")))


def malformed(rows: DataFrame, code: str, pattern: str = r"^[0-9]{2}(\.[0-9]+){1,4}$") -> DataFrame:
    return rows.where(F.col(code).isNull() | ~F.col(code).rlike(pattern))


def store_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows that break ``rules`` (``store, division, kind``): ``only`` allows a store these divisions, ``never`` forbids them. The rules are few and are broadcast."""
    only = F.broadcast(rules.where("kind = 'only'").select("store", "division").distinct())
    bound = rows.join(F.broadcast(only.select("store").distinct()), "store", "left_semi").join(only, ["store", "division"], "left_anti")
    never = rows.join(F.broadcast(rules.where("kind = 'never'").select("store", "division").distinct()), ["store", "division"], "left_semi")
    return bound.unionByName(never)


def traps(rows: DataFrame, name: str, division: str, table: DataFrame) -> DataFrame:
    """Rows whose name holds a trap text but whose division is not the trap's (``text, expected``)."""
    return rows.join(F.broadcast(table), F.contains(F.lower(F.col(name)), F.col("text")) & (F.col(division) != F.col("expected")))


def fallback_share(rows: DataFrame, keys: Sequence[str], flag: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("records"), F.count_if(flag).alias("fallbacks"), F.round(100.0 * F.count_if(flag) / F.count("*"), 2).alias("share"))


def enough_sources(rows: DataFrame, by: str, source: str, least: int, warn: int) -> DataFrame:
    counts = rows.groupBy(by).agg(F.countDistinct(source).alias("sources"))
    return counts.withColumn("status", F.when(F.col("sources") < least, "FAILED").when(F.col("sources") < warn, "WARNING").otherwise("PASSED"))


def missing(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(present.select(key), key, "left_anti")


def weights_off(weights: DataFrame, total: float = 100.0, tolerance: float = 0.01) -> DataFrame:
    return weights.agg(F.sum("weight").alias("total")).where(F.abs(F.col("total") - total) > tolerance)


def checked(rows: DataFrame, rules: dict[str, Column], unique: Sequence[str] = ()) -> DataFrame:
    """``rule, failures`` for all rules in one pass: a row fails a condition that is false or null. With ``unique``, also the number of keys that stand more than once."""
    counts = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("failures")) for name in rules]))
    out = counts.select(pairs.alias("r")).select("r.*")
    return out.unionByName(repeated(rows, unique).agg(F.count("*").alias("failures")).select(F.lit("unique").alias("rule"), "failures")) if unique else out


def empty_sources(expected: DataFrame, daily: DataFrame, by: str = "store") -> DataFrame:
    """Expected sources with what they sent (``by, day, records`` of ``daily`` on any day): EMPTY without records on the last day of all, with the last day they had some (``repair_from``), else PASSED."""
    last = daily.agg(F.max("day")).first()[0]
    own = daily.where("records > 0").groupBy(by).agg(F.max("day").alias("repair_from"))
    out = expected.select(by).distinct().join(own, by, "left")
    passed = F.coalesce(F.col("repair_from") == F.lit(last).cast("date"), F.lit(False))
    return out.select(by, "repair_from", F.when(passed, "PASSED").otherwise("EMPTY").alias("status"))


def sizes_lost(rows: DataFrame, raw: str = "name_raw", clean: str = "name_clean") -> DataFrame:
    """Rows whose raw name has an amount with a unit but whose clean name has no unit."""
    units = "(ml|g|kg|oz|lb|l|gram|grams|kilo|kilos|liter|liters|litre|litres|mls|gm)"
    return rows.where(F.col(raw).rlike(rf"(?i)[0-9]+\s*{units}\b") & ~F.coalesce(F.col(clean), F.lit("")).rlike(rf"(?i){units}\b"))


def tariff_faults(tariffs: DataFrame, today: str, sources: Sequence[str]) -> DataFrame:
    """``source, fault`` of ``source, rate, representative, effective_from``: rates not above 0, missing or future dates, flags other than TRUE and FALSE, and sources without exactly one representative tariff."""
    bad = F.coalesce(F.col("rate") <= 0, F.lit(True)) | F.coalesce(F.col("effective_from") > F.lit(today).cast("date"), F.lit(True)) | ~F.coalesce(F.col("representative").isin("TRUE", "FALSE"), F.lit(False))
    rows = tariffs.where(bad).select("source", F.lit("row").alias("fault"))
    counts = tariffs.agg(*[F.count_if((F.col("source") == s) & (F.col("representative") == "TRUE")).alias(s) for s in sources])
    each = counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).alias("n")) for s in sources])).alias("c")).select("c.*")
    return rows.unionByName(each.where("n <> 1").select("source", F.lit("representative count").alias("fault")))
