"""The star schema and the serving views over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import all_of, counted_share, geomean, pct_change, ratio
from basketry.functions.text import looked_up
from basketry.operators.index import modal
from basketry.operators.joins import latest


def daily_prices(obs: DataFrame) -> DataFrame:
    """The fact: for each day, store and item the geometric mean price, observations, whether one was promoted or all were, the commonest class."""
    keys = ["day", "store", "item"]
    out = obs.where("price > 0").groupBy(*keys).agg(geomean("price").alias("price"), F.count("*").alias("observations"), F.bool_or("on_promo").alias("any_promo"), F.bool_and("on_promo").alias("all_promo"), F.max("discount").alias("discount"))
    return out.join(modal(obs.where("price > 0"), keys, "class", "class"), keys, "left")


def dim_items(obs: DataFrame, as_of: str | Column, active_days: int = 90) -> DataFrame:
    """Items with their commonest name and class, first and last day, stores, and a status: active, dormant (not seen for ``active_days``) or, if seen on one day only, new."""
    today = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    stats = obs.groupBy("item").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("observations"), F.countDistinct("store").alias("stores"), F.bool_or("on_promo").alias("ever_promoted"))
    named = stats.join(modal(obs, ["item"], "name", "name"), "item", "left").join(modal(obs, ["item"], "class", "class"), "item", "left")
    status = F.when(F.datediff(today, "last_day") > active_days, "dormant").when(F.col("first_day") == F.col("last_day"), "new").otherwise("active")
    return named.withColumn("status", status)


def dim_stores(stores: DataFrame, facts: DataFrame) -> DataFrame:
    """Stores with what they have in the fact; stores without facts have zeros."""
    activity = facts.groupBy("store").agg(F.count("*").alias("facts"), F.countDistinct("item").alias("items"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return stores.join(activity, "store", "left").fillna(0, ["facts", "items"])


def coverage(facts: DataFrame, items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Observations, items and the shares that are classified and have a barcode, by ``keys``."""
    # Few items of a key are equal, so counting them before the shuffle would hold nearly all rows of a task in memory.
    joined = facts.join(items, "item", "left").repartition(*keys)
    known = F.coalesce(F.col("division") != "99", F.lit(False))
    return joined.groupBy(*keys).agg(F.count("*").alias("observations"), F.countDistinct("item").alias("items"), F.count_if(~known).alias("unclassified"), counted_share(known, 2).alias("classified_pct"),
                                     F.count("barcode").alias("barcodes"), counted_share(F.col("barcode").isNotNull(), 2).alias("barcode_pct"))


def scraper_daily(scrapes: DataFrame, facts: DataFrame) -> DataFrame:
    """Records scraped by store and day with what became of them, and a status."""
    own = facts.groupBy("day", "store").agg(F.countDistinct("item").alias("items"), F.avg("price").alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), counted_share(F.col("is_fallback"), 1).alias("fallback_pct"))
    status = F.when(F.col("records") == 0, "EMPTY_WARNING").when(F.col("fallback_pct") > 50, "FALLBACK_ACTIVE").otherwise("HEALTHY")
    return scrapes.join(own, ["day", "store"], "left").withColumns({"items": F.coalesce("items", "records"), "status": status})


def source_health(scrapes: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """Activity of the last days by store, and how fresh the newest is."""
    stats = scrapes.where(F.col("day") >= F.date_sub(today, days)).groupBy("store").agg(F.max("day").alias("last_day"), F.countDistinct("day").alias("active_days"), F.round(F.avg("records"), 0).alias("avg_records"))
    age = F.datediff(today, "last_day")
    health = F.when(age == 0, "ONLINE_FRESH").when(age <= 1, "ONLINE_YESTERDAY").when(age <= 3, "DELAYED_WARNING").otherwise("OFFLINE_CRITICAL")
    return stats.withColumns({"days_since": age, "health": health})


def price_alerts(facts: DataFrame, least: float = 0.20) -> DataFrame:
    """Moves of an item's price in a store by a fifth or more from the day it was seen before."""
    along = Window.partitionBy("store", "item").orderBy("day")
    moved = facts.where("price > 0").withColumn("before", F.lag("price").over(along)).where(F.col("before") > 0).withColumn("change", ratio(F.col("price") - F.col("before"), "before"))
    level = F.when(F.col("change") > 1.0, "CRITICAL_SPIKE").when(F.col("change") > 0.3, "HIGH_SURGE").when(F.col("change") < -0.5, "CRITICAL_DROP").when(F.col("change") < -0.3, "HIGH_DROP").otherwise("MODERATE_SHIFT")
    return moved.where(F.abs("change") >= least).withColumn("level", level)


def fx_health(rates: DataFrame) -> DataFrame:
    """Daily change of a rate. One row a day, so one window over all is small."""
    return rates.withColumn("change", pct_change("rate", F.lag("rate").over(Window.orderBy("day")), 3))


def inflation_summary(daily: DataFrame) -> DataFrame:
    along = Window.orderBy("day")
    totals = daily.groupBy("day").agg(F.max("headline").alias("headline"), F.max("core").alias("core"), F.sum("items").alias("items"))
    return totals.withColumns({f"{c}_change": pct_change(c, F.lag(c).over(along), 3) for c in ("headline", "core")})


def nowcast_evaluation(nowcasts: DataFrame, official: DataFrame) -> DataFrame:
    """Forecasts beside official values: error and whether the interval holds them."""
    joined = nowcasts.join(official, "month", "left")
    inside = F.coalesce(F.col("actual").between(F.col("low"), F.col("high")), F.lit(False))
    return joined.withColumns({"error": F.round(F.col("forecast") - F.col("actual"), 4), "inside": inside})


def benchmark(own: DataFrame, official: DataFrame) -> DataFrame:
    """Own and official monthly indices side by side (full outer), own ones rebased so that both agree in the first common month; errors and agreement of direction."""
    both = own.join(official, "month", "full")
    anchor = both.where("own IS NOT NULL AND official IS NOT NULL").agg(F.min_by(F.struct("own", "official"), "month").alias("a"))
    rebased = both.crossJoin(F.broadcast(anchor)).withColumn("rebased", F.col("own") / F.col("a.own") * F.col("a.official")).drop("a")
    along = Window.orderBy("month")
    out = rebased.withColumns({"own_change": pct_change("rebased", F.lag("rebased").over(along)), "official_change": pct_change("official", F.lag("official").over(along))})
    return out.withColumns({"error": F.col("rebased") - F.col("official"), "same_direction": F.signum("own_change") == F.signum("official_change")})


def accuracy(compared: DataFrame) -> DataFrame:
    """Root mean square and mean absolute error, correlation, share of months with the same direction."""
    return compared.where("error IS NOT NULL").agg(F.sqrt(F.avg(F.col("error") ** 2)).alias("rmse"), F.avg(F.abs("error")).alias("mae"), F.corr("rebased", "official").alias("correlation"),
                                                  F.avg(F.col("same_direction").cast("int")).alias("hit_rate"), F.count("*").alias("months"))


def top_movers(changes: DataFrame, n: int = 20) -> DataFrame:
    """The largest moves either way; ties by item and store."""
    return changes.orderBy(F.abs("change").desc(), "item", "store", "day").limit(n)


def contributions(ratios: DataFrame, weights: DataFrame, n: int = 25) -> DataFrame:
    """What items add to their division's distance from 100, by weight and number of items."""
    counts = ratios.groupBy("division").agg(F.count("*").alias("members"))
    joined = ratios.join(F.broadcast(weights), "division").join(F.broadcast(counts), "division")
    return joined.withColumn("contribution", (F.col("ratio") - 1) * 100 * F.col("weight") / F.col("members")).orderBy(F.abs("contribution").desc(), "item").limit(n)


def relative_histogram(moves: DataFrame) -> DataFrame:
    """Log relatives in steps of a tenth."""
    return moves.groupBy(F.round(F.ln("relative"), 1).alias("bin")).agg(F.count("*").alias("n"))


def day_matrix(scrapes: DataFrame, days: Sequence[str]) -> DataFrame:
    """Records of some days side by side."""
    return scrapes.groupBy("store").agg(*[F.count_if(F.col("day") == F.lit(d).cast("date")).alias(f"d{i}") for i, d in enumerate(days)])


def completeness(scrapes: DataFrame, first: str, last: str) -> DataFrame:
    """The share of the days of a span on which a store has records."""
    span = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date")) + 1
    inside = scrapes.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return inside.groupBy("store").agg(F.countDistinct("day").alias("days"), F.round(100.0 * F.countDistinct("day") / F.first(span), 2).alias("pct"))


def latest_by_store(scrapes: DataFrame) -> DataFrame:
    return latest(scrapes, ["store"], [F.desc("day"), F.desc("event_id")])


def optional(rows: DataFrame, **equal: object) -> DataFrame:
    """Filters by the parameters that are given; None means any."""
    conditions = [F.col(c) == v for c, v in equal.items() if v is not None]
    return rows.where(all_of(*conditions)) if conditions else rows


def class_mart(relatives: DataFrame, period: str = "month") -> DataFrame:
    """Class indices by period from relatives: ``period, division, class, class_index, items, observations, imputed``."""
    rows = relatives.where("ratio > 0").groupBy(period, "division", "class")
    return rows.agg((100 * geomean("ratio")).alias("class_index"), F.count("*").alias("items"), F.sum("observations").alias("observations"), F.count_if("imputed").alias("imputed"))


def subclass_view(relatives: DataFrame, names: Mapping[str, str], period: str = "month") -> DataFrame:
    """Two formulas and counts by period and code, with the codes' names (the code itself where there is none)."""
    rows = relatives.where("ratio > 0").groupBy(period, "division", "class")
    out = rows.agg(F.count("*").alias("relatives"), F.countDistinct("item").alias("items"), (100 * geomean("ratio")).alias("jevons"), (100 * F.avg("ratio")).alias("carli"), F.count_if("imputed").alias("imputed"))
    return out.withColumn("name", F.coalesce(looked_up(names, F.col("class")), "class"))


def product_view(relatives: DataFrame, code: str, period: str = "month") -> DataFrame:
    """One class by period: both formulas, its products, mean base and current price, and the change since the base in per cent."""
    rows = relatives.where((F.col("class") == code) & (F.col("ratio") > 0)).groupBy(period)
    return rows.agg(F.countDistinct("item").alias("products"), (100 * geomean("ratio")).alias("jevons"), (100 * F.avg("ratio")).alias("carli"), F.avg("base_price").alias("base_price"),
                    F.avg(F.col("base_price") * F.col("ratio")).alias("price"), ((geomean("ratio") - 1) * 100).alias("change"))
