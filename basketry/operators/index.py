"""The index engine: from price observations to elementary, class, division and headline indices, all periods in one plan.

A single period is a filter on the result. Medians of an item's few prices come from one grouping with sorted arrays; medians
of large groups come from counts of rounded values, which tasks add up before anything is shuffled. Nothing is looped over dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import clip, geomean, nonzero, weighted_geomean, weighted_mean
from basketry.sources.scratch import written

MAD_SCALE, MAD_LIMIT, MAD_LEAST, MAD_EPSILON = 1.4826, 3.5, 5, 1e-6
LOG_DIGITS, STEP = 6, 1024  # of rounded logs; rounded values counted as one at first


def robust_geomean(rows: DataFrame, keys: Sequence[str], value: str, out: str, low: float = 0.4, high: float = 2.5, extra: Sequence[Column] = ()) -> DataFrame:
    """Geometric mean of positive values by keys; with more than two, only of those between ``low`` and ``high`` times the median. One grouping: the values of a key (an item's prices of a period) meet in an array."""
    grouped = rows.groupBy(*keys).agg(_positive(value).alias("__seen"), *extra)
    return _with_geomean(grouped, "__seen", out, low, high)


def _positive(value: str) -> Column:
    """The positive values of a group, in order."""
    return F.array_sort(F.collect_list(F.when(F.col(value) > 0, F.col(value)).cast("double")))


def _with_geomean(grouped: DataFrame, values: str, out: str, low: float = 0.4, high: float = 2.5) -> DataFrame:
    """An ordered array of values replaced by their geometric mean; of more than two only those near the median count, none gives null."""
    n = F.size(values)
    middle = (F.element_at(values, F.floor((n + 1) / 2).cast("int")) + F.element_at(values, F.floor(n / 2 + 1).cast("int"))) / 2
    grouped = grouped.withColumn("__median", F.when(n > 0, middle))
    inside = F.filter(values, lambda x: (n <= 2) | x.between(low * F.col("__median"), high * F.col("__median")))
    logs = F.aggregate(F.col("__inside"), F.lit(0.0), lambda total, x: total + F.ln(x))
    mean = F.when(F.size("__inside") > 0, F.exp(logs / F.size("__inside")))
    return grouped.withColumn("__inside", inside).withColumn(out, mean).drop(values, "__median", "__inside")


def modal(rows: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """The commonest value by keys, the smallest of several; nulls don't count."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(out))


def _item_means(obs: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Robust means of ``values`` (column and name of the mean), ``observations`` and modal ``store`` by keys (the first is the period). One shuffle.

    Most items have one or two observations in a period: all of their prices count and the smaller store is the modal one, so plain sums do. Only
    those with more meet in arrays.
    """
    # An item has few prices in a period, so adding up before the shuffle would only cost.
    dealt = obs.select(*keys, *values, "store").repartition(keys[0], "item")
    n = F.count("*").alias("observations")
    few = dealt.groupBy(*keys).agg(*[geomean(v).alias(out) for v, out in values.items()], n, F.min("store").alias("store")).where("observations <= 2")
    many = dealt.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where("__n > 2")
    many = many.groupBy(*keys).agg(*[_positive(v).alias(f"__{v}") for v in values], n, F.mode("store", True).alias("store"))
    for v, out in values.items():
        many = _with_geomean(many, f"__{v}", out)
    return few.unionByName(many)


def item_prices(obs: DataFrame, period: str = "month") -> DataFrame:
    """``period, item, class, division, price, observations, store`` for each item and period: robust mean, number of observations, modal store (the smallest of several). One shuffle."""
    return _item_means(obs, [period, "item", "class", "division"], {"price": "price"}).where("price IS NOT NULL")


def first_relatives(prices: DataFrame, period: str = "month", shadow: bool = False) -> DataFrame:
    """``prices`` with ``base_period``, ``base_price`` and ``ratio`` against the item's first period in them: what ``elementary`` gives with the base of all periods, in one window and without a join. With ``shadow`` the first period is left out."""
    own = Window.partitionBy("item")
    out = prices.withColumns({"base_period": F.min(period).over(own), "base_price": F.min_by("price", period).over(own)})
    out = out.withColumn("ratio", F.col("price") / F.col("base_price")).where("ratio > 0")
    return out.where(F.col("base_period") < F.col(period)) if shadow else out


def base_prices(obs: DataFrame, base_from: str | None = None, period: str = "month", deep_promo: float | None = None) -> DataFrame:
    """``item, base_period, base_price, base_observations, first_seen``: the first period at or after ``base_from`` in which an item is seen. Observations with a discount of ``deep_promo`` or more are left out if the item has others then."""
    seen = obs.withColumn("first_seen", F.min(period).over(Window.partitionBy("item")))
    seen = seen.where(F.col(period) >= F.lit(base_from).cast("date")) if base_from else seen
    first = seen.withColumn("base_period", F.min(period).over(Window.partitionBy("item"))).where(F.col(period) == F.col("base_period"))
    if deep_promo is not None:
        deep = F.coalesce(F.col("discount") >= deep_promo, F.lit(False))
        first = first.withColumn("__all_deep", F.bool_and(deep).over(Window.partitionBy("item"))).where(~deep | F.col("__all_deep"))
    out = robust_geomean(first, ["item"], "price", "base_price", extra=[F.min("base_period").alias("base_period"), F.count("*").alias("base_observations"), F.min("first_seen").alias("first_seen")])
    return out.where("base_price > 0").select("item", "base_period", "base_price", "base_observations", "first_seen")


def register_base(registry: DataFrame, base: DataFrame) -> DataFrame:
    """A registry of base prices with the items that it lacks; known items keep their first base price."""
    return registry.unionByName(base.join(registry.select("item"), "item", "left_anti"))


def elementary(prices: DataFrame, base: DataFrame, period: str = "month", shadow: bool = False) -> DataFrame:
    """Price relatives to the base; with ``shadow``, an item's first period is only tracked and left out."""
    out = prices.join(base, "item").where(F.col(period) >= F.col("base_period")).withColumn("ratio", F.col("price") / F.col("base_price")).where("ratio > 0")
    return out.where(F.col("first_seen") < F.col(period)) if shadow else out


def unit_or_shelf(shelf_now: str, shelf_base: str, unit_now: str, unit_base: str) -> Column:
    """True where the unit price is to be compared: both are known, unless it moved threefold while the shelf price stayed within 0.70 to 1.40 (a changed pack)."""
    unit, shelf = F.col(unit_now) / F.col(unit_base), F.col(shelf_now) / F.col(shelf_base)
    known = F.coalesce((F.col(unit_now) > 0) & (F.col(unit_base) > 0), F.lit(False))
    return known & ~F.coalesce(((unit >= 3) | (unit <= 0.33)) & shelf.between(0.70, 1.40), F.lit(False))


def _group_median(rows: DataFrame, keys: Sequence[str], value: Column, out: str) -> DataFrame:
    """Medians by keys of values rounded to ``LOG_DIGITS``, and the numbers of values. Exact, and only counts are shuffled: of steps of ``STEP`` values first, which tell the one or
    two steps with the middle of a group, then of the values in these. ``rows`` is read twice. A written table, one row a group."""
    rounded = F.rint(value * float(10**LOG_DIGITS)).cast("long")
    valued = rows.select(*keys, rounded.alias("__v")).where("__v IS NOT NULL").withColumn("__step", F.floor(F.col("__v") / STEP))
    group = Window.partitionBy(*keys)
    # The middle of n values: those in places low and high, the same for an odd n.
    low, high = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    steps = valued.groupBy(*keys, "__step").agg(F.count("*").alias("__n"))
    steps = steps.withColumns({"__upto": F.sum("__n").over(group.orderBy("__step")), "__all": F.sum("__n").over(group)})
    steps = steps.where((F.col("__upto") >= low) & (F.col("__upto") - F.col("__n") < high))
    middle = written(steps.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__step").alias("__s"), (F.col("__upto") - F.col("__n")).alias("__before"), "__all"), "middle-steps")
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    near = valued.join(middle, [*same, F.col("__step") == F.col("__s")]).groupBy(*keys, "__v").agg(F.count("*").alias("__n"), F.first("__before").alias("__before"), F.first("__all").alias("__all"))
    near = near.withColumn("__upto", F.min("__before").over(group) + F.sum("__n").over(group.orderBy("__v")))
    at = lambda place: F.min(F.when(F.col("__upto") >= place, F.col("__v")))
    found = near.groupBy(*keys).agg(at(low).alias("__low"), at(high).alias("__high"), F.first("__all").alias(f"{out}_n"))
    return written(found.select(*keys, ((F.col("__low") + F.col("__high")) / 2 / float(10**LOG_DIGITS)).alias(out), f"{out}_n"), "medians")


def drop_outliers(rows: DataFrame, keys: Sequence[str], ratio: str = "ratio", low: float = 0.20, high: float = 4.0) -> DataFrame:
    """Relatives inside hard bounds and, in groups of five or more with some spread, within 3.5 scaled median absolute deviations of the log; otherwise within 0.33 to 3.

    Medians are of logs rounded to six digits. ``rows`` is read five times; give a written table where it is costly.
    """
    bounded = rows.where(F.col(ratio).between(low, high)).withColumn("__log", F.ln(ratio))
    centre = _group_median(bounded, keys, F.col("__log"), "__median")
    away = bounded.join(centre, list(keys))
    spread = _group_median(away, keys, F.abs(F.col("__log") - F.col("__median")), "__mad").drop("__mad_n")
    judged = away.join(spread, list(keys))
    limits = (F.col("__median_n") >= MAD_LEAST) & (F.col("__mad") > MAD_EPSILON)
    keep = F.when(limits, F.abs(F.col("__log") - F.col("__median")) <= MAD_LIMIT * MAD_SCALE * F.col("__mad")).otherwise(F.col(ratio).between(0.33, 3.0))
    return judged.where(keep).select(*rows.columns)


def jevons(rows: DataFrame, keys: Sequence[str], ratio: str = "ratio") -> DataFrame:
    """100 times the geometric mean of relatives."""
    return rows.groupBy(*keys).agg((100 * geomean(ratio)).alias("index"), F.count("*").alias("items"))


def carli_dutot(rows: DataFrame, keys: Sequence[str], now: str = "price", base: str = "base_price") -> DataFrame:
    """Three elementary formulas side by side."""
    return rows.groupBy(*keys).agg(
        (100 * geomean(F.col(now) / F.col(base))).alias("jevons"), (100 * F.avg(F.col(now) / F.col(base))).alias("carli"),
        (100 * F.avg(now) / F.avg(base)).alias("dutot"), F.count("*").alias("items"))


def store_balanced(rows: DataFrame, keys: Sequence[str], store: str = "store", ratio: str = "ratio", weight: str | None = None) -> DataFrame:
    """100 times the geometric mean over stores of their geometric means, equally or by ``weight`` (of several weights of a store, the largest). With one known store or none, all rows count alike; else rows without a store don't count."""
    stores = rows.groupBy(*keys, store).agg(geomean(ratio).alias("__mean"), F.count("*").alias("__n"), F.sum(F.ln(ratio)).alias("__sum"), *([F.max(weight).alias("__w")] if weight else []))
    known = F.when(F.col(store).isNotNull(), F.col("__mean"))
    balanced = weighted_geomean(known, "__w") if weight else geomean(known)
    flat = F.exp(F.sum("__sum") / F.sum("__n"))
    return stores.groupBy(*keys).agg((100 * F.when(F.count(known) >= 2, balanced).otherwise(flat)).alias("index"), F.count(known).alias("stores"), F.sum("__n").alias("items"))


def _numbered(prices: DataFrame, period: str) -> DataFrame:
    """The periods of ``prices`` with their numbers."""
    return prices.select(period).distinct().withColumn("__no", F.row_number().over(Window.orderBy(period)))


def _moves(prices: DataFrame, steps: DataFrame, period: str, low: float, high: float, values: Sequence[str] = ("price",)) -> DataFrame:
    """Items' moves from the period observed before (of all, not of the item) to this one, inside the bounds: of the first of ``values`` that is known in both."""
    numbered = prices.join(F.broadcast(steps), period)  # one row a period
    item = Window.partitionBy("item").orderBy("__no")
    moved = F.coalesce(*[F.when((F.col(v) > 0) & (F.lag(v).over(item) > 0), F.col(v) / F.lag(v).over(item)) for v in values])
    return numbered.withColumns({"__move": moved, "__last": F.lag("__no").over(item)}).where("__last = __no - 1").where(F.col("__move").between(low, high))


def movements(prices: DataFrame, keys: Sequence[str], period: str = "month", low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Geometric mean of items' moves from the period observed before (of all, not of the item) to this one, by keys; moves beyond the bounds are left out. ``prices`` has one row for an item and period."""
    return _moves(prices, _numbered(prices, period), period, low, high).groupBy(period, *keys).agg(geomean("__move").alias("movement"), F.count("*").alias("pairs"))


def impute(prices: DataFrame, levels: Sequence[Sequence[str]], period: str = "month", window: int = 2, low: float = 0.80, high: float = 1.25, carried: str = "price", moved: Sequence[str] = ("price",)) -> DataFrame:
    """Items seen within ``window`` periods before, but not in a period, get their last price (``carried``) moved on by the mean movement of the first level that has one (else unchanged), within bounds. Movements are of the first column of ``moved`` that an item has in both periods.

    Adds ``imputed``; imputed rows count one observation and have no store. Each item is carried over at most ``window`` periods
    after it is seen, so the candidates grow with the rows, not with items times periods. All levels' movements come from one
    grouping. ``prices`` is read several times; give a written table where it is costly.
    """
    steps = written(_numbered(prices, period), "periods")
    numbered = prices.join(F.broadcast(steps), period)
    nexts = numbered.withColumn("__next", F.lead("__no").over(Window.partitionBy("item").orderBy("__no")))
    gaps = nexts.withColumn("__gap", F.explode(F.expr(f"filter(sequence(__no + 1, __no + {window}), n -> n < coalesce(__next, n + 1))")))
    gaps = gaps.drop(period, "__no", "__next").join(F.broadcast(steps.withColumnRenamed("__no", "__gap")), "__gap").drop("__gap")

    def code(keys: Sequence[str]) -> Column:
        return F.concat_ws("\u001f", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys])

    coded = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), code(keys).alias("code")) for i, keys in enumerate(levels)]))
    moves = _moves(prices, steps, period, 0.5, 2.0, moved).select(period, "__move", coded.alias("__k")).groupBy(period, F.col("__k.level").alias("__level"), F.col("__k.code").alias("__code")).agg(geomean("__move").alias("__m"))
    moves = written(moves, "movements")
    for i, keys in enumerate(levels):
        own = moves.where(F.col("__level") == i).select(F.col(period).alias("__p"), F.col("__code").alias("__c"), F.col("__m").alias(f"__m{i}"))
        gaps = gaps.join(own, (F.col(period) == F.col("__p")) & (code(keys) == F.col("__c")), "left").drop("__p", "__c")
    movement = clip(F.coalesce(*[F.col(f"__m{i}") for i in range(len(levels))], F.lit(1.0)), low, high)
    filled = gaps.withColumns({carried: F.col(carried) * movement, "observations": F.lit(1).cast("long"), "store": F.lit(None).cast(prices.schema["store"].dataType), "imputed": F.lit(True)})
    return prices.withColumn("imputed", F.lit(False)).unionByName(filled.select(*prices.columns, "imputed"))


def division_indices(classes: DataFrame, weights: DataFrame, period: str = "month") -> DataFrame:
    """Weighted means of class indices by division; ``weights``: ``class, division, weight``. Classes without an index leave their weight to the others. Classes that say their division only belong to that."""
    joined = classes.join(weights.withColumnRenamed("division", "__division"), "class")
    joined = joined.where("division = __division").drop("division") if "division" in classes.columns else joined
    return joined.groupBy(period, F.col("__division").alias("division")).agg(weighted_mean("index", "weight").alias("index"), F.sum("weight").alias("weight"), F.sum("items").alias("items"))


def headline(divisions: DataFrame, weights: DataFrame, core_without: Sequence[str], period: str = "month", impute_missing: bool = True) -> DataFrame:
    """``headline, core, coverage`` by period. ``weights``: ``division, weight``.

    Core leaves out the divisions ``core_without``. With ``impute_missing`` every division keeps its weight and a missing one
    takes the core index (the mean of all if core is missing too); else present ones share the weight. ``coverage`` is the
    weight present, in per cent.
    """
    every = weights.groupBy().agg(F.sum("weight").alias("__all"))  # one row
    full = divisions.select(period, "division", "index").join(weights.select("division", "weight"), "division", "left").withColumn("weight", F.when(F.col("index").isNotNull(), F.col("weight")))
    is_core = ~F.col("division").isin(*core_without)
    core = weighted_mean(F.when(is_core, F.col("index")), F.when(is_core, F.col("weight")))
    sums = full.groupBy(period).agg(core.alias("core"), weighted_mean("index", "weight").alias("__present"), F.sum(F.col("index") * F.col("weight")).alias("__sum"), F.sum("weight").alias("__has")).crossJoin(every)
    stand_in = F.coalesce("core", "__present")
    missing = F.col("__all") - F.coalesce("__has", F.lit(0.0))
    fixed = (F.coalesce("__sum", F.lit(0.0)) + F.when(missing != 0, missing * stand_in).otherwise(0.0)) / nonzero(F.col("__all"))
    return sums.select(period, (fixed if impute_missing else F.col("__present")).alias("headline"), "core", (100 * F.col("__has") / F.col("__all")).alias("coverage"))


def store_balance(obs: DataFrame, keys: Sequence[str] = ("class",), dominant: float = 60.0) -> DataFrame:
    """By class: observations, stores, the store with most observations (the smallest of several), its share, and whether it dominates."""
    counts = obs.groupBy(*keys, "store").agg(F.count("*").alias("n"))
    top = counts.groupBy(*keys).agg(F.sum("n").alias("observations"), F.count("*").alias("stores"), F.min_by(F.struct("store", "n"), F.struct(-F.col("n"), F.col("store"))).alias("top"))
    share = F.round(100.0 * F.col("top.n") / F.col("observations"), 2)
    return top.select(*keys, "observations", "stores", F.col("top.store").alias("top_store"), share.alias("top_share"), (share > dominant).alias("dominated"))


def with_hedonic(prices: DataFrame, adjusted: DataFrame, keys: Sequence[str] = ("item", "store", "day"), also: str | None = None) -> DataFrame:
    """Prices with the quality-adjusted one in place of the own where there is one (``keys, adjusted``); of several the smallest. It takes the place of ``also``, a unit price, too."""
    one = adjusted.groupBy(*keys).agg(F.min("adjusted").alias("__adjusted"))
    return prices.join(one, list(keys), "left").withColumns({c: F.coalesce("__adjusted", c) for c in ["price", *([also] if also else [])]}).drop("__adjusted")


# -- the whole chain


def compared_prices(obs: DataFrame, period: str = "month") -> DataFrame:
    """``period, item, class, division, shelf, unit, observations, store`` for each item and period from observations with ``price`` and ``unit_price``, ``base_period, base_shelf, base_unit`` of the item's first period, and ``ratio``: of unit prices where they can be compared (``unit_or_shelf``), else of shelf prices; ``base_price`` is the one compared with."""
    prices = _item_means(obs, [period, "item", "class", "division"], {"price": "shelf", "unit_price": "unit"}).where("shelf IS NOT NULL")
    own = Window.partitionBy("item")
    prices = prices.withColumns({"base_period": F.min(period).over(own), "base_shelf": F.min_by("shelf", period).over(own), "base_unit": F.min_by("unit", period).over(own)})
    by_unit = unit_or_shelf("shelf", "base_shelf", "unit", "base_unit")
    return prices.withColumns({"ratio": F.when(by_unit, F.col("unit") / F.col("base_unit")).otherwise(F.col("shelf") / F.col("base_shelf")), "base_price": F.when(by_unit, F.col("base_unit")).otherwise(F.col("base_shelf"))})


def compiled_relatives(obs: DataFrame, levels: Sequence[Sequence[str]], period: str = "month", window: int = 2, shadow: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """The relatives that the index is made of: unit or shelf price, missing items moved on with their class, outliers left out by division, and new items only tracked in their first period. ``imputed`` tells which are not observed. Only ``columns`` are kept, if told."""
    prices = written(compared_prices(obs, period), "compared-prices")
    filled = impute(prices, levels, period, window, carried="ratio", moved=("unit", "shelf")).where("ratio > 0")
    filled = filled.select(*columns) if columns else filled
    kept = drop_outliers(written(filled, "compared-relatives"), [period, "division"])
    return kept.where(F.col("base_period") < F.col(period)) if shadow else kept


def division_grid(classes: DataFrame, relatives: DataFrame, weights: DataFrame, period: str = "month", factors: DataFrame | None = None) -> DataFrame:
    """``period, division, weight, index, items, observations`` for every division of ``weights`` (``class, division, weight``) in every period, with no index and zeros where it has no items. ``factors`` (``period, factor``) chain the index to an earlier base."""
    found = division_indices(classes, weights, period).select(period, "division", "index")
    counts = relatives.groupBy(period, "division").agg(F.count("*").alias("items"), F.sum("observations").alias("observations"))
    grid = counts.select(period).distinct().crossJoin(weights.groupBy("division").agg(F.sum("weight").alias("weight")))  # periods times divisions
    out = grid.join(found, [period, "division"], "left").join(counts, [period, "division"], "left")
    if factors is not None:
        out = out.join(factors.select(period, "factor"), period, "left").withColumn("index", F.col("index") * F.coalesce("factor", F.lit(1.0)))
    return out.select(period, "division", "weight", "index", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("observations", F.lit(0)).alias("observations"))


def compiled(obs: DataFrame, weights: DataFrame, levels: Sequence[Sequence[str]], period: str = "month", window: int = 2, adjusted: DataFrame | None = None, factors: DataFrame | None = None) -> DataFrame:
    """The index of all periods from observations in one chain: ``division_grid`` of store-balanced class indices over ``compiled_relatives``, with quality-adjusted prices (``adjusted``: item, store, day, adjusted) in place of observed ones. ``headline`` adds it up."""
    if adjusted is not None:
        obs = with_hedonic(obs, adjusted, also="unit_price")
    # Read twice: a scan of few columns and a join with few rows, which costs less than to write them.
    relatives = compiled_relatives(obs, levels, period, window, columns=[period, "division", "class", "store", "ratio", "observations", "base_period"])
    classes = store_balanced(relatives, [period, "division", "class"])
    return written(division_grid(classes, relatives, weights, period, factors), "division-grid")


def relative_quality(filled: DataFrame, kept: DataFrame, period: str = "month") -> DataFrame:
    """By period what became of the relatives: ``items`` there were, ``imputed`` ones and their share in per cent, ``outliers`` left out, ``shadowed`` (kept, but new and only tracked), ``active`` ones that the index is made of, and ``stores`` that they come from. ``kept`` is ``drop_outliers`` of ``filled``."""
    before = filled.groupBy(period).agg(F.count("*").alias("items"), F.count_if("imputed").alias("imputed"))
    new = F.col("base_period") == F.col(period)
    after = kept.groupBy(period).agg(F.count("*").alias("__kept"), F.count_if(new).alias("shadowed"), F.countDistinct(F.when(~new, F.col("store"))).alias("stores"))
    joined = before.join(after, period, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("__kept", "shadowed", "stores")})
    return joined.select(period, "items", "imputed", (100.0 * F.col("imputed") / F.col("items")).alias("imputation_rate"), (F.col("items") - F.col("__kept")).alias("outliers"), "shadowed", (F.col("__kept") - F.col("shadowed")).alias("active"), "stores")
