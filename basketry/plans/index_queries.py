"""Queries of the index engine over the sample tables, each with DuckDB SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import geomean, pct_change, weighted_mean
from basketry.operators import hedonic, index, joins, tree, views
from basketry.sources.scratch import written
from basketry.sources.tables import exchange_rates, observations, table

ROUND = 4
CORE_WITHOUT = ["ECONOMY", "LARGE"]

OBS = """obs AS (SELECT CAST(l_shipdate AS DATE) AS day, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_suppkey AS store, l_partkey AS item,
  l_extendedprice / l_quantity AS price, l_discount AS discount, l_discount > 0 AS on_promo, p_brand AS class, p_type AS division, p_name AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 0 AND l_extendedprice > 0)"""
PRICES = """m0 AS (SELECT *, median(price) OVER (PARTITION BY month, item) AS md, count(*) OVER (PARTITION BY month, item) AS n FROM obs),
  stores AS (SELECT month, item, store, row_number() OVER (PARTITION BY month, item ORDER BY count(*) DESC, store) AS no FROM obs GROUP BY month, item, store),
  prices AS (SELECT m.month, m.item, class, division, exp(avg(ln(price)) FILTER (n <= 2 OR price BETWEEN 0.4 * md AND 2.5 * md)) AS price, count(*) AS observations, any_value(s.store) AS store
    FROM m0 m JOIN stores s ON s.month = m.month AND s.item = m.item AND s.no = 1 GROUP BY m.month, m.item, class, division)"""
BASE = """b0 AS (SELECT *, min(month) OVER (PARTITION BY item) AS base_period FROM obs),
  b1 AS (SELECT *, median(price) OVER (PARTITION BY item) AS md, count(*) OVER (PARTITION BY item) AS n FROM b0 WHERE month = base_period),
  base AS (SELECT item, min(base_period) AS base_period, exp(avg(ln(price)) FILTER (n <= 2 OR price BETWEEN 0.4 * md AND 2.5 * md)) AS base_price, count(*) AS base_observations FROM b1 GROUP BY item)"""
RATIOS = "ratios AS (SELECT p.*, base_period, base_price, price / base_price AS ratio FROM prices p JOIN base USING (item) WHERE month >= base_period)"
MAD = """k0 AS (SELECT *, ln(ratio) AS lr FROM ratios WHERE ratio BETWEEN 0.2 AND 4.0),
  k1 AS (SELECT *, median(lr) OVER (PARTITION BY month, division) AS md, count(*) OVER (PARTITION BY month, division) AS gn FROM k0),
  k2 AS (SELECT *, median(abs(lr - md)) OVER (PARTITION BY month, division) AS mad FROM k1),
  kept AS (SELECT * FROM k2 WHERE CASE WHEN gn >= 5 AND mad > 1e-6 THEN abs(lr - md) <= 3.5 * 1.4826 * mad ELSE ratio BETWEEN 0.33 AND 3.0 END)"""
BALANCED = """s0 AS (SELECT month, division, class, store, exp(avg(ln(ratio))) AS g, count(*) AS n, sum(ln(ratio)) AS s FROM kept GROUP BY ALL),
  classes AS (SELECT month, division, class, 100 * CASE WHEN count(store) >= 2 THEN exp(avg(ln(g)) FILTER (store IS NOT NULL)) ELSE exp(sum(s) / sum(n)) END AS index,
    count(store) AS stores, CAST(sum(n) AS BIGINT) AS items FROM s0 GROUP BY month, division, class)"""
WEIGHTS = "weights AS (SELECT p_type AS division, p_brand AS class, sum(l_extendedprice) / 1e6 AS weight FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"
DIVISIONS = """dw AS (SELECT division, sum(weight) AS weight FROM weights GROUP BY division),
  divisions AS (SELECT c.month, c.division, sum(c.index * w.weight) / sum(w.weight) AS index, CAST(sum(items) AS BIGINT) AS items FROM classes c JOIN weights w USING (division, class) GROUP BY ALL)"""
HEADLINE = """grid AS (SELECT month, dw.division, weight, index FROM (SELECT DISTINCT month FROM divisions) CROSS JOIN dw LEFT JOIN divisions USING (month, division)),
  core AS (SELECT month, sum(index * weight) FILTER (division NOT IN ('ECONOMY', 'LARGE')) / sum(weight) FILTER (division NOT IN ('ECONOMY', 'LARGE') AND index IS NOT NULL) AS core,
    sum(index * weight) / sum(weight) FILTER (index IS NOT NULL) AS present FROM grid GROUP BY month),
  headline AS (SELECT month, sum(coalesce(index, core, present) * weight) / sum(weight) AS headline, any_value(core) AS core,
    100 * sum(weight) FILTER (index IS NOT NULL) / sum(weight) AS coverage FROM grid JOIN core USING (month) GROUP BY month)"""
ROLLING = """h0 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS DOUBLE) AS x1, CAST(l_discount AS DOUBLE) AS x2, ln(l_extendedprice) AS y FROM lineitem WHERE l_extendedprice > 0),
        h1 AS (SELECT day, count(*) AS n, sum(x1) AS x1, sum(x2) AS x2, sum(y) AS y, sum(x1 * x1) AS x11, sum(x1 * x2) AS x12, sum(x2 * x2) AS x22, sum(x1 * y) AS x1y, sum(x2 * y) AS x2y, sum(y * y) AS yy FROM h0 GROUP BY day),
        h2 AS (SELECT day, sum(n) OVER w AS n, sum(x1) OVER w AS x1, sum(x2) OVER w AS x2, sum(y) OVER w AS y, sum(x11) OVER w AS x11, sum(x12) OVER w AS x12, sum(x22) OVER w AS x22, sum(x1y) OVER w AS x1y, sum(x2y) OVER w AS x2y, sum(yy) OVER w AS yy
               FROM h1 WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW)),
        h3 AS (SELECT day, n, x1 / n AS x1, x2 / n AS x2, y / n AS y, x11 / n - (x1 / n) ** 2 AS s11, x12 / n - x1 / n * x2 / n AS s12, x22 / n - (x2 / n) ** 2 AS s22, x1y / n - x1 / n * y / n AS s1y, x2y / n - x2 / n * y / n AS s2y, yy / n - (y / n) ** 2 AS syy FROM h2 WHERE n >= 20),
        beta AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM h3)"""
FACTORS = """o AS (SELECT DISTINCT day, date_trunc('month', day) AS month FROM h0),
        early AS (SELECT o.day, avg(x1) AS e1, avg(x2) AS e2 FROM o JOIN h0 ON h0.day >= o.day - 90 AND h0.day < o.month GROUP BY o.day),
        own AS (SELECT o.day, median(x1) AS m1, median(x2) AS m2 FROM o JOIN h0 ON h0.day >= o.month AND h0.day <= o.day GROUP BY o.day),
        bases AS (SELECT own.day, coalesce(e1, m1) AS b1, coalesce(e2, m2) AS b2 FROM own LEFT JOIN early USING (day)),
        hf AS (SELECT h0.*, coalesce(exp(least(greatest(beta.b1 * (bases.b1 - h0.x1) + beta.b2 * (bases.b2 - h0.x2), -3), 3)), 1.0) AS factor FROM h0 JOIN bases USING (day) LEFT JOIN beta USING (day))"""
CHAIN = ",\n".join([OBS, PRICES, BASE, RATIOS, MAD, BALANCED, WEIGHTS, DIVISIONS, HEADLINE])


def _r(c: str, digits: int = ROUND):
    return F.round(c, digits).alias(c)


def elementary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.first_relatives(index.item_prices(observations(spark, sf_dir)))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.drop_outliers(written(elementary(spark, sf_dir), "relatives"), ["month", "division"])


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.store_balanced(cleaned(spark, sf_dir), ["month", "division", "class"])


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    return joined.groupBy(F.col("p_type").alias("division"), F.col("p_brand").alias("class")).agg((F.sum("l_extendedprice") / 1e6).alias("weight"))


def divisions(spark: SparkSession, sf_dir: str, weights: DataFrame | None = None) -> DataFrame:
    weights = class_weights(spark, sf_dir) if weights is None else weights
    joined = classes(spark, sf_dir).join(weights, ["division", "class"])
    return joined.groupBy("month", "division").agg(weighted_mean("index", "weight").alias("index"), F.sum("items").alias("items"))


def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divisions_and_headline(spark, sf_dir)[1]


def divisions_and_headline(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both from one chain: weights and divisions are written, a row a class or period and division."""
    weights = written(class_weights(spark, sf_dir), "class-weights")
    found = written(divisions(spark, sf_dir, weights), "divisions")
    return found, index.headline(found, weights.groupBy("division").agg(F.sum("weight").alias("weight")), CORE_WITHOUT)


def rounded_headline(found: DataFrame) -> DataFrame:
    return found.select("month", _r("headline"), _r("core"), _r("coverage"))


def q_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_headline(headline(spark, sf_dir))


LEVELS = [["class", "division"], ["class"], ["division"]]


def _chain_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Observations and hedonic prices of the whole chain: a third of the items have unit prices, some of them from a misread pack; a tenth of the items have hedonic prices."""
    obs = observations(spark, sf_dir)
    misread = F.when(F.col("store") % 17 == 0, 24.0).otherwise(1.0)
    obs = obs.withColumn("unit_price", F.when(F.col("item") % 3 == 0, F.col("price") / 2 * misread))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("store"), F.col("l_shipdate").cast("date").alias("day"), "l_quantity", "l_discount", F.col("l_extendedprice").alias("price"))
    adjusted = hedonic.rolling_adjusted(rows, ["l_quantity", "l_discount"]).where("item % 10 = 0").select("item", "store", "day", (F.col("price") * F.col("factor") / F.col("l_quantity")).alias("adjusted"))
    return obs, adjusted


def _compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, adjusted = _chain_inputs(spark, sf_dir)
    daily = obs.groupBy("day").agg(F.avg("price").alias("headline"), F.count("*").alias("observations"))
    factors = tree.splice(tree.december_factors(daily).select("effective_from", "factor"), obs.select("month").distinct())
    return index.compiled(obs, written(class_weights(spark, sf_dir), "class-weights"), LEVELS, adjusted=adjusted, factors=factors)


def q_index_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the whole chain imputes, leaves out and only tracks, by month."""
    obs, adjusted = _chain_inputs(spark, sf_dir)
    prices = written(index.compared_prices(index.with_hedonic(obs, adjusted, also="unit_price")), "compared-prices")
    filled = index.impute(prices, LEVELS, carried="ratio", moved=("unit", "shelf")).where("ratio > 0")
    filled = written(filled.select("month", "division", "store", "ratio", "base_period", "imputed"), "compared-relatives")
    found = index.relative_quality(filled, index.drop_outliers(filled, ["month", "division"]))
    return found.withColumn("imputation_rate", F.round("imputation_rate", 4))


def _relatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, adjusted = _chain_inputs(spark, sf_dir)
    return index.compiled_relatives(index.with_hedonic(obs, adjusted, also="unit_price"), LEVELS)


def q_class_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.class_mart(_relatives(spark, sf_dir)).withColumn("class_index", F.round("class_index", 4))


# Names of the sample's first classes.
CLASS_NAMES = {"Brand#1": "Rice", "Brand#2": "Bread", "Brand#3": "Pasta & Noodles"}


def q_subclass_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.subclass_view(_relatives(spark, sf_dir), CLASS_NAMES)
    return found.select("month", "division", "class", "name", "relatives", "items", _r("jevons", 3), _r("carli", 3), "imputed")


def q_product_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.product_view(_relatives(spark, sf_dir), "Brand#1")
    return found.select("month", "products", _r("jevons", 3), _r("carli", 3), _r("base_price", 2), _r("price", 2), _r("change", 3))


def q_headline_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last month's headline, core, change and active items in one row."""
    along = Window.orderBy("month")  # a row a month
    rows = q_compiled(spark, sf_dir).withColumn("before", F.lag("headline").over(along))
    change = F.round((F.col("headline") / F.col("before") - 1) * 100, 3) + 0.0
    return rows.orderBy(F.desc("month")).limit(1).select("month", "headline", "core", change.alias("change"), F.col("items").alias("active_items"))


def q_compiled_divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir).select("month", "division", F.round("weight", 3).alias("weight"), _r("index", 3), "items", "observations")


def q_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = _compiled(spark, sf_dir)
    weights = grid.groupBy("division").agg(F.max("weight").alias("weight"))
    items = grid.groupBy("month").agg(F.sum("items").alias("items"))
    return index.headline(grid.where("index IS NOT NULL"), weights, CORE_WITHOUT).join(items, "month").select("month", _r("headline", 3), _r("core", 3), _r("coverage"), "items")


def q_item_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.item_prices(observations(spark, sf_dir)).select("month", "item", _r("price", 7), "observations", "store")


def q_base_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.base_prices(observations(spark, sf_dir)).select("item", "base_period", _r("base_price", 7), "base_observations")


def q_jevons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.jevons(elementary(spark, sf_dir), ["month", "class"]).select("month", "class", _r("index"), "items")


def q_carli_dutot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.carli_dutot(elementary(spark, sf_dir), ["month", "division"]).select("month", "division", _r("jevons"), _r("carli"), _r("dutot"), "items")


def q_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("month", "item", "division", _r("ratio"))


def q_store_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark, sf_dir).select("month", "division", "class", _r("index"), "stores", "items")


def q_divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divisions(spark, sf_dir).select("month", "division", _r("index"), "items")


def q_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.movements(index.item_prices(observations(spark, sf_dir)), ["class"]).select("month", "class", _r("movement"), "pairs")


def q_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = index.impute(written(index.item_prices(observations(spark, sf_dir)), "item-prices"), [["class"], ["division"]], window=2)
    return filled.select("month", "item", F.round(F.ln("price"), 8).alias("log_price"), "observations", "store", "imputed")


def q_shadow(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracked = index.first_relatives(index.item_prices(observations(spark, sf_dir)), shadow=True)
    return index.jevons(tracked, ["month", "division"]).select("month", "division", _r("index"), "items")


def q_promo_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = index.base_prices(observations(spark, sf_dir), base_from="1995-01-01", deep_promo=0.07)
    return base.select("item", "base_period", _r("base_price", 7), "base_observations", "first_seen")


def q_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    early = index.base_prices(obs.where("month < DATE '1993-01-01'"))
    return index.register_base(early, index.base_prices(obs, base_from="1993-01-01")).select("item", "base_period", _r("base_price", 7))


def q_balance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.store_balance(observations(spark, sf_dir), ["class"], dominant=1.5)


def q_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat against store-balanced means by class and month, and their difference."""
    rows = written(cleaned(spark, sf_dir), "kept-relatives")
    flat = index.jevons(rows, ["month", "class"]).select("month", "class", F.col("index").alias("flat"))
    balanced = index.store_balanced(rows, ["month", "class"]).select("month", "class", F.col("index").alias("balanced"))
    return flat.join(balanced, ["month", "class"]).select("month", "class", _r("flat"), _r("balanced"), F.round(F.col("flat") - F.col("balanced"), ROUND).alias("difference"))


def q_monthly_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joins.calendar_changes(written(q_headline(spark, sf_dir), "headline"), [], ["headline", "core"])
    return out.select("month", "headline", "core", "headline_mom", "headline_yoy", "core_mom", "core_yoy")


def q_division_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joins.calendar_changes(written(q_divisions(spark, sf_dir), "divisions"), ["division"], ["index"])
    return out.select("month", "division", "index", "index_mom", "index_yoy")


def q_class_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    along = Window.partitionBy("division", "class").orderBy("month")
    out = q_store_balanced(spark, sf_dir).withColumn("before", F.lag("index").over(along))
    return out.select("month", "division", "class", "index", pct_change("index", "before", 3).alias("change"))


def q_windowed_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline and core as sums over divisions in a window, so each division's row carries them."""
    weights = class_weights(spark, sf_dir).groupBy("division").agg(F.sum("weight").alias("weight"))
    rows = divisions(spark, sf_dir).join(F.broadcast(weights), "division")
    by = Window.partitionBy("month")
    core = ~F.col("division").isin(*CORE_WITHOUT)
    over = lambda c: F.sum(c).over(by)
    return rows.select("month", "division", _r("index"), F.round(over(F.col("index") * F.col("weight")) / over(F.col("weight")), ROUND).alias("headline"),
                       F.round(over(F.when(core, F.col("index") * F.col("weight"))) / over(F.when(core, F.col("weight"))), ROUND).alias("core"))


def q_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' order values by month as leaves; nations, regions and the world above them."""
    orders, customer, nation = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    leaves = rows.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "year").alias("year"), F.col("c_custkey").alias("customer"), F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    leaves = leaves.agg(geomean(F.col("o_totalprice") / 1000).alias("index"), F.first(F.abs("c_acctbal") + 1).alias("weight")).withColumn("world", F.lit(0))
    return tree.roll_up(leaves, ["nation", "region", "world"], "year").select("year", "level", "code", _r("index"), F.round("weight", 2).alias("weight"))


def q_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = observations(spark, sf_dir).groupBy("day").agg(F.avg("price").alias("headline"), F.count("*").alias("observations"))
    annual = tree.december_factors(daily)
    months = observations(spark, sf_dir).select("month").distinct()
    return tree.splice(annual.select("effective_from", "factor"), months).select("month", _r("factor"))


def q_december(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = observations(spark, sf_dir).groupBy("day").agg(F.avg("price").alias("headline"), F.count("*").alias("observations"))
    return tree.december_factors(daily).select("effective_from", _r("factor"), "base_day")


def q_fx_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "event_id")
    return joins.as_of(days, exchange_rates(spark, sf_dir), "day", "rate").select("event_id", "day", "rate")


def q_fx_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "event_id")
    return joins.exact_or(days, exchange_rates(spark, sf_dir), "day", "rate", 4044.0).select("event_id", "day", "rate")


FX = "fx AS (SELECT CAST(ts AS DATE) AS day, round(4000 + avg(value), 2) AS rate FROM events WHERE day(CAST(ts AS DATE)) % 3 <> 0 GROUP BY 1)"
STEP = "steps AS (SELECT month, lag(month) OVER (ORDER BY month) AS before, row_number() OVER (ORDER BY month) AS no FROM (SELECT DISTINCT month FROM prices))"
MOVE = """mv AS (SELECT p.month, p.class, p.division, p.price / q.price AS move FROM prices p JOIN steps s ON s.month = p.month JOIN prices q ON q.item = p.item AND q.month = s.before
  WHERE p.price / q.price BETWEEN 0.5 AND 2.0)"""
DAILY = "daily AS (SELECT day, avg(price) AS headline, count(*) AS observations FROM obs GROUP BY day)"
DECEMBER = """annual AS (SELECT make_date(year(day) + 1, 1, 1) AS effective_from, avg(headline) / 100 AS factor, arg_min(day, (-observations, day)) AS base_day
  FROM daily WHERE month(day) = 12 GROUP BY year(day))"""


def _change(value: str, now: str = "c", before: str = "p", digits: int = 4) -> str:
    return f"round(({now}.{value} - {before}.{value}) / nullif({before}.{value}, 0) * 100.0, {digits}) + 0.0"

COMPILED = f"""WITH {OBS}, {ROLLING}, {FACTORS}, {DAILY}, {DECEMBER}, {WEIGHTS}, dw AS (SELECT division, sum(weight) AS weight FROM weights GROUP BY division),
  splice AS (SELECT month, coalesce(arg_max(factor, effective_from), 1.0) AS factor FROM (SELECT DISTINCT month FROM obs) LEFT JOIN annual ON effective_from <= month GROUP BY month),
  adj AS (SELECT l_partkey AS item, l_suppkey AS store, day, min(l_extendedprice * factor / l_quantity) AS adjusted FROM hf WHERE l_partkey % 10 = 0 GROUP BY ALL),
  o3 AS (SELECT month, store, item, class, division, coalesce(adjusted, price) AS price, coalesce(adjusted, CASE WHEN item % 3 = 0 THEN price / 2 * CASE WHEN store % 17 = 0 THEN 24.0 ELSE 1.0 END END) AS unit FROM obs LEFT JOIN adj USING (item, store, day)),
  m0 AS (SELECT *, median(price) OVER w AS md, count(price) OVER w AS n, median(unit) OVER w AS um, count(unit) OVER w AS un FROM o3 WINDOW w AS (PARTITION BY month, item)),
  stores AS (SELECT month, item, store, row_number() OVER (PARTITION BY month, item ORDER BY count(*) DESC, store) AS no FROM o3 GROUP BY month, item, store),
  p0 AS (SELECT m.month, m.item, class, division, exp(avg(ln(price)) FILTER (n <= 2 OR price BETWEEN 0.4 * md AND 2.5 * md)) AS shelf, exp(avg(ln(unit)) FILTER (un <= 2 OR unit BETWEEN 0.4 * um AND 2.5 * um)) AS unit,
    count(*) AS observations, any_value(s.store) AS store FROM m0 m JOIN stores s ON s.month = m.month AND s.item = m.item AND s.no = 1 GROUP BY m.month, m.item, class, division),
  p1 AS (SELECT *, min(month) OVER f AS base_period, first_value(shelf) OVER f AS bs, first_value(unit) OVER f AS bu FROM p0 WINDOW f AS (PARTITION BY item ORDER BY month)),
  prices AS (SELECT *, CASE WHEN unit IS NOT NULL AND bu IS NOT NULL AND NOT ((unit / bu >= 3 OR unit / bu <= 0.33) AND shelf / bs BETWEEN 0.7 AND 1.4) THEN unit / bu ELSE shelf / bs END AS ratio,
    CASE WHEN unit IS NOT NULL AND bu IS NOT NULL AND NOT ((unit / bu >= 3 OR unit / bu <= 0.33) AND shelf / bs BETWEEN 0.7 AND 1.4) THEN bu ELSE bs END AS base FROM p1),
  {STEP}, mv AS (SELECT p.month, p.class, p.division, CASE WHEN p.unit IS NOT NULL AND q.unit IS NOT NULL THEN p.unit / q.unit ELSE p.shelf / q.shelf END AS move FROM prices p JOIN steps s ON s.month = p.month JOIN prices q ON q.item = p.item AND q.month = s.before),
  mw AS (SELECT * FROM mv WHERE move BETWEEN 0.5 AND 2.0), mcd AS (SELECT month, class, division, exp(avg(ln(move))) AS m FROM mw GROUP BY ALL), mc AS (SELECT month, class, exp(avg(ln(move))) AS m FROM mw GROUP BY ALL), mdv AS (SELECT month, division, exp(avg(ln(move))) AS m FROM mw GROUP BY ALL),
  np AS (SELECT p.*, s.no, lead(s.no) OVER (PARTITION BY item ORDER BY s.no) AS nx FROM prices p JOIN steps s USING (month)),
  gaps AS (SELECT s.month, np.item, np.class, np.division, np.ratio, np.base_period, np.base FROM np JOIN steps s ON s.no > np.no AND s.no <= np.no + 2 AND (np.nx IS NULL OR s.no < np.nx)),
  filled AS (SELECT month, item, class, division, ratio, base_period, store, observations, base FROM prices UNION ALL
    SELECT g.month, g.item, g.class, g.division, g.ratio * least(greatest(coalesce(mcd.m, mc.m, mdv.m, 1.0), 0.8), 1.25), g.base_period, NULL, 1, g.base FROM gaps g
    LEFT JOIN mcd ON mcd.month = g.month AND mcd.class = g.class AND mcd.division = g.division LEFT JOIN mc ON mc.month = g.month AND mc.class = g.class LEFT JOIN mdv ON mdv.month = g.month AND mdv.division = g.division),
  k0 AS (SELECT *, ln(ratio) AS lr FROM filled WHERE ratio BETWEEN 0.2 AND 4.0), k1 AS (SELECT *, median(lr) OVER (PARTITION BY month, division) AS md, count(*) OVER (PARTITION BY month, division) AS gn FROM k0),
  k2 AS (SELECT *, median(abs(lr - md)) OVER (PARTITION BY month, division) AS mad FROM k1),
  kept AS (SELECT * FROM k2 WHERE base_period < month AND CASE WHEN gn >= 5 AND mad > 1e-6 THEN abs(lr - md) <= 3.5 * 1.4826 * mad ELSE ratio BETWEEN 0.33 AND 3.0 END),
  {BALANCED}, di AS (SELECT c.month, c.division, sum(c.index * w.weight) / sum(w.weight) AS index FROM classes c JOIN weights w USING (division, class) GROUP BY ALL),
  cn AS (SELECT month, division, count(*) AS items, CAST(sum(observations) AS BIGINT) AS observations FROM kept GROUP BY ALL),
  divs AS (SELECT g.month, g.division, g.weight, di.index * splice.factor AS index, coalesce(items, 0) AS items, coalesce(observations, 0) AS observations
    FROM (SELECT month, division, weight FROM (SELECT DISTINCT month FROM cn) CROSS JOIN dw) g LEFT JOIN di USING (month, division) LEFT JOIN cn USING (month, division) LEFT JOIN splice USING (month))"""

COMPILED_INDEX = f"""{COMPILED}, core AS (SELECT month, sum(index * weight) FILTER (division NOT IN ('ECONOMY', 'LARGE')) / sum(weight) FILTER (division NOT IN ('ECONOMY', 'LARGE') AND index IS NOT NULL) AS core,
        sum(index * weight) / sum(weight) FILTER (index IS NOT NULL) AS present, CAST(sum(items) AS BIGINT) AS items FROM divs GROUP BY month)
        SELECT month, round(sum(coalesce(index, core, present) * weight) / sum(weight), 3) AS headline, round(any_value(core), 3) AS core, round(100 * sum(weight) FILTER (index IS NOT NULL) / sum(weight), 4) AS coverage, any_value(core.items) AS items FROM divs JOIN core USING (month) GROUP BY month"""


QUERIES = {
    "headline_index": (q_headline, f"WITH {CHAIN} SELECT month, round(headline, 4) AS headline, round(core, 4) AS core, round(coverage, 4) AS coverage FROM headline"),
    "compiled_divisions": (q_compiled_divisions, f"{COMPILED} SELECT month, division, round(weight, 3) AS weight, round(index, 3) AS index, items, observations FROM divs"),
    "compiled_index": (q_compiled, COMPILED_INDEX),
    "headline_scalars": (q_headline_scalars, f"""SELECT month, headline, core, round((headline / before - 1) * 100, 3) + 0.0 AS change, items AS active_items
        FROM (SELECT *, lag(headline) OVER (ORDER BY month) AS before FROM ({COMPILED_INDEX})) ORDER BY month DESC LIMIT 1"""),
    "index_quality": (q_index_quality, f"""{COMPILED}, all_k AS (SELECT *, CASE WHEN gn >= 5 AND mad > 1e-6 THEN abs(lr - md) <= 3.5 * 1.4826 * mad ELSE ratio BETWEEN 0.33 AND 3.0 END AS stays FROM k2),
        q1 AS (SELECT month, count(*) AS items, count(*) FILTER (store IS NULL) AS imputed FROM filled GROUP BY month),
        q2 AS (SELECT month, count(*) FILTER (stays) AS kept, count(*) FILTER (stays AND base_period = month) AS shadowed, count(DISTINCT store) FILTER (stays AND base_period < month) AS stores FROM all_k GROUP BY month)
        SELECT month, items, imputed, round(100.0 * imputed / items, 4) AS imputation_rate, items - kept AS outliers, shadowed, kept - shadowed AS active, stores FROM q1 JOIN q2 USING (month)"""),
    "class_mart": (q_class_mart, f"""{COMPILED} SELECT month, division, class, round(100 * exp(avg(ln(ratio))), 4) AS class_index, count(*) AS items, CAST(sum(observations) AS BIGINT) AS observations, count(*) FILTER (store IS NULL) AS imputed FROM kept GROUP BY ALL"""),
    "subclass_view": (q_subclass_view, f"""{COMPILED} SELECT month, division, class, CASE class WHEN 'Brand#1' THEN 'Rice' WHEN 'Brand#2' THEN 'Bread' WHEN 'Brand#3' THEN 'Pasta & Noodles' ELSE class END AS name, count(*) AS relatives,
        count(DISTINCT item) AS items, round(100 * exp(avg(ln(ratio))), 3) AS jevons, round(100 * avg(ratio), 3) AS carli, count(*) FILTER (store IS NULL) AS imputed FROM kept GROUP BY month, division, class"""),
    "product_view": (q_product_view, f"""{COMPILED} SELECT month, count(DISTINCT item) AS products, round(100 * exp(avg(ln(ratio))), 3) AS jevons, round(100 * avg(ratio), 3) AS carli, round(avg(base), 2) AS base_price, round(avg(base * ratio), 2) AS price,
        round((exp(avg(ln(ratio))) - 1) * 100, 3) AS change FROM kept WHERE class = 'Brand#1' GROUP BY month"""),
    "item_prices": (q_item_prices, f"WITH {OBS}, {PRICES} SELECT month, item, round(price, 7) AS price, observations, store FROM prices"),
    "base_prices": (q_base_prices, f"WITH {OBS}, {BASE} SELECT item, base_period, round(base_price, 7) AS base_price, base_observations FROM base"),
    "jevons_by_class": (q_jevons, f"WITH {OBS}, {PRICES}, {BASE}, {RATIOS} SELECT month, class, round(100 * exp(avg(ln(ratio))), 4) AS index, count(*) AS items FROM ratios GROUP BY month, class"),
    "jevons_carli_dutot": (q_carli_dutot, f"""WITH {OBS}, {PRICES}, {BASE}, {RATIOS} SELECT month, division, round(100 * exp(avg(ln(price / base_price))), 4) AS jevons,
        round(100 * avg(price / base_price), 4) AS carli, round(100 * avg(price) / avg(base_price), 4) AS dutot, count(*) AS items FROM ratios GROUP BY month, division"""),
    "mad_outliers": (q_outliers, f"WITH {OBS}, {PRICES}, {BASE}, {RATIOS}, {MAD} SELECT month, item, division, round(ratio, 4) AS ratio FROM kept"),
    "store_balanced_classes": (q_store_balanced, f"WITH {OBS}, {PRICES}, {BASE}, {RATIOS}, {MAD}, {BALANCED} SELECT month, division, class, round(index, 4) AS index, stores, items FROM classes"),
    "division_indices": (q_divisions, f"WITH {CHAIN} SELECT month, division, round(index, 4) AS index, items FROM divisions"),
    "class_movements": (q_movements, f"WITH {OBS}, {PRICES}, {STEP}, {MOVE} SELECT month, class, round(exp(avg(ln(move))), 4) AS movement, count(*) AS pairs FROM mv GROUP BY month, class"),
    "imputed_prices": (q_imputed, f"""WITH {OBS}, {PRICES}, {STEP}, {MOVE},
        mc AS (SELECT month, class, exp(avg(ln(move))) AS m FROM mv GROUP BY ALL), md AS (SELECT month, division, exp(avg(ln(move))) AS m FROM mv GROUP BY ALL),
        np AS (SELECT p.*, s.no, lead(s.no) OVER (PARTITION BY item ORDER BY s.no) AS nx FROM prices p JOIN steps s USING (month)),
        gaps AS (SELECT s.month, np.item, np.class, np.division, np.price FROM np JOIN steps s ON s.no > np.no AND s.no <= np.no + 2 AND (np.nx IS NULL OR s.no < np.nx))
        SELECT month, item, round(ln(price), 8) AS log_price, observations, store, false AS imputed FROM prices UNION ALL
        SELECT g.month, g.item, round(ln(g.price * least(greatest(coalesce(mc.m, md.m, 1.0), 0.8), 1.25)), 8), 1, NULL, true FROM gaps g
        LEFT JOIN mc ON mc.month = g.month AND mc.class = g.class LEFT JOIN md ON md.month = g.month AND md.division = g.division"""),
    "shadow_tracking": (q_shadow, f"""WITH {OBS}, {PRICES}, {BASE}, {RATIOS} SELECT month, division, round(100 * exp(avg(ln(ratio))), 4) AS index, count(*) AS items
        FROM ratios WHERE base_period < month GROUP BY month, division"""),
    "promo_free_base": (q_promo_base, f"""WITH {OBS}, s AS (SELECT *, min(month) OVER (PARTITION BY item) AS first_seen FROM obs),
        f AS (SELECT *, min(month) OVER (PARTITION BY item) AS base_period FROM s WHERE month >= DATE '1995-01-01'),
        g AS (SELECT *, bool_and(discount >= 0.07) OVER (PARTITION BY item) AS all_deep FROM f WHERE month = base_period),
        h AS (SELECT *, median(price) OVER (PARTITION BY item) AS md, count(*) OVER (PARTITION BY item) AS n FROM g WHERE discount < 0.07 OR all_deep)
        SELECT item, min(base_period) AS base_period, round(exp(avg(ln(price)) FILTER (n <= 2 OR price BETWEEN 0.4 * md AND 2.5 * md)), 7) AS base_price, count(*) AS base_observations,
        min(first_seen) AS first_seen FROM h GROUP BY item"""),
    "base_registry": (q_registry, f"""WITH {OBS}, t AS (SELECT *, month < DATE '1993-01-01' AS early FROM obs),
        b0 AS (SELECT *, min(month) OVER (PARTITION BY item, early) AS base_period FROM t),
        b1 AS (SELECT *, median(price) OVER (PARTITION BY item, early) AS md, count(*) OVER (PARTITION BY item, early) AS n FROM b0 WHERE month = base_period),
        b2 AS (SELECT item, early, min(base_period) AS base_period, exp(avg(ln(price)) FILTER (n <= 2 OR price BETWEEN 0.4 * md AND 2.5 * md)) AS base_price FROM b1 GROUP BY ALL)
        SELECT item, base_period, round(base_price, 7) AS base_price FROM b2 b WHERE early OR NOT EXISTS (SELECT 1 FROM b2 e WHERE e.early AND e.item = b.item)"""),
    "store_balance_report": (q_balance_report, f"""WITH {OBS}, c AS (SELECT class, store, count(*) AS n FROM obs GROUP BY ALL),
        t AS (SELECT class, CAST(sum(n) AS BIGINT) AS observations, count(*) AS stores, arg_min(store, (-n, store)) AS top_store, max(n) AS top FROM c GROUP BY class)
        SELECT class, observations, stores, top_store, round(100.0 * top / observations, 2) AS top_share, round(100.0 * top / observations, 2) > 1.5 AS dominated FROM t"""),
    "formula_sensitivity": (q_sensitivity, f"""WITH {OBS}, {PRICES}, {BASE}, {RATIOS}, {MAD}, s AS (SELECT month, class, store, exp(avg(ln(ratio))) AS g, count(*) AS n, sum(ln(ratio)) AS s FROM kept GROUP BY ALL),
        b AS (SELECT month, class, 100 * exp(sum(s) / sum(n)) AS flat, 100 * CASE WHEN count(store) >= 2 THEN exp(avg(ln(g))) ELSE exp(sum(s) / sum(n)) END AS balanced FROM s GROUP BY ALL)
        SELECT month, class, round(flat, 4) AS flat, round(balanced, 4) AS balanced, round(flat - balanced, 4) AS difference FROM b"""),
    "monthly_changes": (q_monthly_changes, f"""WITH {CHAIN}, r AS (SELECT month, round(headline, 4) AS headline, round(core, 4) AS core FROM headline)
        SELECT c.month, c.headline, c.core, {_change('headline')} AS headline_mom, {_change('headline', before='y')} AS headline_yoy, {_change('core')} AS core_mom, {_change('core', before='y')} AS core_yoy
        FROM r c LEFT JOIN r p ON p.month = c.month - INTERVAL 1 MONTH LEFT JOIN r y ON y.month = c.month - INTERVAL 1 YEAR"""),
    "division_changes": (q_division_changes, f"""WITH {CHAIN}, r AS (SELECT month, division, round(index, 4) AS index FROM divisions)
        SELECT c.month, c.division, c.index, {_change('index')} AS index_mom, {_change('index', before='y')} AS index_yoy
        FROM r c LEFT JOIN r p ON p.division = c.division AND p.month = c.month - INTERVAL 1 MONTH LEFT JOIN r y ON y.division = c.division AND y.month = c.month - INTERVAL 1 YEAR"""),
    "class_changes": (q_class_changes, f"""WITH {OBS}, {PRICES}, {BASE}, {RATIOS}, {MAD}, {BALANCED}, r AS (SELECT month, division, class, round(index, 4) AS index FROM classes),
        l AS (SELECT *, lag(index) OVER (PARTITION BY division, class ORDER BY month) AS before FROM r)
        SELECT month, division, class, index, round((index - before) / nullif(before, 0) * 100.0, 3) + 0.0 AS change FROM l"""),
    "windowed_headline": (q_windowed_headline, f"""WITH {CHAIN} SELECT month, division, round(index, 4) AS index,
        round(sum(index * weight) OVER m / sum(weight) OVER m, 4) AS headline,
        round(sum(CASE WHEN division NOT IN ('ECONOMY', 'LARGE') THEN index * weight END) OVER m / sum(CASE WHEN division NOT IN ('ECONOMY', 'LARGE') THEN weight END) OVER m, 4) AS core
        FROM divisions JOIN dw USING (division) WINDOW m AS (PARTITION BY month)"""),
    "tree_roll_up": (q_tree, """WITH leaves AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS year, c_custkey, n_nationkey AS nation, n_regionkey AS region, exp(avg(ln(o_totalprice / 1000))) AS index,
        any_value(abs(c_acctbal) + 1) AS weight FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
        n AS (SELECT year, nation, region, sum(index * weight) / sum(weight) AS index, sum(weight) AS weight FROM leaves GROUP BY ALL),
        r AS (SELECT year, region, sum(index * weight) / sum(weight) AS index, sum(weight) AS weight FROM n GROUP BY ALL),
        w AS (SELECT year, sum(index * weight) / sum(weight) AS index, sum(weight) AS weight FROM r GROUP BY ALL)
        SELECT year, 'nation' AS level, CAST(nation AS VARCHAR) AS code, round(index, 4) AS index, round(weight, 2) AS weight FROM n
        UNION ALL SELECT year, 'region', CAST(region AS VARCHAR), round(index, 4), round(weight, 2) FROM r UNION ALL SELECT year, 'world', '0', round(index, 4), round(weight, 2) FROM w"""),
    "splice_factors": (q_splice, f"""WITH {OBS}, {DAILY}, {DECEMBER}, m AS (SELECT DISTINCT month FROM obs)
        SELECT month, round(coalesce(arg_max(factor, effective_from), 1.0), 4) AS factor FROM m LEFT JOIN annual ON effective_from <= month GROUP BY month"""),
    "december_rebase": (q_december, f"WITH {OBS}, {DAILY}, {DECEMBER} SELECT effective_from, round(factor, 4) AS factor, base_day FROM annual"),
    "fx_as_of": (q_fx_as_of, f"""WITH {FX}, e AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events)
        SELECT event_id, e.day, fx.rate FROM e ASOF LEFT JOIN fx ON e.day >= fx.day"""),
    "fx_exact": (q_fx_exact, f"""WITH {FX} SELECT event_id, CAST(ts AS DATE) AS day, coalesce(rate, 4044.0) AS rate FROM events LEFT JOIN fx ON fx.day = CAST(ts AS DATE)"""),
}
