"""Queries of the star schema and the serving views, each with DuckDB SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import index, views
from basketry.plans.index_queries import CHAIN, OBS, BASE, PRICES, RATIOS, cleaned, class_weights, divisions_and_headline, q_headline, rounded_headline
from basketry.sources.scratch import written
from basketry.sources.tables import exchange_rates, observations, scrapes, table


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily_prices(observations(spark, sf_dir))


def q_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).select("day", "store", "item", F.round("price", 7).alias("price"), "observations", "any_promo", "all_promo", "discount", "class")


def q_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dim_items(observations(spark, sf_dir), "2001-06-01")


def q_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("store"), F.col("s_name").alias("store_name"), F.col("s_nationkey").alias("channel"))
    return views.dim_stores(stores, observations(spark, sf_dir).select("store", "item", "day"))


def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.when(F.col("p_size") % 5 == 0, "99").when(F.col("p_size") % 7 != 0, F.col("p_type")).alias("division"), F.when(F.col("p_size") > 25, F.col("p_partkey").cast("string")).alias("barcode"))
    return views.coverage(observations(spark, sf_dir).select("item", "store", "month"), items, ["month", "store"])


def _scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scrapes(spark, sf_dir).groupBy("day", "store").agg(F.count("*").alias("records"))


def q_scraper_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = scrapes(spark, sf_dir).where("event_type <> 'error'").withColumn("is_fallback", F.col("event_type") == "view")
    out = views.scraper_daily(_scrapes(spark, sf_dir), facts)
    return out.select("day", "store", "records", "items", *[F.round(c, 8).alias(c) for c in ("avg_price", "min_price", "max_price")], "fallback_pct", "status")


def q_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _scrapes(spark, sf_dir).where("NOT (store = 'store3' AND day > DATE '2024-01-27') AND NOT (store = 'store5' AND day > DATE '2024-01-24')")
    return views.source_health(late, F.lit("2024-01-30").cast("date"))


def q_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = views.price_alerts(_facts(spark, sf_dir))
    return out.select("day", "store", "item", F.round("price", 7).alias("price"), F.round("before", 7).alias("before"), F.round("change", 6).alias("change"), "level")


def q_fx_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.fx_health(exchange_rates(spark, sf_dir))


def q_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, headline = divisions_and_headline(spark, sf_dir)
    both = found.join(rounded_headline(headline).drop("coverage"), "month").withColumnRenamed("month", "day")
    return views.inflation_summary(both)


def _official(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for an official index."""
    o = table(spark, sf_dir, "orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(F.avg("o_totalprice").alias("v"))
    return o.where("month >= DATE '1995-06-01'").select("month", (F.col("v") / 1000).alias("official"))


def _benchmark(own: DataFrame, official: DataFrame) -> DataFrame:
    """Both are read twice, so they are written first: a row a month."""
    return views.benchmark(written(own, "own-index"), written(official, "official-index"))


def q_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = q_headline(spark, sf_dir).where("month < DATE '2000-06-01'").select("month", F.col("headline").alias("own"))
    return _benchmark(own, _official(spark, sf_dir)).select("month", "own", *[F.round(c, 4).alias(c) for c in ("official", "rebased", "error")], "same_direction")


def q_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = q_headline(spark, sf_dir).select("month", F.col("headline").alias("own"))
    out = views.accuracy(_benchmark(own, _official(spark, sf_dir)))
    return out.select(*[F.round(c, 6).alias(c) for c in ("rmse", "mae", "correlation", "hit_rate")], "months")


def q_nowcast_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = q_headline(spark, sf_dir).select("month", F.col("headline").alias("forecast"), (F.col("headline") - 20).alias("low"), (F.col("headline") + 20).alias("high"))
    official = _official(spark, sf_dir).withColumnRenamed("official", "actual")
    return views.nowcast_evaluation(own, official).select("month", "forecast", F.round("actual", 4).alias("actual"), "error", "inside")


def q_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = views.price_alerts(_facts(spark, sf_dir))
    return views.top_movers(alerts.withColumn("change", F.round("change", 8))).select("day", "store", "item", "change")


def q_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir).where("month = DATE '1998-03-01'").select("item", "division", "ratio")
    weights = class_weights(spark, sf_dir).groupBy("division").agg(F.sum("weight").alias("weight"))
    return views.contributions(rows, weights).select("item", "division", F.round("contribution", 6).alias("contribution"))


def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = index.item_prices(observations(spark, sf_dir))
    base = index.base_prices(observations(spark, sf_dir))
    return views.relative_histogram(index.elementary(prices, base).withColumnRenamed("ratio", "relative"))


def q_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.day_matrix(scrapes(spark, sf_dir), ["2024-01-28", "2024-01-29", "2024-01-30"])


def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.completeness(scrapes(spark, sf_dir).where("event_type = 'signup'"), "2024-01-01", "2024-01-20")


def q_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.latest_by_store(scrapes(spark, sf_dir)).select("store", "day", "event_id", "event_type")


def q_imputation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = index.impute(index.item_prices(observations(spark, sf_dir)), [["class"], ["division"]])
    return filled.groupBy("month").agg(F.round(100.0 * F.count_if("imputed") / F.count("*"), 4).alias("imputed_pct"), F.count("*").alias("items"))


SCR = "scr AS (SELECT CAST(ts AS DATE) AS day, 'store' || (user_id % 12) AS store, user_id AS item, value AS price, event_type, event_id FROM events WHERE value IS NOT NULL)"
DAYS = "days AS (SELECT day, store, count(*) AS records FROM scr GROUP BY ALL)"
FACTS = """modes AS (SELECT day, store, item, class, row_number() OVER (PARTITION BY day, store, item ORDER BY count(*) DESC, class) AS no FROM obs GROUP BY day, store, item, class),
  facts AS (SELECT o.day, o.store, o.item, exp(avg(ln(price))) AS price, count(*) AS observations, bool_or(on_promo) AS any_promo, bool_and(on_promo) AS all_promo, max(discount) AS discount, any_value(m.class) AS class
    FROM obs o JOIN modes m ON m.day = o.day AND m.store = o.store AND m.item = o.item AND no = 1 GROUP BY o.day, o.store, o.item)"""
ALERTS = """l AS (SELECT *, lag(price) OVER (PARTITION BY store, item ORDER BY day) AS before FROM facts),
  alerts AS (SELECT *, (price - before) / before AS change FROM l WHERE before > 0 AND abs((price - before) / before) >= 0.2)"""
OFFICIAL = "official AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) / 1000 AS official FROM orders GROUP BY 1 HAVING CAST(date_trunc('month', o_orderdate) AS DATE) >= DATE '1995-06-01')"


def _compared(last: str) -> str:
    return f"""own AS (SELECT month, round(headline, 4) AS own FROM headline {last}), {OFFICIAL}, f AS (SELECT month, own, official FROM own FULL JOIN official USING (month)),
  a AS (SELECT arg_min(own, month) AS ao, arg_min(official, month) AS aoff FROM f WHERE own IS NOT NULL AND official IS NOT NULL), r AS (SELECT f.*, own / ao * aoff AS rebased FROM f, a),
  c AS (SELECT *, rebased / lag(rebased) OVER (ORDER BY month) - 1 AS oc, official / lag(official) OVER (ORDER BY month) - 1 AS fc FROM r),
  compared AS (SELECT month, own, official, rebased, rebased - official AS error, sign(oc) = sign(fc) AS same_direction FROM c)"""


QUERIES = {
    "fct_daily_prices": (q_facts, f"WITH {OBS}, {FACTS} SELECT day, store, item, round(price, 7) AS price, observations, any_promo, all_promo, discount, class FROM facts"),
    "dim_items": (q_items, f"""WITH {OBS} SELECT item, min(day) AS first_day, max(day) AS last_day, count(*) AS observations, count(DISTINCT store) AS stores, bool_or(on_promo) AS ever_promoted, any_value(name) AS name, any_value(class) AS class,
        CASE WHEN DATE '2001-06-01' - max(day) > 90 THEN 'dormant' WHEN min(day) = max(day) THEN 'new' ELSE 'active' END AS status FROM obs GROUP BY item"""),
    "dim_stores": (q_stores, f"""WITH {OBS}, a AS (SELECT store, count(*) AS facts, count(DISTINCT item) AS items, min(day) AS first_day, max(day) AS last_day FROM obs GROUP BY store)
        SELECT s_suppkey AS store, s_name AS store_name, s_nationkey AS channel, coalesce(facts, 0) AS facts, coalesce(items, 0) AS items, first_day, last_day FROM supplier LEFT JOIN a ON store = s_suppkey"""),
    "dim_stores_all": (q_stores, f"""WITH {OBS}, a AS (SELECT store, count(*) AS facts, count(DISTINCT item) AS items, min(day) AS first_day, max(day) AS last_day FROM obs GROUP BY store)
        SELECT s_suppkey AS store, s_name AS store_name, s_nationkey AS channel, coalesce(facts, 0) AS facts, coalesce(items, 0) AS items, first_day, last_day FROM supplier LEFT JOIN a ON store = s_suppkey"""),
    "v_coverage": (q_coverage, f"""WITH {OBS}, i AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '99' WHEN p_size % 7 <> 0 THEN p_type END AS d, CASE WHEN p_size > 25 THEN p_partkey END AS barcode FROM part)
        SELECT month, store, count(*) AS observations, count(DISTINCT item) AS items, count(*) FILTER (d IS NULL OR d = '99') AS unclassified, round(count(*) FILTER (d <> '99') * 100.0 / count(*), 2) AS classified_pct,
        count(barcode) AS barcodes, round(count(barcode) * 100.0 / count(*), 2) AS barcode_pct FROM obs JOIN i ON item = p_partkey GROUP BY month, store"""),
    "v_monitor_scraper_daily": (q_scraper_daily, f"""WITH {SCR}, {DAYS}, s AS (SELECT day, store, count(DISTINCT item) AS items, avg(price) AS a, min(price) AS mi, max(price) AS ma, round(count(*) FILTER (event_type = 'view') * 100.0 / count(*), 1) AS fallback_pct
        FROM scr WHERE event_type <> 'error' GROUP BY ALL) SELECT d.day, d.store, records, coalesce(items, records) AS items, round(a, 8) AS avg_price, round(mi, 8) AS min_price, round(ma, 8) AS max_price, fallback_pct,
        CASE WHEN records = 0 THEN 'EMPTY_WARNING' WHEN fallback_pct > 50 THEN 'FALLBACK_ACTIVE' ELSE 'HEALTHY' END AS status FROM days d LEFT JOIN s ON s.day = d.day AND s.store = d.store"""),
    "v_monitor_source_health": (q_source_health, f"""WITH {SCR}, {DAYS}, s AS (SELECT store, max(day) AS last_day, count(DISTINCT day) AS active_days, round(avg(records), 0) AS avg_records FROM days
        WHERE day >= DATE '2024-01-23' AND NOT (store = 'store3' AND day > DATE '2024-01-27') AND NOT (store = 'store5' AND day > DATE '2024-01-24') GROUP BY store), g AS (SELECT *, CAST(DATE '2024-01-30' - last_day AS INTEGER) AS days_since FROM s)
        SELECT *, CASE WHEN days_since = 0 THEN 'ONLINE_FRESH' WHEN days_since <= 1 THEN 'ONLINE_YESTERDAY' WHEN days_since <= 3 THEN 'DELAYED_WARNING' ELSE 'OFFLINE_CRITICAL' END AS health FROM g"""),
    "v_monitor_price_alerts": (q_alerts, f"""WITH {OBS}, {FACTS}, {ALERTS} SELECT day, store, item, round(price, 7) AS price, round(before, 7) AS before, round(change, 6) AS change,
        CASE WHEN change > 1 THEN 'CRITICAL_SPIKE' WHEN change > 0.3 THEN 'HIGH_SURGE' WHEN change < -0.5 THEN 'CRITICAL_DROP' WHEN change < -0.3 THEN 'HIGH_DROP' ELSE 'MODERATE_SHIFT' END AS level FROM alerts"""),
    "v_monitor_fx_health": (q_fx_health, """WITH fx AS (SELECT CAST(ts AS DATE) AS day, round(4000 + avg(value), 2) AS rate FROM events WHERE day(CAST(ts AS DATE)) % 3 <> 0 GROUP BY 1)
        SELECT day, rate, round((rate - lag(rate) OVER (ORDER BY day)) / lag(rate) OVER (ORDER BY day) * 100.0, 3) + 0.0 AS change FROM fx"""),
    "v_inflation_summary": (q_inflation, f"""WITH {CHAIN}, h AS (SELECT month, round(headline, 4) AS headline, round(core, 4) AS core FROM headline), t AS (SELECT month AS day, max(headline) AS headline, max(core) AS core, CAST(sum(items) AS BIGINT) AS items FROM divisions JOIN h USING (month) GROUP BY 1)
        SELECT *, round((headline - lag(headline) OVER (ORDER BY day)) / lag(headline) OVER (ORDER BY day) * 100.0, 3) + 0.0 AS headline_change, round((core - lag(core) OVER (ORDER BY day)) / lag(core) OVER (ORDER BY day) * 100.0, 3) + 0.0 AS core_change FROM t"""),
    "benchmark_comparison": (q_benchmark, f"WITH {CHAIN}, {_compared("WHERE month < DATE '2000-06-01'")} SELECT month, own, round(official, 4) AS official, round(rebased, 4) AS rebased, round(error, 4) AS error, same_direction FROM compared"),
    "benchmark_accuracy": (q_accuracy, f"""WITH {CHAIN}, {_compared('')} SELECT round(sqrt(avg(error * error)), 6) AS rmse, round(avg(abs(error)), 6) AS mae, round(corr(rebased, official), 6) AS correlation,
        round(avg(CAST(same_direction AS INTEGER)), 6) AS hit_rate, count(*) AS months FROM compared WHERE error IS NOT NULL"""),
    "v_nowcast_evaluation": (q_nowcast_evaluation, f"""WITH {CHAIN}, {OFFICIAL}, f AS (SELECT month, round(headline, 4) AS forecast FROM headline) SELECT month, forecast, round(official, 4) AS actual, round(forecast - official, 4) AS error,
        coalesce(official BETWEEN forecast - 20 AND forecast + 20, false) AS inside FROM f LEFT JOIN official USING (month)"""),
    "top_movers": (q_movers, f"WITH {OBS}, {FACTS}, {ALERTS} SELECT day, store, item, round(change, 8) AS change FROM alerts ORDER BY abs(round(change, 8)) DESC, item, store, day LIMIT 20"),
    "top_contributions": (q_contributions, f"""WITH {CHAIN}, r AS (SELECT item, division, ratio, count(*) OVER (PARTITION BY division) AS members FROM kept WHERE month = DATE '1998-03-01')
        SELECT item, division, round((ratio - 1) * 100 * weight / members, 6) AS contribution FROM r JOIN dw USING (division) ORDER BY abs((ratio - 1) * 100 * weight / members) DESC, item LIMIT 25"""),
    "relative_histogram": (q_histogram, f"WITH {OBS}, {PRICES}, {BASE}, {RATIOS} SELECT round(ln(ratio), 1) AS bin, count(*) AS n FROM ratios GROUP BY 1"),
    "day_matrix": (q_matrix, f"""WITH {SCR} SELECT store, count(*) FILTER (day = DATE '2024-01-28') AS d0, count(*) FILTER (day = DATE '2024-01-29') AS d1, count(*) FILTER (day = DATE '2024-01-30') AS d2 FROM scr GROUP BY store"""),
    "completeness": (q_completeness, f"""WITH {SCR} SELECT store, count(DISTINCT day) AS days, round(100.0 * count(DISTINCT day) / 20, 2) AS pct FROM scr
        WHERE event_type = 'signup' AND day BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' GROUP BY store"""),
    "latest_by_store": (q_latest, f"WITH {SCR} SELECT store, day, event_id, event_type FROM scr QUALIFY row_number() OVER (PARTITION BY store ORDER BY day DESC, event_id DESC) = 1"),
    "imputation_rate": (q_imputation_rate, None),
}
