"""Queries of matching, hedonics, nowcasts, storage and streams; SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.operators import classify, clean, hedonic, match, nowcast, vectors
from basketry.plans.index_queries import CHAIN, CORE_WITHOUT, FACTORS, OBS, ROLLING, WEIGHTS, class_weights, divisions, q_headline
from basketry.plans.view_queries import OFFICIAL, _official
from basketry.sources.storage import catalog_of, offloadable
from basketry.sources.scratch import written
from basketry.sources.tables import exchange_rates, observations, table
from basketry.streaming.windows import daily_counts


def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = vectors.nearest_vectors(rows.where("id % 50 = 0"), rows, 30)
    return found.select("query", "neighbour", F.round("similarity", 6).alias("similarity"), "rank")


def q_near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of each fiftieth vector with a decision, a sample; ``merge_pairs`` goes over all."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = vectors.nearest_vectors(rows.where("id % 50 = 0"), rows, 5)
    return found.select("query", "neighbour", match.decide("similarity", 0.9, 0.7).alias("decision"))


def q_merge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge candidates among all vectors."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return match.similar_pairs(rows).select("id", "other", F.round("similarity", 6).alias("similarity"), "decision")


def q_nearest_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an inverted file finds of ``nearest_vectors``."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.nearest_indexed(rows.where("id % 50 = 0"), rows, 30).select("query", "neighbour", F.round("similarity", 6).alias("similarity"), "rank")


def _groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.similar_groups(rows, match.MERGE)


def q_merge_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``merge_pairs`` between groups of equal vectors, by an inverted file."""
    decision = F.when(F.col("similarity") > match.SUGGEST, "merge").otherwise("review")
    return _groups(spark, sf_dir)[1].select("a", "b", F.round("similarity", 6).alias("similarity"), decision.alias("decision"))


def q_merge_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal vectors of every vector, and how many pairs with other groups it has."""
    members, pairs = _groups(spark, sf_dir)
    links = pairs.select(F.explode(F.array("a", "b")).alias("group")).groupBy("group").agg(F.count("*").alias("links"))
    return members.join(links, "group", "left").select("id", "group", F.coalesce("links", F.lit(0)).alias("links"))


def q_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    items = part.select(F.col("p_partkey").alias("item"), F.concat(F.lit(" "), "p_name").alias("name"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string")).alias("size"),
                        F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("1234567"), "p_partkey")).alias("barcode"), F.col("p_retailprice").alias("created"))
    return match.merge_duplicates(items).select("item", "master", "members")


def q_merge_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by the item that is left after the merge of duplicates."""
    merges = q_duplicates(spark, sf_dir).select("item", "master")
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item"), "l_quantity")
    return match.repointed(facts, merges).groupBy("item").agg(F.count("*").alias("facts"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def q_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue of names with equal, differing and unclear specifications; some codes and names are known."""
    part, n = table(spark, sf_dir, "part"), F.col("p_size")
    named = lambda size: F.concat("p_name", F.lit(" "), size, F.lit("GB"))
    proposed = F.when(n % 3 == 0, F.concat(F.lit("  "), F.upper(named(n)), F.lit(" "))).when(n % 5 == 0, F.concat("p_name", F.lit(" extra"))).otherwise(named(n + 1))
    queue = part.select(F.col("p_partkey").alias("review"), (F.col("p_partkey") * 10).alias("raw_id"), named(n).alias("raw_name"), F.concat(F.lit("p"), "p_partkey").alias("item"), proposed.alias("item_name"),
                        F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("88"), n)).alias("barcode"), F.col("p_brand").alias("brand"), F.lit(None).cast("string").alias("size"))
    none = F.lit(None).cast("string")
    codes = part.where("p_size <= 10").select(F.concat(F.lit("c"), n).alias("item"), none.alias("name"), F.concat(F.lit("88"), n).alias("barcode"), none.alias("size")).distinct()
    known = part.where("p_partkey % 7 = 0").select(F.concat(F.lit("n"), "p_partkey"), named(n), none, none)
    return match.reviewed(queue, codes.union(known))


def q_pattern_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    items = part.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("store"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    store = F.when(F.col("p_partkey") % 40 == 0, F.col("p_brand")).otherwise(F.lit(""))
    rules = part.where("p_partkey % 20 = 0").select(F.concat(F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))), F.lit("\\s+[a-f][a-z]*")).alias("value"), store.alias("store"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0").alias("division"))
    return classify.pattern_overrides(items, rules.distinct()).select("item", "override_division")


def q_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(observations(spark, sf_dir).select("item", "store", "name").distinct(), "records")
    records = rows.select((F.col("item") * 10000 + F.col("store")).alias("raw_id"), "store", F.when(F.col("item") % 3 == 0, F.concat(F.lit("88"), F.lpad(F.col("item").cast("string"), 8, "0"))).alias("barcode"),
                          F.when(F.col("item") % 5 == 0, F.col("item").cast("string")).alias("sku"), "name", (F.col("item") % 2).cast("string").alias("size"))
    part = table(spark, sf_dir, "part")
    barcodes = part.where("p_partkey % 6 = 0").select(F.concat(F.lit("88"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("barcode"), F.concat(F.lit("p"), "p_partkey").alias("item"))
    skus = rows.where("item % 10 = 0").select("store", F.col("item").cast("string").alias("sku"), F.concat(F.lit("p"), "item").alias("item"))
    names = part.where("p_partkey % 7 = 0").groupBy(F.col("p_name").alias("name"), (F.col("p_partkey") % 2).cast("string").alias("size")).agg(F.concat(F.lit("p"), F.min("p_partkey")).alias("item"))
    return match.ladder(records, barcodes, skus, names)


def q_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.lit(None).cast("string").alias("size"), "p_brand")
    queries = part.where("id % 50 = 0").withColumn("name", F.concat_ws(" ", F.element_at(F.split("name", " "), -1), F.col("name")))
    return match.fuzzy_match(queries, part, ["p_brand"], 0.6)


def q_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.lit(1).alias("store"), F.col("p_brand").alias("class"), F.col("p_name").alias("name"), F.col("p_size").cast("double").alias("size"))
    return match.replacements(part.where("item % 50 = 0"), part.where("item % 50 <> 0"))


FEATURES = ["l_quantity", "l_discount"]


def q_hedonic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = hedonic.fit(table(spark, sf_dir, "lineitem").select(*FEATURES, F.col("l_extendedprice").alias("price")), FEATURES)
    return spark.createDataFrame([(k, round(v, 6) + 0.0) for k, v in sorted(fit.items())], "feature string, coefficient double")


def q_hedonic_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *FEATURES, F.col("l_extendedprice").alias("price"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"))
    return hedonic.adjusted_by_month(rows, hedonic.fit(rows, FEATURES), FEATURES).select("l_orderkey", "month", "price", "adjusted")


def _hedonic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *FEATURES, F.col("l_extendedprice").alias("price"), F.col("l_shipdate").cast("date").alias("day"))


def q_rolling_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hedonic.rolling_fits(_hedonic_rows(spark, sf_dir), FEATURES).where("beta IS NOT NULL")
    return found.select("day", "n", *[(F.round(F.col("beta")[i], 6) + 0.0).alias(name) for i, name in enumerate(["constant", *FEATURES])], F.round("r2", 6).alias("r2"))


def q_rolling_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hedonic.rolling_adjusted(_hedonic_rows(spark, sf_dir), FEATURES)
    return found.select("l_orderkey", "l_linenumber", "day", (F.round("factor", 6)).alias("factor"))


def q_model_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).groupBy("division", "day").agg(F.avg("price").alias("index"))
    daily = nowcast.momentum(obs, ["division"], "index", [7], "momentum").withColumn("prior", F.lit(0.0002))
    found = nowcast.model_backtest(daily, ["momentum_7"], alphas=[1.0])
    return found.select("horizon", *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "hits")], "cases")


def _cards(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cards of the tenth and twentieth day of each month, with the structural prior."""
    obs = observations(spark, sf_dir).groupBy("division", "day").agg(F.avg("price").alias("index"))
    none = {c: F.lit(0.0) for c in ("momentum_14", "fx_7", "fx_14", "in_holiday")}
    daily = nowcast.structural_prior(nowcast.momentum(obs, ["division"], "index", [7], "momentum").withColumns(none))
    daily = written(daily, "nowcast-days")
    weights = class_weights(spark, sf_dir).groupBy("division").agg(F.sum("weight").alias("weight"))
    found = nowcast.projected(nowcast.expanding_drifts(daily, ["momentum_7"], (10, 20), [1.0]))
    return nowcast.division_cards(found, daily, weights), daily, weights


def q_nowcast_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, _, _ = _cards(spark, sf_dir)
    return cards.select("division", "month", "horizon", "day", *[F.round(c, 4).alias(c) for c in ("weight", "realized", "latest", "projected", "nowcast", "prior", "change", "contribution")])


def q_nowcast_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nowcast.headline_cards(*_cards(spark, sf_dir), CORE_WITHOUT)
    return found.select("month", "horizon", "day", *[F.round(c, 4).alias(c) for c in ("headline", "core", "prior", "change", "sigma", "low", "high")])


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("value > 0")
    return e.groupBy(F.col("event_type").alias("division"), F.col("ts").cast("date").alias("day")).agg(F.avg("value").alias("index"))


def q_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nowcast.momentum(_daily(spark, sf_dir), ["division"], "index", [3, 7, 14], "momentum")
    return out.select("division", "day", *[(F.round(f"momentum_{k}", 6) + 0.0).alias(f"momentum_{k}") for k in (3, 7, 14)])


def q_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nowcast.training_target(_daily(spark, sf_dir), ["division"]).select("division", "day", (F.round("target", 6) + 0.0).alias("target"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nowcast.momentum(_daily(spark, sf_dir), ["division"], "index", [3, 7, 14], "momentum")
    fx = nowcast.momentum(exchange_rates(spark, sf_dir), [], "rate", [7, 14], "fx").select("day", "fx_7", "fx_14")
    holidays = spark.createDataFrame([("2024-01-07",)], "h string").select(F.col("h").cast("date").alias("holiday"))
    rows = nowcast.holiday_features(nowcast.training_target(rows, ["division"]).join(F.broadcast(fx), "day", "left"), holidays)
    return nowcast.structural_prior(rows.fillna(0.0, ["fx_7", "fx_14"]))


def q_drifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nowcast.drifts(_features(spark, sf_dir).where("day <= DATE '2024-01-22'"))


def q_nowcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir).where("day <= DATE '2024-01-22'")
    seen = daily.groupBy("division").agg(F.avg("index").alias("month_mean"), F.count("*").alias("days_seen"))
    now = q_drifts(spark, sf_dir).join(seen, "division")
    weights = seen.select("division", F.lit(20.0).alias("weight"))
    days = nowcast.daily_headlines(daily, weights)
    sigma = days.agg(F.stddev_samp("headline")).first()[0]  # of the month's days so far
    return nowcast.headline_nowcast(nowcast.projected(now), weights, 50.0, 219.1, sigma or 0.25)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = q_headline(spark, sf_dir).select("month", F.col("headline").alias("forecast"))
    return own.join(_official(spark, sf_dir).withColumnRenamed("official", "actual"), "month")


def q_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nowcast.evaluation(_pairs(spark, sf_dir)).select("month", F.round("error", 4).alias("error"), "hit", F.round("rolling_mae", 4).alias("rolling_mae"))


def q_random_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nowcast.against_random_walk(_pairs(spark, sf_dir)).select(*[F.round(c, 6).alias(c) for c in ("rmse", "walk_rmse", "relative")], "months")


def q_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).groupBy("division", "day").agg(F.avg("price").alias("index"))
    return nowcast.horizon_backtest(obs).select("horizon", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), "cases")


def q_stationary(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = observations(spark, sf_dir).select("month").distinct()
    panel = months.join(_official(spark, sf_dir).where("month(month) <> 7"), "month", "left")
    return nowcast.stationary(panel, ["official"]).select("month", F.round("official", 4).alias("official"), (F.round("d_official", 6) + 0.0).alias("d_official"))


def q_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibration panel of the official index and a division, with rates of some months and festivals in April and November."""
    official = _official(spark, sf_dir).withColumnRenamed("official", "headline")
    share = observations(spark, sf_dir).where("division = 'ECONOMY'").groupBy("month").agg(F.avg("price").alias("economy"))
    rates = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND month(o_orderdate) <> 5").select(F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") / 40).alias("rate"))
    months = official.select("month").where("month(month) IN (4, 11)").select("month", F.when(F.month("month") == 4, 1.0).otherwise(0.5).alias("score"))
    found = nowcast.calibration_panel(official.join(share, "month"), rates, months, ["headline", "economy"])
    return found.select("month", *[(F.round(c, 6) + 0.0).alias(c) for c in ("d_headline", "d_economy", "d_fx", "target", "walk")], "festival_score", "is_festival")


def q_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics kept by evaluation, month and model: an evaluation over the first years, then one over all, on the same day."""
    pairs = written(_pairs(spark, sf_dir), "forecast-pairs")
    first, second = (nowcast.performance(p, "own", "2003-01-01").withColumn("run", F.lit(i)) for i, p in enumerate((pairs.where("month < DATE '1998-01-01'"), pairs)))
    kept = clean.upserted(first, second, ["evaluated", "month", "model"], "run")
    return kept.select("evaluated", "month", "model", *[F.round(c, 4).alias(c) for c in ("error", "rolling_rmse", "rolling_mae", "relative", "walk_rmse")], "hit", "run")


def q_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    along = Window.partitionBy("division").orderBy("month")
    rows = divisions(spark, sf_dir).withColumn("target", F.ln(F.col("index") / F.lag("index").over(along)))
    rows = rows.withColumns({"lag_1": F.lag("target").over(along), "lag_2": F.lag("target", 2).over(along), "series": F.col("division")})
    return nowcast.calibrated(rows, ["lag_1", "lag_2"])


def q_offloadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = observations(spark, sf_dir).where("year(day) = 1995 AND month(day) < 4").select(F.year("day").alias("year"), F.month("day").alias("month")).distinct()
    return offloadable(observations(spark, sf_dir), "day", done, "2001-09-15", 3)


def q_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of all tables' files."""
    return catalog_of(spark, sf_dir).select(F.regexp_extract("path", r"([^/]+\.parquet(?:/.+)?)$", 1).alias("file"), "length", "sha256")


def q_stream_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))).select(F.col("window.start").cast("date").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


DAILY = "daily AS (SELECT event_type AS division, CAST(ts AS DATE) AS day, avg(value) AS index FROM events WHERE value > 0 GROUP BY ALL)"
PAIRS = f"WITH {CHAIN}, {OFFICIAL}, pairs AS (SELECT month, round(headline, 4) AS forecast, official AS actual FROM headline JOIN official USING (month))"
NORMAL = """s AS (SELECT count(*) AS n, sum(l_quantity) AS a, sum(l_discount) AS b, sum(l_quantity * l_quantity) AS aa, sum(l_quantity * l_discount) AS ab, sum(l_discount * l_discount) AS bb,
  sum(ln(l_extendedprice)) AS y, sum(l_quantity * ln(l_extendedprice)) AS ay, sum(l_discount * ln(l_extendedprice)) AS byy FROM lineitem WHERE l_extendedprice > 0),
  c AS (SELECT *, aa - a * a / n AS saa, ab - a * b / n AS sab, bb - b * b / n AS sbb, ay - a * y / n AS say, byy - b * y / n AS sby FROM s),
  beta AS (SELECT (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS qa, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS qb, n, a, b, y FROM c)"""
GROUPS = """WITH g AS (SELECT CAST(embedding AS DOUBLE[]) AS v, min(vec_id) AS id FROM embeddings GROUP BY 1),
        p AS (SELECT x.id AS a, y.id AS b, list_cosine_similarity(x.v, y.v) AS s FROM g x JOIN g y ON x.id < y.id WHERE list_cosine_similarity(x.v, y.v) >= 0.95)"""
def _drift_sql(prior: str) -> str:
    """Drifts of the model with one feature and one penalty, at each month and horizon."""
    return f"""{OBS}, d0 AS (SELECT division, day, month, avg(price) AS index FROM obs GROUP BY ALL),
        d1 AS (SELECT *, ln(index / coalesce(lag(index, 6) OVER w, first_value(index) OVER w)) AS x, day(last_day(day)) - day(day) AS rest FROM d0 WINDOW w AS (PARTITION BY division ORDER BY day)),
        d AS (SELECT *, sum(index) OVER a AS s, count(*) OVER a AS c, sum(index) OVER (PARTITION BY division, month) AS ms, count(*) OVER (PARTITION BY division, month) AS mc
              FROM d1 WINDOW a AS (PARTITION BY division, month ORDER BY day ROWS UNBOUNDED PRECEDING)),
        seen AS (SELECT division, month, h, max(day) AS day, arg_max(index, day) AS latest, arg_max(s, day) AS ss, arg_max(c, day) AS sc, arg_max(x, day) AS x
                 FROM d, (VALUES (5), (10), (15), (20), (25), (30)) t(h) WHERE day(day) <= h AND h <= day(last_day(month)) GROUP BY division, month, h),
        full_t AS (SELECT division, month, x, ln((ms - s) / (mc - c) / index) / ((rest + 1) / 2.0) AS y FROM d WHERE rest >= 2 AND mc > c),
        tr AS (SELECT q.division, q.month, q.h, f.x, f.y FROM seen q JOIN full_t f ON f.division = q.division AND f.month < q.month UNION ALL
               SELECT q.division, q.month, q.h, d.x, ln((ss - s) / (sc - c) / index) / ((rest + 1) / 2.0) FROM seen q JOIN d ON d.division = q.division AND d.month = q.month AND d.day < q.day WHERE rest >= 2 AND sc > c),
        g AS (SELECT division, month, h, count(*) AS n, avg(x) AS mx, avg(y) AS my, sum(x * y) - count(*) * avg(x) * avg(y) AS xy, sum(x * x) - count(*) * avg(x) * avg(x) AS xx FROM tr GROUP BY ALL),
        p AS (SELECT q.*, coalesce(n, 0) AS n, my + (q.x - mx) * xy / (xx + 1.0) AS own, least(1.0, greatest(0.0, 1 - (n - 8) / 22.0)) AS w FROM seen q LEFT JOIN g USING (division, month, h)),
        k AS (SELECT *, least(greatest(CASE WHEN n >= 8 THEN w * {prior} + (1 - w) * own ELSE {prior} END, -0.015), 0.015) AS drift, day(last_day(day)) - day(day) AS lft, day(day) / day(last_day(day)) AS share FROM p),"""


DRIFTS = _drift_sql("0.0002")
CARDS = f"""{WEIGHTS}, {_drift_sql("coalesce(x, 0) / 14 * 0.3")}
        f AS (SELECT *, CASE WHEN lft > 0 THEN latest * CASE WHEN abs(drift) < 1e-12 THEN 1.0 ELSE exp(drift) * (pow(exp(drift), lft) - 1) / (exp(drift) - 1) / lft END ELSE ss / sc END AS ahead FROM k WHERE h IN (10, 20)),
        w AS (SELECT division, sum(weight) / (SELECT sum(l_extendedprice) / 1e6 FROM lineitem JOIN part ON l_partkey = p_partkey) AS weight FROM weights GROUP BY division),
        lm AS (SELECT division, month, lag(arg_max(index, day)) OVER (PARTITION BY division ORDER BY month) AS prior FROM d GROUP BY division, month),
        cards AS (SELECT f.division, f.month, h AS horizon, f.day, weight, ss / sc AS realized, latest, ahead AS projected, CASE WHEN lft > 0 THEN share * ss / sc + (1 - share) * ahead ELSE ss / sc END AS nowcast, coalesce(prior, 100.0) AS prior
                  FROM f JOIN w USING (division) LEFT JOIN lm ON lm.division = f.division AND lm.month = f.month)"""


QUERIES = {
    "nearest_vectors": (q_nearest, """WITH p AS (SELECT q.vec_id AS query, r.vec_id AS neighbour, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS s FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0),
        k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY s DESC, neighbour) AS INTEGER) AS rank FROM p) SELECT query, neighbour, round(s, 6) AS similarity, rank FROM k WHERE rank <= 30"""),
    "merge_candidates": (q_near_pairs, """WITH p AS (SELECT q.vec_id AS query, r.vec_id AS neighbour, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS s FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query, neighbour, CASE WHEN s >= 0.9 THEN 'match' WHEN s >= 0.7 THEN 'review' ELSE 'new' END AS decision FROM p QUALIFY row_number() OVER (PARTITION BY query ORDER BY s DESC, neighbour) <= 5"""),
    "merge_pairs": (q_merge_pairs, """WITH p AS (SELECT a.vec_id AS id, b.vec_id AS other, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)
        SELECT id, other, round(s, 6) AS similarity, CASE WHEN s > 0.98 THEN 'merge' ELSE 'review' END AS decision FROM p WHERE s >= 0.95"""),
    "nearest_indexed": (q_nearest_indexed, None),
    "merge_groups": (q_merge_groups, f"""{GROUPS} SELECT a, b, round(s, 6) AS similarity, CASE WHEN s > 0.98 THEN 'merge' ELSE 'review' END AS decision FROM p"""),
    "merge_members": (q_merge_members, f"""{GROUPS}, l AS (SELECT a AS g, b AS h FROM p UNION ALL SELECT b, a FROM p)
        SELECT vec_id AS id, g.id AS "group", (SELECT count(*) FROM l WHERE l.g = g.id) AS links FROM embeddings JOIN g ON v = CAST(embedding AS DOUBLE[])"""),
    "merge_duplicates": (q_duplicates, """WITH i AS (SELECT p_partkey AS item, upper(trim(p_name)) AS nm, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS size, p_partkey % 4 = 0 AS coded, p_retailprice AS created FROM part),
        z AS (SELECT nm, count(DISTINCT size) AS k, max(size) AS only_size FROM i GROUP BY nm), j AS (SELECT i.*, coalesce(size, CASE WHEN k = 1 THEN only_size END, '') AS sz FROM i JOIN z USING (nm))
        SELECT item, first_value(item) OVER (PARTITION BY nm, sz ORDER BY CASE WHEN coded THEN 0 ELSE 1 END, created, item) AS master, count(*) OVER (PARTITION BY nm, sz) AS members FROM j"""),
    "merge_applied": (q_merge_applied, """WITH i AS (SELECT p_partkey AS item, upper(trim(p_name)) AS nm, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS size, p_partkey % 4 = 0 AS coded, p_retailprice AS created FROM part),
        z AS (SELECT nm, count(DISTINCT size) AS k, max(size) AS only_size FROM i GROUP BY nm), j AS (SELECT i.*, coalesce(size, CASE WHEN k = 1 THEN only_size END, '') AS sz FROM i JOIN z USING (nm)),
        m AS (SELECT item, first_value(item) OVER (PARTITION BY nm, sz ORDER BY CASE WHEN coded THEN 0 ELSE 1 END, created, item) AS master FROM j)
        SELECT master AS item, count(*) AS facts, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN m ON l_partkey = item GROUP BY master"""),
    "review_queue": (q_review_queue, """WITH q AS (SELECT p_partkey AS review, p_partkey * 10 AS raw_id, 'p' || p_partkey AS item, upper(p_name || ' ' || p_size || 'GB') AS title, p_size % 3 = 0 AS same, p_size % 5 <> 0 AS apart, p_size, p_brand,
          CASE WHEN p_partkey % 4 = 0 THEN '88' || p_size END AS code FROM part),
        names AS (SELECT upper(p_name || ' ' || p_size || 'GB') AS title, min('n' || p_partkey) AS by_name FROM part WHERE p_partkey % 7 = 0 GROUP BY 1),
        f AS (SELECT q.*, by_name, CASE WHEN code IS NOT NULL AND p_size <= 10 THEN 'c' || p_size END AS by_code FROM q LEFT JOIN names USING (title)),
        n AS (SELECT *, CASE WHEN NOT same AND by_code IS NULL AND by_name IS NULL THEN coalesce('b|' || code, 'n|' || title) END AS fresh FROM f),
        g AS (SELECT *, min(review) OVER (PARTITION BY fresh) AS maker FROM n)
        SELECT review, raw_id, CASE WHEN same THEN 'approve' ELSE 'split' END AS decision, CASE WHEN same THEN item ELSE coalesce(by_code, by_name, 'new' || maker) END AS item,
          CASE WHEN same THEN 'rule_guard' WHEN by_code IS NOT NULL THEN 'barcode' WHEN by_name IS NOT NULL THEN 'name' ELSE 'new' END AS method, CAST(CASE WHEN same OR apart OR by_code IS NOT NULL THEN 1.0 ELSE 0.85 END AS DOUBLE) AS confidence FROM g"""),
    "pattern_overrides": (q_pattern_overrides, r"""WITH i AS (SELECT p_partkey AS item, p_brand AS store, p_name || ' ' || p_type AS name FROM part),
        r AS (SELECT DISTINCT upper(split_part(p_name, ' ', 1)) || '\s+[a-f][a-z]*' AS value, CASE WHEN p_partkey % 40 = 0 THEN p_brand END AS scope, lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') AS division FROM part WHERE p_partkey % 20 = 0),
        h AS (SELECT item, arg_min(division, (scope IS NULL, -length(value), value, division)) AS override_division FROM i JOIN r ON (scope IS NULL OR scope = store) AND regexp_matches(name, '(?i)\b(?:' || lower(value) || ')\b') GROUP BY item)
        SELECT item, override_division FROM i LEFT JOIN h USING (item)"""),
    "matching_ladder": (q_ladder, f"""WITH {OBS}, r AS (SELECT DISTINCT item, store, name FROM obs), t AS (SELECT item * 10000 + store AS raw_id, item, store, name, CASE WHEN item % 3 = 0 AND item <> 0 THEN '88' || lpad(CAST(item AS VARCHAR), 8, '0') END AS barcode,
        CASE WHEN item % 5 = 0 THEN CAST(item AS VARCHAR) END AS sku, CAST(item % 2 AS VARCHAR) AS size FROM r),
        nm AS (SELECT p_name AS name, CAST(p_partkey % 2 AS VARCHAR) AS size, 'p' || min(p_partkey) AS found FROM part WHERE p_partkey % 7 = 0 GROUP BY ALL),
        m AS (SELECT t.*, found, CASE WHEN item % 6 = 0 AND item <> 0 THEN 'barcode' WHEN item % 10 = 0 THEN 'sku' WHEN found IS NOT NULL THEN 'name' END AS method,
          CASE WHEN barcode IS NOT NULL THEN 'b' || barcode WHEN sku IS NOT NULL THEN 's' || store || '|' || sku ELSE 'n' || name || '|' || size END AS key FROM t LEFT JOIN nm USING (name, size)),
        w AS (SELECT *, min(raw_id) OVER (PARTITION BY key) AS creator FROM m WHERE method IS NULL)
        SELECT raw_id, CASE method WHEN 'name' THEN found ELSE 'p' || item END AS item, method, CAST(CASE method WHEN 'barcode' THEN 1.0 WHEN 'sku' THEN 0.99 ELSE 0.97 END AS DOUBLE) AS confidence FROM m WHERE method IS NOT NULL
        UNION ALL SELECT raw_id, 'new' || creator, CASE WHEN raw_id = creator THEN 'new' ELSE 'new_in_batch' END, 1.0 FROM w"""),
    "fuzzy_match": (q_fuzzy, None),
    "product_replacements": (q_replacements, None),
    "hedonic_fit": (q_hedonic_fit, f"""WITH {NORMAL} SELECT 'l_quantity' AS feature, round(qa, 6) + 0.0 AS coefficient FROM beta UNION ALL SELECT 'l_discount', round(qb, 6) + 0.0 FROM beta
        UNION ALL SELECT '(constant)', round((y - qa * a - qb * b) / n, 6) FROM beta"""),
    "hedonic_prices": (q_hedonic_prices, None),
    "rolling_hedonics": (q_rolling_fits, f"""WITH {ROLLING} SELECT day, CAST(n AS BIGINT) AS n, round(y - b1 * x1 - b2 * x2, 6) + 0.0 AS constant, round(b1, 6) + 0.0 AS l_quantity, round(b2, 6) + 0.0 AS l_discount,
        round((b1 * s1y + b2 * s2y) / syy, 6) AS r2 FROM beta"""),
    "rolling_hedonic_prices": (q_rolling_prices, f"""WITH {ROLLING}, {FACTORS} SELECT l_orderkey, l_linenumber, day, round(factor, 6) AS factor FROM hf"""),
    "nowcast_cards": (q_nowcast_cards, f"""WITH {CARDS} SELECT division, month, horizon, day, round(weight, 4) AS weight, round(realized, 4) AS realized, round(latest, 4) AS latest, round(projected, 4) AS projected,
        round(nowcast, 4) AS nowcast, round(prior, 4) AS prior, round((nowcast / prior - 1) * 100, 4) AS change, round(weight * (nowcast / prior - 1) * 100, 4) AS contribution FROM cards"""),
    "nowcast_headlines": (q_nowcast_headlines, f"""WITH {CARDS}, hd AS (SELECT d.day, date_trunc('month', d.day) AS month, sum(index * weight) / sum(weight) AS headline FROM d JOIN w USING (division) GROUP BY d.day),
        gh AS (SELECT month, horizon, max(day) AS day, sum(nowcast * weight) / sum(weight) AS headline, sum(nowcast * weight) FILTER (division NOT IN ('ECONOMY', 'LARGE')) / sum(weight) FILTER (division NOT IN ('ECONOMY', 'LARGE')) AS core, sum(prior * weight) / sum(weight) AS prior FROM cards GROUP BY ALL),
        sp AS (SELECT gh.month, horizon, stddev_samp(hd.headline) AS own FROM gh JOIN hd ON hd.month = gh.month AND hd.day <= gh.day GROUP BY ALL),
        tt AS (SELECT gh.*, CASE WHEN own > 0 THEN own ELSE 0.25 END AS sigma FROM gh LEFT JOIN sp USING (month, horizon))
        SELECT month, horizon, day, round(headline, 4) AS headline, round(core, 4) AS core, round(prior, 4) AS prior, round((headline / prior - 1) * 100, 4) AS change, round(sigma, 4) AS sigma,
          round(greatest(headline - 1.95996 * sigma * sqrt((day(last_day(day)) - day(day)) / day(last_day(day))), 0.0), 4) AS low, round(headline + 1.95996 * sigma * sqrt((day(last_day(day)) - day(day)) / day(last_day(day))), 4) AS high FROM tt"""),
    "model_backtest": (q_model_backtest, f"""WITH {DRIFTS}
        f AS (SELECT *, CASE WHEN lft > 0 THEN share * ss / sc + (1 - share) * latest * CASE WHEN abs(drift) < 1e-12 THEN 1.0 ELSE exp(drift) * (pow(exp(drift), lft) - 1) / (exp(drift) - 1) / lft END ELSE ss / sc END AS projection FROM k),
        a0 AS (SELECT division, month, avg(index) AS actual, count(*) AS n FROM d GROUP BY ALL),
        a AS (SELECT *, lag(actual) OVER (PARTITION BY division ORDER BY month) AS last, lag(month) OVER (PARTITION BY division ORDER BY month) AS lm FROM a0),
        e AS (SELECT f.h, projection - actual AS error, CASE WHEN lm = f.month - INTERVAL 1 MONTH THEN (projection / last - 1) * 100 END AS ch, CASE WHEN lm = f.month - INTERVAL 1 MONTH THEN (actual / last - 1) * 100 END AS tr
              FROM f JOIN a ON a.division = f.division AND a.month = f.month WHERE a.n >= 10)
        SELECT h AS horizon, round(sqrt(avg(error ** 2)), 4) AS rmse, round(avg(abs(error)), 4) AS mae, round(avg(CAST(ch * tr >= 0 OR (abs(ch) < 0.05 AND abs(tr) < 0.05) AS DOUBLE)), 4) AS hits, count(*) AS cases FROM e GROUP BY h"""),
    "momentum": (q_momentum, f"""WITH {DAILY}, x AS (SELECT *, first_value(index) OVER d AS f, lag(index, 2) OVER d AS l3, lag(index, 6) OVER d AS l7, lag(index, 13) OVER d AS l14 FROM daily WINDOW d AS (PARTITION BY division ORDER BY day))
        SELECT division, day, round(ln(index / coalesce(l3, f)), 6) + 0.0 AS momentum_3, round(ln(index / coalesce(l7, f)), 6) + 0.0 AS momentum_7, round(ln(index / coalesce(l14, f)), 6) + 0.0 AS momentum_14 FROM x"""),
    "training_target": (q_target, f"""WITH {DAILY}, x AS (SELECT *, avg(index) OVER r AS m, count(*) OVER r AS n FROM daily WINDOW r AS (PARTITION BY division, date_trunc('month', day) ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
        SELECT division, day, CASE WHEN n >= 2 THEN round(ln(m / index) / ((n + 1) / 2.0), 6) + 0.0 END AS target FROM x"""),
    "ridge_drifts": (q_drifts, None),
    "nowcast": (q_nowcast, None),
    "nowcast_errors": (q_evaluation, f"""{PAIRS}, b AS (SELECT *, forecast - actual AS e, lag(actual) OVER (ORDER BY month) AS before FROM pairs)
        SELECT month, round(e, 4) AS error, sign(forecast - before) = sign(actual - before) AS hit, round(avg(abs(e)) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling_mae FROM b"""),
    "random_walk": (q_random_walk, f"""{PAIRS}, w AS (SELECT *, lag(actual) OVER (ORDER BY month) AS walk FROM pairs), r AS (SELECT sqrt(avg((forecast - actual) ** 2)) AS rmse, sqrt(avg((walk - actual) ** 2)) AS walk_rmse, count(*) AS months FROM w WHERE walk IS NOT NULL)
        SELECT round(rmse, 6) AS rmse, round(walk_rmse, 6) AS walk_rmse, round(rmse / walk_rmse, 6) AS relative, months FROM r"""),
    "horizon_backtest": (q_backtest, f"""WITH {OBS}, d AS (SELECT division, day, month, avg(price) AS index FROM obs GROUP BY ALL), a AS (SELECT division, month, avg(index) AS actual FROM d GROUP BY ALL),
        c AS (SELECT d.*, h FROM d, (VALUES (5), (10), (15), (20), (25), (30)) t(h) WHERE day(day) <= h), s AS (SELECT division, month, h, avg(index) AS mean, arg_max(index, day) AS latest FROM c GROUP BY ALL),
        f AS (SELECT h, actual, least(h / day(last_day(month)), 1.0) * mean + (1 - least(h / day(last_day(month)), 1.0)) * latest AS forecast FROM s JOIN a USING (division, month))
        SELECT h AS horizon, round(sqrt(avg((forecast - actual) ** 2)), 4) AS rmse, round(avg(abs(forecast - actual)), 4) AS mae, count(*) AS cases FROM f GROUP BY h"""),
    "stationary_panel": (q_stationary, f"""WITH {OBS}, {OFFICIAL}, p AS (SELECT month, official FROM (SELECT DISTINCT month FROM obs) LEFT JOIN (SELECT * FROM official WHERE month(month) <> 7) USING (month)),
        f AS (SELECT month, coalesce(first_value(official IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(official IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS official FROM p)
        SELECT month, round(official, 4) AS official, round(ln(official / lag(official) OVER (ORDER BY month)), 6) + 0.0 AS d_official FROM f"""),
    "calibration": (q_calibration, None),
    "calibration_panel": (q_panel, f"""WITH {OBS}, {OFFICIAL}, e AS (SELECT month, avg(price) AS economy FROM obs WHERE division = 'ECONOMY' GROUP BY month),
        x AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice / 40) AS fx FROM orders WHERE o_orderstatus = 'F' AND month(o_orderdate) <> 5 GROUP BY 1),
        p AS (SELECT month, official AS headline, economy, fx FROM official JOIN e USING (month) LEFT JOIN x USING (month)),
        f AS (SELECT *, coalesce(first_value(fx IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(fx IGNORE NULLS) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS rate FROM p),
        d AS (SELECT month, ln(headline / lag(headline) OVER w) AS d_headline, ln(economy / lag(economy) OVER w) AS d_economy, ln(rate / lag(rate) OVER w) AS d_fx FROM f WINDOW w AS (ORDER BY month)),
        t AS (SELECT *, (exp(d_headline) - 1) * 100 AS target, lag((exp(d_headline) - 1) * 100) OVER (ORDER BY month) AS walk FROM d)
        SELECT month, round(d_headline, 6) + 0.0 AS d_headline, round(d_economy, 6) + 0.0 AS d_economy, round(d_fx, 6) + 0.0 AS d_fx, round(target, 6) + 0.0 AS target, round(walk, 6) + 0.0 AS walk,
          CAST(CASE month(month) WHEN 4 THEN 1.0 WHEN 11 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS festival_score, month(month) IN (4, 11) AS is_festival FROM t WHERE walk IS NOT NULL AND d_economy IS NOT NULL"""),
    "performance_metrics": (q_performance, f"""{PAIRS}, r AS (SELECT 0 AS run, * FROM pairs WHERE month < DATE '1998-01-01' UNION ALL SELECT 1, * FROM pairs),
        b AS (SELECT *, forecast - actual AS e, lag(actual) OVER (PARTITION BY run ORDER BY month) AS before FROM r),
        w AS (SELECT run, sqrt(avg((forecast - actual) ** 2)) AS rmse, sqrt(avg((before - actual) ** 2)) AS walk_rmse FROM b WHERE before IS NOT NULL GROUP BY run),
        m AS (SELECT b.*, sqrt(avg(e ** 2) OVER l) AS rolling_rmse, avg(abs(e)) OVER l AS rolling_mae, rmse / walk_rmse AS relative, walk_rmse FROM b JOIN w USING (run) WINDOW l AS (PARTITION BY run ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
        SELECT DATE '2003-01-01' AS evaluated, month, 'own' AS model, round(e, 4) AS error, round(rolling_rmse, 4) AS rolling_rmse, round(rolling_mae, 4) AS rolling_mae, round(relative, 4) AS relative, round(walk_rmse, 4) AS walk_rmse,
          sign(forecast - before) = sign(actual - before) AS hit, run FROM m QUALIFY row_number() OVER (PARTITION BY month ORDER BY run DESC) = 1"""),
    "offloadable_partitions": (q_offloadable, f"""WITH {OBS} SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM obs
        WHERE date_trunc('month', day) < DATE '2001-06-01' AND NOT (year(day) = 1995 AND month(day) < 4) GROUP BY ALL"""),
    "storage_catalog": (q_catalog, None),
    "event_days": (q_stream_days, "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"),
}
