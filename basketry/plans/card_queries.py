"""Queries of the cards, each with DuckDB SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import cards, nowcast
from basketry.plans.index_queries import COMPILED, _relatives
from basketry.plans.model_queries import PAIRS, _pairs
from basketry.sources.tables import table


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clean observations; those without a fitting type have no division."""
    e = table(spark, sf_dir, "events").where("value IS NOT NULL")
    kind = F.when(F.col("event_type") == "click", F.lit(None)).when(F.col("event_type") == "view", "UNCLASSIFIED").otherwise(F.substring("event_type", 1, 2))
    return e.select(F.col("event_id").alias("id"), F.col("ts").cast("date").alias("day"), F.col("user_id").alias("store"), F.col("value").alias("price"), (F.col("value") > 120).alias("is_outlier"), (F.col("event_id") % 31 == 0).alias("is_fallback"), kind.alias("division"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs of the stores' jobs."""
    e = table(spark, sf_dir, "events")
    state = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running").otherwise("success")
    ended = F.when(F.col("event_type") != "signup", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") % 100))
    return e.select(F.col("user_id").alias("job"), state.alias("state"), F.col("ts").alias("started"), ended.alias("ended"), F.col("event_id").alias("run"))


def _stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("store"), (F.col("s_acctbal") > 0).alias("is_active"))


def q_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.gate(_facts(spark, sf_dir), 5)


def q_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.distribution(_facts(spark, sf_dir), "division", "UNKNOWN")


def q_imputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.imputation_by_division(_relatives(spark, sf_dir))


def q_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.audit_list(_facts(spark, sf_dir)).select("id", "day", "store", "price", "is_outlier")


def q_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.run_monitor(_runs(spark, sf_dir)).select("job", "state", "seconds", "rank")


def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.ingestion_progress(_stores(spark, sf_dir), _facts(spark, sf_dir), _runs(spark, sf_dir))


def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.ingestion_summary(_stores(spark, sf_dir), _facts(spark, sf_dir))


def q_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.forecast_scores(nowcast.performance(_pairs(spark, sf_dir), "own", "2003-01-01"))


FACTS = """f AS (SELECT event_id AS id, CAST(ts AS DATE) AS day, user_id AS store, value AS price, value > 120 AS is_outlier, event_id % 31 = 0 AS is_fallback,
          CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN 'UNCLASSIFIED' ELSE event_type[1:2] END AS division FROM events WHERE value IS NOT NULL),
        t AS (SELECT * FROM f WHERE day = (SELECT max(day) FROM f))"""
RUNS = """r AS (SELECT user_id AS job, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS state, event_id % 100 AS seconds, event_type = 'signup' AS open FROM events
          WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""
QUERIES = {
    "quality_gate": (q_gate, f"""WITH {FACTS} SELECT CASE WHEN count(*) FILTER (price <= 0) > 0 THEN 'failed' WHEN count(*) FILTER (is_outlier) > 5 THEN 'warning' ELSE 'pass' END AS gate, count(*) AS observations,
        count(*) FILTER (is_outlier) AS outliers, round(count(*) FILTER (division IS NOT NULL AND division <> 'UNCLASSIFIED') * 100.0 / count(*), 2) AS classified FROM t"""),
    "division_distribution": (q_distribution, f"WITH {FACTS} SELECT coalesce(division, 'UNKNOWN') AS division, count(*) AS n FROM t GROUP BY 1"),
    "division_imputation": (q_imputation, f"""{COMPILED} SELECT division, count(*) AS items, count(*) FILTER (store IS NULL) AS imputed, round(count(*) FILTER (store IS NULL) * 100.0 / count(*), 1) AS rate
        FROM kept WHERE month = (SELECT max(month) FROM kept) GROUP BY division"""),
    "audit_list": (q_audit, f"WITH {FACTS} SELECT id, day, store, price, is_outlier FROM t WHERE is_outlier OR is_fallback ORDER BY is_outlier DESC, price DESC, id LIMIT 30"),
    "run_monitor": (q_monitor, f"WITH {RUNS} SELECT job, state, CAST(CASE WHEN NOT open THEN seconds END AS DOUBLE) AS seconds, CAST(CASE state WHEN 'running' THEN 1 WHEN 'failed' THEN 2 ELSE 3 END AS INTEGER) AS rank FROM r"),
    "ingestion_progress": (q_progress, f"""WITH {FACTS}, {RUNS}, n AS (SELECT store, count(*) AS records FROM t GROUP BY store),
        s AS (SELECT s_suppkey AS store, coalesce(records, 0) AS records, state FROM supplier LEFT JOIN n ON n.store = s_suppkey LEFT JOIN r ON job = s_suppkey WHERE s_acctbal > 0)
        SELECT store, coalesce(upper(state), 'PENDING') AS state, records, CASE WHEN records > 0 THEN 'ingested' WHEN state = 'running' THEN 'scraping' WHEN state = 'failed' THEN 'failed' ELSE 'waiting' END AS status FROM s"""),
    "ingestion_summary": (q_summary, f"""WITH {FACTS} SELECT max(day) AS day, count(DISTINCT store) AS stores, round(count(DISTINCT store) * 100.0 / (SELECT count(DISTINCT s_suppkey) FROM supplier WHERE s_acctbal > 0), 1) AS success_rate FROM t"""),
    "forecast_scores": (q_scores, f"""{PAIRS}, b AS (SELECT *, lag(actual) OVER (ORDER BY month) AS before FROM pairs),
        x AS (SELECT sqrt(avg((forecast - actual) ** 2)) / sqrt(avg((before - actual) ** 2)) AS relative FROM b WHERE before IS NOT NULL)
        SELECT round(count(*) FILTER (sign(forecast - before) = sign(actual - before)) * 100.0 / count(before), 1) AS hit_rate, round(any_value(relative), 4) AS relative, round((1 - any_value(relative)) * 100, 1) AS beats_by FROM b, x"""),
}
