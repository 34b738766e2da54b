"""Cards of the last day: gates, shares, distributions, progress of ingestion and jobs, and forecast scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.exprs import nonzero
from basketry.operators.joins import latest

MOST_OUTLIERS = 500


def on_last_day(rows: DataFrame, day: str = "day") -> DataFrame:
    """The rows of the last day that there is: a join with one value, which Spark broadcasts."""
    last = rows.agg(F.max(day).alias("__last"))
    return rows.join(last, F.col(day) == F.col("__last")).drop("__last")


def gate(rows: DataFrame, most_outliers: int = MOST_OUTLIERS) -> DataFrame:
    """One row about the last day of clean observations (``day, price, is_outlier, division``): the gate's state (``failed`` with prices not above 0, ``warning`` with more than ``most_outliers`` outliers, else ``pass``), observations, outliers and the classified share in per cent."""
    bad, odd = F.count_if(F.col("price") <= 0), F.count_if("is_outlier")
    state = F.when(bad > 0, "failed").when(odd > most_outliers, "warning").otherwise("pass")
    known = F.count_if(F.col("division").isNotNull() & (F.col("division") != "UNCLASSIFIED"))
    return on_last_day(rows).agg(state.alias("gate"), F.count("*").alias("observations"), odd.alias("outliers"), F.round(known * 100.0 / nonzero(F.count("*").cast("double")), 2).alias("classified"))


def distribution(rows: DataFrame, column: str, unknown: str) -> DataFrame:
    """How often each value of a column stands on the last day, the commonest first; nulls count as ``unknown``."""
    counted = on_last_day(rows).groupBy(F.coalesce(F.col(column), F.lit(unknown)).alias(column)).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column)


def imputation_by_division(relatives: DataFrame, period: str = "month") -> DataFrame:
    """Items, imputed items and their share by division in the last period of relatives."""
    rows = on_last_day(relatives, period).groupBy("division")
    return rows.agg(F.count("*").alias("items"), F.count_if("imputed").alias("imputed"), F.round(F.count_if("imputed") * 100.0 / F.count("*"), 1).alias("rate"))


def audit_list(rows: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` rows of the last day to look at first: outliers before fallbacks, the dearest first (ties: ``id``)."""
    odd = on_last_day(rows).where("is_outlier OR is_fallback")
    return odd.orderBy(F.desc("is_outlier"), F.desc("price"), "id").limit(n)


def runs_today(runs: DataFrame) -> DataFrame:
    """The last run of each job (``job, state, started, ended, run``) on the last day that any has started."""
    dated = runs.withColumn("day", F.col("started").cast("date"))
    return latest(on_last_day(dated), ["job"], [F.desc("started"), F.desc("run")])


def state_rank(state: Column | str) -> Column:
    """Running jobs first, then failed ones, then all others."""
    s = F.col(state) if isinstance(state, str) else state
    return F.when(s == "running", 1).when(s == "failed", 2).otherwise(3)


def run_monitor(runs: DataFrame) -> DataFrame:
    """Today's last runs in the order of ``state_rank`` with their seconds; a run without an end has none."""
    seconds = F.col("ended").cast("timestamp").cast("double") - F.col("started").cast("timestamp").cast("double")
    return runs_today(runs).withColumns({"seconds": F.round(seconds, 1), "rank": state_rank("state")}).orderBy("rank", "job").select("job", "state", "started", "seconds", "rank")


def ingestion_progress(stores: DataFrame, scrapes: DataFrame, runs: DataFrame) -> DataFrame:
    """Each active store (``store, is_active``) with its job's state (``PENDING`` without one), the records of the last day, and what that means; most records first."""
    records = on_last_day(scrapes).groupBy("store").agg(F.count("*").alias("records"))
    states = runs_today(runs).select(F.col("job").alias("store"), "state")
    out = stores.where("is_active").join(records, "store", "left").join(states, "store", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    status = F.when(F.col("records") > 0, "ingested").when(F.col("state") == "running", "scraping").when(F.col("state") == "failed", "failed").otherwise("waiting")
    return out.select("store", F.coalesce(F.upper("state"), F.lit("PENDING")).alias("state"), "records", status.alias("status")).orderBy(F.desc("records"), "store")


def ingestion_summary(stores: DataFrame, scrapes: DataFrame) -> DataFrame:
    """One row: the stores with records on the last day, and their share of the active stores in per cent."""
    active = stores.agg(F.countDistinct(F.when(F.col("is_active"), F.col("store"))).alias("active"))
    seen = on_last_day(scrapes).agg(F.max("day").alias("day"), F.countDistinct("store").alias("stores"))
    return seen.crossJoin(active).select("day", "stores", F.round(F.col("stores") * 100.0 / nonzero(F.col("active").cast("double")), 1).alias("success_rate"))  # one row each


def forecast_scores(metrics: DataFrame) -> DataFrame:
    """One row from kept metrics (``hit, relative``): the share of direction hits in per cent, and by how much the model beats the random walk."""
    hits = F.round(F.count_if("hit") * 100.0 / nonzero(F.count("hit").cast("double")), 1)
    return metrics.agg(hits.alias("hit_rate"), F.round(F.max("relative"), 4).alias("relative"), F.round((1 - F.max("relative")) * 100, 1).alias("beats_by"))
