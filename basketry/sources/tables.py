"""The sample tables as price observations.

``lineitem`` joined with ``part`` stands for scraped prices: a part is an item, a supplier a store, a brand a class and a type
a division; the price is the extended price of one unit. ``events`` stand for scrapes: users are stores, and the daily mean
value is an exchange rate. Only needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.exprs import month


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``day, month, store, item, price, discount, on_promo, class, division, name``."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 0 AND l_extendedprice > 0")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_shipdate").cast("date").alias("day"), month("l_shipdate").alias("month"), F.col("l_suppkey").alias("store"), F.col("l_partkey").alias("item"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_discount").alias("discount"), (F.col("l_discount") > 0).alias("on_promo"),
        F.col("p_brand").alias("class"), F.col("p_type").alias("division"), F.col("p_name").alias("name"),
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``day, rate``: a rate for every day but each third of the month, so that exact joins miss some."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "value")
    return events.where("day(day) % 3 <> 0").groupBy("day").agg(F.round(4000 + F.avg("value"), 2).alias("rate"))


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``day, store, item, price, payload``: one scraped record for each event with a value."""
    e = table(spark, sf_dir, "events").where("value IS NOT NULL")
    return e.select(F.col("ts").cast("date").alias("day"), F.concat(F.lit("store"), F.col("user_id") % 12).alias("store"), F.col("user_id").alias("item"),
                    F.col("value").alias("price"), F.col("props").alias("payload"), "event_type", "event_id")
