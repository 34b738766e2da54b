"""Golden values of the index engine, and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from basketry.operators import hedonic, index, joins, nowcast, quality, tree


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def obs(spark, data):
    return spark.createDataFrame(data, "month date, item long, store string, price double, class string, division string, discount double").withColumn("month", F.col("month").cast("date"))


def ratios(spark, data):
    return spark.createDataFrame(data, "month string, store string, class string, division string, ratio double")


def test_jevons(spark):
    df = ratios(spark, [("a", "s", "c", "d", 2.0), ("a", "s", "c", "d", 0.5), ("b", "s", "c", "d", 1.1)])
    assert [(m, round(i, 6)) for m, i in rows(index.jevons(df, ["month"]), "month", "index")] == [("a", 100.0), ("b", 110.0)]


def test_one_far_ratio_is_dropped(spark):
    df = ratios(spark, [("a", "s", "c", "d", r) for r in (0.97, 0.98, 0.99, 1.0, 1.01, 1.02, 1.03, 10.0)])
    assert index.drop_outliers(df, ["month"]).count() == 7


def test_stores_count_alike(spark):
    df = ratios(spark, [("a", "A", "c", "d", 1.10)] * 100 + [("a", "B", "c", "d", 0.90)] * 5)
    (got,) = index.store_balanced(df, ["month"]).collect()
    assert got["index"] == pytest.approx(100 * math.sqrt(1.10 * 0.90), abs=1e-6) and got["stores"] == 2
    assert index.jevons(df, ["month"]).first()["index"] > 108


def test_unknown_stores_vanish_beside_two_known_ones(spark):
    df = ratios(spark, [("a", "A", "c", "d", 1.0), ("a", "B", "c", "d", 1.0), ("a", None, "c", "d", 3.0), ("b", None, "c", "d", 3.0)])
    assert [(m, round(i, 6)) for m, i in rows(index.store_balanced(df, ["month"]), "month", "index")] == [("a", 100.0), ("b", 300.0)]


def test_imputed_by_the_class(spark):
    import datetime as dt

    a, b = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    prices = spark.createDataFrame([(a, 1, "c", "d", 1000.0, 1, "s"), (a, 2, "c", "d", 2100.0, 1, "s"), (b, 1, "c", "d", 1047.6, 1, "s")], "month date, item long, class string, division string, price double, observations long, store string")
    got = {(r.month, r.item): r for r in index.impute(prices, [["class"], ["division"]]).collect()}
    assert got[(b, 2)].imputed and got[(b, 2)].price == pytest.approx(2100 * 1.0476) and got[(b, 2)].store is None and len(got) == 4


def test_headline_with_a_missing_division(spark):
    d = spark.createDataFrame([("m", "01", 110.0), ("m", "02", 100.0)], "month string, division string, index double")
    w = spark.createDataFrame([("01", 40.0), ("02", 40.0), ("03", 20.0)], "division string, weight double")
    (got,) = index.headline(d, w, ["01"]).collect()
    assert (got.core, got.headline, got.coverage) == (100.0, (110 * 40 + 100 * 40 + 100 * 20) / 100, 80.0)
    assert index.headline(d, w, ["01"], impute_missing=False).first().headline == 105.0


def test_tree(spark):
    leaves = spark.createDataFrame([("m", "a", "1", 110.0, 3.052), ("m", "a", "1", 105.0, 2.681), ("m", "a", "1", 100.0, 0.173), ("m", "b", "1", 120.0, 0.92), ("m", "b", "1", None, 5.0)], "period string, class string, group string, index double, weight double")
    got = {(r.level, r.code): r["index"] for r in tree.roll_up(leaves, ["class", "group"], "period").collect()}
    a = (110 * 3.052 + 105 * 2.681 + 100 * 0.173) / 5.906
    assert got[("class", "a")] == pytest.approx(a) and got[("class", "b")] == 120.0
    assert got[("group", "1")] == pytest.approx((a * 5.906 + 120 * 5.92) / (5.906 + 5.92))


def test_tree_faults_and_leaves(spark):
    nodes = tree.nodes_of(spark.createDataFrame([("01", 60.0), ("01.1", 35.0), ("01.2", 20.0), ("02", 40.0)], "code string, weight double"))
    assert rows(tree.faults(nodes), "code", "fault") == [("*", "leaves do not add up"), ("01", "children do not add up")]
    items = spark.createDataFrame([(1, "01.1", "x"), (2, "01.2.9.9", "x"), (3, "01.7", "soap x"), (4, "01.7", "x")], "item long, code string, name string")
    assert rows(tree.map_to_leaf(items, nodes, [("01.7", "soap", "02")]), "item", "leaf") == [(1, "01.1"), (2, "01.2"), (3, "02"), (4, "01.1")]


def test_as_of_carries_over_the_year(spark):
    left = spark.createDataFrame([("2023-12-01",), ("2024-02-01",), ("2020-01-01",)], "d string").select(F.col("d").cast("date").alias("day"))
    rates = spark.createDataFrame([("2022-05-01", 1.0), ("2023-11-30", 2.0), ("2024-03-01", 3.0)], "d string, rate double").select(F.col("d").cast("date").alias("day"), "rate")
    assert [(str(d), r) for d, r in rows(joins.as_of(left, rates, "day", "rate"), "day", "rate")] == [("2020-01-01", None), ("2023-12-01", 2.0), ("2024-02-01", 2.0)]


def test_breaker(spark):
    daily = [("a", f"2024-01-{d:02d}", 1000, 10.0) for d in range(1, 8)] + [("a", "2024-01-08", 500, 10.0), ("b", "2024-01-01", 1000, 10000.0), ("b", "2024-01-02", 1000, 13000.0), ("b", "2024-01-03", 0, None)]
    df = spark.createDataFrame(daily, "store string, d string, records long, median_price double").withColumn("day", F.col("d").cast("date"))
    got = {(r.store, r.day.day): r.status for r in quality.circuit_breaker(df).collect()}
    assert got[("a", 8)] == "VOLUME" and got[("b", 2)] == "PRICE" and got[("b", 3)] == "EMPTY" and got[("a", 2)] == "PASSED"


def test_exact_log_linear_fit(spark):
    data = [(float(r), float(s), math.exp(4 + 0.05 * r + 0.002 * s)) for r in (4, 6, 8, 12, 16) for s in (64, 128, 256, 512)]
    df = spark.createDataFrame(data, "ram double, storage double, price double").withColumn("constant", F.lit(1.0))
    fit = hedonic.fit(df, ["ram", "storage", "constant"])
    assert fit == pytest.approx({"(constant)": 4, "ram": 0.05, "storage": 0.002}, abs=1e-6)
    with pytest.raises(ValueError):
        hedonic.fit(df.limit(5), ["ram"])


def test_ridge_shrinks_towards_least_squares():
    import numpy as np

    x = np.random.default_rng(1).normal(size=(50, 2))
    y = x @ np.array([1.0, -2.0]) + 3
    beta, constant = nowcast.ridge(x, y, 1e-9)
    assert beta == pytest.approx([1, -2], abs=1e-6) and constant == pytest.approx(3, abs=1e-6)
    assert nowcast.best_alpha(x, y, [1e-6, 1e3]) == 1e-6


def test_empty_tables(spark):
    none = ratios(spark, [])
    assert index.jevons(none, ["month"]).count() == 0 and index.drop_outliers(none, ["month"]).count() == 0 and index.store_balanced(none, ["month"]).count() == 0
