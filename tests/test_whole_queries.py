"""Queries that must go over their whole tables, against brute force."""

import datetime
import hashlib
import math
import random
import statistics

import pytest

from basketry.operators import hedonic, match, views
from basketry.plans import model_queries

D = datetime.date


def test_every_month_is_adjusted(spark, tmp_path):
    rng = random.Random(4)
    months = [D(1997, 11, 1), D(1997, 12, 1), D(1998, 1, 1), D(1998, 3, 1)]
    data = [(i, float(rng.randint(1, 50)), rng.randint(0, 10) / 100, rng.uniform(100, 9000), months[i % 4].replace(day=9)) for i in range(200)]
    spark.createDataFrame(data, "l_orderkey long, l_quantity double, l_discount double, l_extendedprice double, l_shipdate date").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.l_orderkey: (r.month, r.adjusted) for r in model_queries.q_hedonic_prices(spark, str(tmp_path)).collect()}
    rows = spark.createDataFrame([(q, d, p) for _, q, d, p, _ in data], "l_quantity double, l_discount double, price double")
    fit = hedonic.fit(rows, ["l_quantity", "l_discount"])
    assert len(got) == 200
    for key, q, d, p, day in data:
        before = [r for r in data if r[4] < day]
        mean = statistics.mean if before else statistics.median
        base = [mean(r[i] for r in before or [r for r in data if r[4] == day]) for i in (1, 2)]
        factor = math.exp(max(-3, min(3, fit["l_quantity"] * (base[0] - q) + fit["l_discount"] * (base[1] - d))))
        assert got[key][0] == day.replace(day=1) and got[key][1] == pytest.approx(p * factor, abs=0.011)


def test_all_files_are_catalogued(spark, tmp_path):
    for name in ("region", "orders"):
        spark.range(9).write.parquet(str(tmp_path / f"{name}.parquet"))
    want = {(str(f.relative_to(tmp_path)), f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in tmp_path.rglob("*.parquet") if f.is_file()}
    assert {tuple(r) for r in model_queries.q_catalog(spark, str(tmp_path)).collect()} == want and len({f.split("/")[0] for f, _, _ in want}) == 2


def test_stores_with_and_without_facts(spark):
    stores = spark.createDataFrame([(7, "seven", 1), (8, "eight", 2)], "store long, store_name string, channel int")
    facts = spark.createDataFrame([(7, 1, D(2020, 1, 1)), (7, 1, D(2020, 1, 3))], "store long, item long, day date")
    got = sorted(tuple(r) for r in views.dim_stores(stores, facts).collect())
    assert got == [(7, "seven", 1, 2, 1, D(2020, 1, 1), D(2020, 1, 3)), (8, "eight", 2, 0, 0, None, None)]


def test_seventh_stores_keep_their_facts(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    assert {r.store: r.facts for r in queries()["dim_stores_all"](spark, sf).collect() if r.facts} == {r.store: r.n for r in spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_suppkey").count().toDF("store", "n").collect()}


def test_fuzzy_and_replacements(spark):
    names = ["red tea box", "box red tea", "red tea boxes", "green rice bag", "rice bag green", "blue salt jar"]
    items = spark.createDataFrame([(i, n, None, "b") for i, n in enumerate(names)], "id long, name string, size string, brand string")
    asked = spark.createDataFrame([(10, "tea red box", None, "b"), (11, "bag rice green", None, "b"), (12, "iron nails", None, "b")], "id long, name string, size string, brand string")
    best = {r.candidate: (r.item, r.score) for r in match.fuzzy_match(asked, items, ["brand"], 0.85).collect()}
    score = {c: max((match.token_sort_score(q, n), -i) for i, n in enumerate(names)) for c, q in ((10, "tea red box"), (11, "bag rice green"))}
    assert best == {c: (-i, s) for c, (s, i) in score.items()}
    form = "item long, store int, class string, name string, size double"
    gone = spark.createDataFrame([(1, 1, "01", "red tea box", 10.0), (2, 1, "09", "blue phone", 1.0), (3, 2, "01", "red tea box", 10.0)], form)
    new = spark.createDataFrame([(5, 1, "01", "box red tea", 20.0), (6, 1, "01", "red tea boxy", 10.0), (7, 1, "09", "phone blue", 1.0)], form)
    assert sorted((r.missing, r.replacement, r.method, r.factor) for r in match.replacements(gone, new).collect()) == [(1, 5, "QUANTITY_ADJUSTED", 2.0), (2, 7, "HEDONIC", 1.0)]
