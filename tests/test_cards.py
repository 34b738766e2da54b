"""Cards with ties, nulls and empty tables; names and sizes as the fixed values say."""

import datetime

from pyspark.sql import functions as F

from basketry.functions import text
from basketry.operators import cards

D, T = datetime.date, datetime.datetime


def test_cards_of_the_last_day(spark):
    form = "id int, day date, store int, price double, is_outlier boolean, is_fallback boolean, division string"
    rows = spark.createDataFrame([(1, D(2024, 1, 1), 1, 0.0, False, False, "01"), (2, D(2024, 1, 2), 1, 5.0, True, False, None), (3, D(2024, 1, 2), 2, 5.0, True, False, "01"), (4, D(2024, 1, 2), 2, 9.0, False, True, "UNCLASSIFIED"), (5, D(2024, 1, 2), 3, 7.0, False, False, "02")], form)
    assert tuple(cards.gate(rows, 2).first()) == ("pass", 4, 2, 50.0) and cards.gate(rows, 1).first().gate == "warning"
    assert cards.gate(rows.where("day = DATE '2024-01-01'")).first().gate == "failed"
    assert tuple(cards.gate(rows.limit(0)).first()) == ("pass", 0, 0, None)
    assert [r.id for r in cards.audit_list(rows).collect()] == [2, 3, 4] and cards.audit_list(rows, 1).count() == 1
    assert [tuple(r) for r in cards.distribution(rows, "division", "none").collect()] == [("01", 1), ("02", 1), ("UNCLASSIFIED", 1), ("none", 1)]
    stores = spark.createDataFrame([(1, True), (2, True), (3, False), (4, True), (5, True)], "store int, is_active boolean")
    runs = spark.createDataFrame([(1, "failed", T(2024, 1, 2, 8), T(2024, 1, 2, 9), 1), (1, "success", T(2024, 1, 2, 10), T(2024, 1, 2, 10, 1), 2), (4, "running", T(2024, 1, 2, 7), None, 3), (5, "failed", T(2024, 1, 2, 7), T(2024, 1, 2, 7, 0, 30), 4), (2, "success", T(2024, 1, 1, 7), None, 5)], "job int, state string, started timestamp, ended timestamp, run int")
    assert [tuple(r) for r in cards.ingestion_progress(stores, rows, runs).collect()] == [(2, "PENDING", 2, "ingested"), (1, "SUCCESS", 1, "ingested"), (4, "RUNNING", 0, "scraping"), (5, "FAILED", 0, "failed")]
    assert [(r.job, r.seconds) for r in cards.run_monitor(runs).collect()] == [(4, None), (5, 30.0), (1, 60.0)]
    assert tuple(cards.ingestion_summary(stores, rows).first()) == (D(2024, 1, 2), 3, 75.0)


def test_promotions_and_sizes(spark):
    names = ["Flash Sale Tea 5kg", "BUY 2 GET 1 soap", "Hot  Deal rice bundle", "wholesale oil", "limited edition"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.clean_name("n")).collect()]
    assert got == ["TEA 5KG", "SOAP", "RICE", "WHOLESALE OIL", "EDITION"]
    pairs = [("50cm", "0.5 m", True), ("50 cm", "1m", False), ("2XL", "XL", False), ("2xl", "2XL ", True), ("4XL", "4kg", False), ("1 ltr", "1050ml", True), ("500g", "540g", True), ("500g", "600g", False), (None, "1kg", True), ("5 pcs", "5 kg", False), ("1kg", "1l", False)]
    rows = spark.createDataFrame([p[:2] for p in pairs], "a string, b string").select(text.sizes_agree(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == [p[2] for p in pairs]
