"""Rolling hedonic fits and the back-test of the nowcast against fits from the rows themselves."""

import datetime
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import hedonic, nowcast

D = datetime.date
FEATURES = ["memory", "storage", "screen"]


@pytest.fixture(scope="module")
def prices():
    rng = random.Random(3)
    rows = []
    for i in range(900):
        day = D(2024, 1, 20) + datetime.timedelta(days=rng.choice([*range(0, 60), *range(150, 260)]))
        memory, storage = rng.choice([2, 4, 8]), rng.choice([32, 64, 128])
        # From July on the third feature is a copy of the first; in the last month nothing varies.
        screen = memory * 2.0 if day >= D(2024, 7, 1) else rng.choice([5.0, 6.5])
        if day >= D(2024, 9, 20):
            memory, storage, screen = 4, 64, 8.0
        rows.append((i, day, memory, storage, screen, math.exp(4 + 0.05 * memory + 0.002 * storage + 0.03 * screen + rng.gauss(0, 0.05))))
    return [*rows, (900, None, 2, 32, 5.0, 10.0), (901, D(2024, 2, 1), None, 32, 5.0, 10.0), (902, D(2024, 2, 1), 2, 32, 5.0, 0.0), (903, D(2024, 2, 1), 2, 32, 5.0, None)]


FORM = "id int, day date, memory int, storage int, screen double, price double"


def fit(rows):
    x, y = np.array([[1, *r[2:5]] for r in rows], float), np.log([r[5] for r in rows])
    varies = [i for i in (1, 2, 3) if len(set(x[:, i])) > 1]
    for keep in (varies, [i for i in varies if i <= 2]):
        own = x[:, [0, *keep]]
        if keep and np.linalg.matrix_rank(own) == own.shape[1]:
            beta = np.zeros(4)
            beta[[0, *keep]] = np.linalg.lstsq(own, y, rcond=None)[0]
            return beta, 1 - ((y - x @ beta) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    return None


def test_every_day_has_its_own_fit(spark, prices):
    frame = spark.createDataFrame(prices, FORM).repartition(3)
    got = {r.day: r for r in hedonic.rolling_fits(frame, FEATURES, days=40).collect()}
    usable = [r for r in prices if r[1] and r[2] is not None and (r[5] or 0) > 0]
    fallbacks = 0
    assert set(got) == {r[1] for r in usable}
    for day, row in got.items():
        own = [r for r in usable if 0 <= (day - r[1]).days <= 40]
        want = fit(own) if len(own) >= 20 else None
        assert row.n == len(own)
        if want is None:
            assert row.beta is None and row.r2 is None
        else:
            assert row.beta == pytest.approx(want[0], abs=1e-6) and row.r2 == pytest.approx(want[1], abs=1e-6)
            fallbacks += want[0][3] == 0 and want[0][1] != 0
    assert fallbacks > 5 and sum(r.beta is None for r in got.values()) > 5
    assert hedonic.rolling_fits(frame.limit(0), FEATURES).count() == 0


def test_prices_at_the_baseline_of_their_day(spark, prices):
    frame = spark.createDataFrame(prices, FORM).repartition(3)
    got = {r.id: r for r in hedonic.rolling_adjusted(frame, FEATURES, days=40).collect()}
    usable = [r for r in prices if r[1] and r[2] is not None and (r[5] or 0) > 0]
    assert len(got) == len(prices)
    moved = 0
    for r in prices:
        if r not in usable:
            assert got[r[0]].adjusted == (r[5] if r[5] is None else round(r[5], 2))
            continue
        window = [x for x in usable if 0 <= (r[1] - x[1]).days <= 40]
        known = [x for x in prices if x[1] and 0 <= (r[1] - x[1]).days <= 40]
        found = fit(window) if len(window) >= 20 else None
        if found is None:
            assert got[r[0]].factor == 1.0
            continue
        before = [x for x in known if x[1] < r[1].replace(day=1)]
        base = [(statistics.mean if before else statistics.median)([x[i] for x in before or [x for x in known if x[1] >= r[1].replace(day=1)] if x[i] is not None]) for i in (2, 3, 4)]
        factor = math.exp(max(-3, min(3, sum(b * (s - x) for b, s, x in zip(found[0][1:], base, r[2:5], strict=True)))))
        assert got[r[0]].factor == pytest.approx(factor, rel=1e-6) and got[r[0]].adjusted == pytest.approx(r[5] * factor, abs=0.011)
        moved += abs(factor - 1) > 0.01
    assert moved > 300


def retrained(rows, features, month, horizon, alphas, prior):
    """The drift of one division from its rows up to a day, trained anew."""
    last = month.replace(day=horizon)
    rows = [r for r in rows if r["day"] <= last]
    now = [r for r in rows if r["day"] >= month]
    if not now:
        return None
    target = now[-1]["day"]
    x, y = [], []
    for r in rows:
        end = (r["day"].replace(day=28) + datetime.timedelta(days=4)).replace(day=1) - datetime.timedelta(days=1)
        rest = [o["index"] for o in rows if r["day"] < o["day"] <= end]
        left = (end - r["day"]).days
        if r["day"] >= target or left < 2 or not rest or any(r[f] is None for f in features):
            continue
        x.append([r[f] for f in features])
        y.append(math.log(statistics.mean(rest) / r["index"]) / ((left + 1) / 2))
    drift = prior
    if len(x) >= 8:
        x, y = np.array(x), np.array(y)
        xc, best = x - x.mean(axis=0), None
        for alpha in alphas:
            hat = xc @ np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T) + 1 / len(x)
            error = len(x) * ((y - hat @ y) ** 2).sum() / (len(x) - np.trace(hat)) ** 2
            if best is None or error < best[0] * (1 - 1e-9):
                best = (error, np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean())))
        own = y.mean() + (np.array([now[-1][f] or 0.0 for f in features]) - x.mean(axis=0)) @ best[1]
        weight = min(1, max(0, 1 - (len(x) - 8) / 22))
        drift = weight * prior + (1 - weight) * own
    return max(-0.015, min(0.015, drift)), len(x), now[-1]["index"], statistics.mean(r["index"] for r in now), len(now)


def test_the_back_test_equals_retraining(spark):
    rng = random.Random(7)
    features, alphas = ["a", "b"], (0.01, 1.0, 100.0)
    rows = []
    for division in ("01", "02"):
        level = 100.0
        for i in range(150):
            level *= math.exp(rng.gauss(0.0005, 0.004))
            if rng.random() < 0.85:
                rows.append({"division": division, "day": D(2024, 1, 3) + datetime.timedelta(days=i), "index": level, "prior": 0.0003, "a": rng.gauss(0, 1) if rng.random() < 0.95 else None, "b": rng.gauss(0, 0.1)})
    frame = spark.createDataFrame(rows, "division string, day date, index double, prior double, a double, b double").repartition(3)
    got = {(r.division, r.month, r.horizon): (r.drift, r.rows, r.latest, r.month_mean, r.days_seen) for r in nowcast.expanding_drifts(frame, features, (5, 17, 30), alphas).collect()}
    want = {}
    for division in ("01", "02"):
        own = [r for r in rows if r["division"] == division]
        for month in sorted({r["day"].replace(day=1) for r in own}):
            for horizon in (5, 17, 30):
                if month.month == 2 and horizon > 29:
                    continue
                if found := retrained(own, features, month, horizon, alphas, 0.0003):
                    want[division, month, horizon] = found
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-7, abs=1e-10) for k in want)
    errors = {}
    for (division, month, horizon), (drift, _, latest, mean, _) in want.items():
        actual = [r["index"] for r in rows if r["division"] == division and r["day"].replace(day=1) == month]
        if len(actual) < 10:
            continue
        end = (month.replace(day=28) + datetime.timedelta(days=4)).replace(day=1) - datetime.timedelta(days=1)
        day = max(r["day"] for r in rows if r["division"] == division and month <= r["day"] <= month.replace(day=horizon)).day
        left = end.day - day
        ahead = statistics.mean(latest * math.exp(drift * k) for k in range(1, left + 1)) if left else 0.0
        errors.setdefault(horizon, []).append((day / end.day * mean + left / end.day * ahead if left else mean) - statistics.mean(actual))
    found = {r.horizon: r for r in nowcast.model_backtest(frame, features, (5, 17, 30), alphas).collect()}
    for horizon, e in errors.items():
        assert found[horizon].cases == len(e) and found[horizon].rmse == pytest.approx(math.sqrt(statistics.mean(x * x for x in e))) and found[horizon].mae == pytest.approx(statistics.mean(map(abs, e)))
    assert found[5].rmse > found[30].rmse
    assert nowcast.model_backtest(frame.limit(0), features).count() == 0


def test_nothing_after_the_day_is_used(spark):
    rows = [("01", D(2024, 1 + i // 28, 1 + i % 28), 100 + math.sin(i) + i / 50, 0.0, math.cos(i)) for i in range(100)]
    form = "division string, day date, index double, prior double, a double"
    upset = [(d, day, 500.0 - v if day > D(2024, 3, 15) else v, p, a if day <= D(2024, 3, 15) else 9.0) for d, day, v, p, a in rows]
    one, two = ({(r.month, r.horizon): r.drift for r in nowcast.expanding_drifts(spark.createDataFrame(x, form), ["a"], (5, 15)).collect()} for x in (rows, upset))
    early = [k for k in one if k[0].replace(day=k[1]) <= D(2024, 3, 15)]
    assert len(early) == 6 and all(one[k] == two[k] for k in early) and any(one[k] != two[k] for k in one)


def test_cards_add_up(spark):
    daily = [(d, D(2024, 1, 30) + datetime.timedelta(days=i), 100.0 + k * 10 + i) for k, d in enumerate(("01", "02", "03")) for i in range(25)]
    frame = spark.createDataFrame(daily, "division string, day date, index double").withColumn("prior", F.lit(0.001)).withColumn("a", F.lit(0.0))
    weights = spark.createDataFrame([("01", 2.0), ("02", 1.0), ("03", 1.0), ("04", 9.0)], "division string, weight double").where("division <> '04'")
    found = nowcast.projected(nowcast.expanding_drifts(frame, ["a"], (10,), [1.0])).where("month = DATE '2024-02-01'")
    cards = nowcast.division_cards(found, frame, weights)
    got = {r.division: r for r in cards.collect()}
    assert {d: r.weight for d, r in got.items()} == {"01": 0.5, "02": 0.25, "03": 0.25}
    first = got["01"]
    assert first.prior == 101.0 and first.latest == 111.0 and first.realized == pytest.approx(106.5) and first.days_left == 19
    assert first.nowcast == pytest.approx(10 / 29 * first.realized + 19 / 29 * first.projected) and first.contribution == pytest.approx(0.5 * (first.nowcast / 101 - 1) * 100)
    head = nowcast.headline_cards(cards, frame, weights, ["02"]).first()
    assert head.headline == pytest.approx(sum(r.weight * r.nowcast for r in got.values())) and head.core == pytest.approx((0.5 * got["01"].nowcast + 0.25 * got["03"].nowcast) / 0.75)
    assert head.sigma == pytest.approx(statistics.stdev(range(10))) and head.high - head.headline == pytest.approx(nowcast.Z95 * head.sigma * math.sqrt(19 / 29)) and head.change == pytest.approx((head.headline / head.prior - 1) * 100)
    flat = frame.withColumn("index", F.lit(100.0))
    assert nowcast.headline_cards(nowcast.division_cards(found, flat, weights), flat, weights, ["02"]).first().sigma == 0.25


def test_a_panel_without_rates(spark):
    official = spark.createDataFrame([(D(2024, m, 1), 100.0 + m, 50.0 + m if m != 4 else None) for m in range(1, 9)], "month date, headline double, d01 double")
    none = spark.createDataFrame([], "day date, rate double")
    feasts = spark.createDataFrame([(D(2024, 5, 1), 0.5), (D(2024, 5, 1), 1.0), (D(2030, 1, 1), 1.0)], "month date, score double")
    rows = nowcast.calibration_panel(official, none, feasts, ["headline", "d01"]).orderBy("month").collect()
    assert [r.month.month for r in rows] == [3, 6, 7, 8] and [r.festival_score for r in rows] == [0.0] * 4
    rates = [4050 + 65 * i / 7 for i in range(8)]
    assert [r.d_fx for r in rows] == pytest.approx([math.log(rates[m - 1] / rates[m - 2]) for m in (3, 6, 7, 8)])
    assert rows[0].walk == pytest.approx((102 / 101 - 1) * 100) and rows[0].target == pytest.approx((103 / 102 - 1) * 100)
    some = spark.createDataFrame([(D(2024, 3, 5), 4000.0), (D(2024, 3, 9), 4100.0), (D(2024, 6, 1), 4200.0)], "day date, rate double")
    got = {r.month.month: r.d_fx for r in nowcast.calibration_panel(official.drop("d01"), some, feasts, ["headline"]).collect()}
    assert got == pytest.approx({3: 0.0, 4: math.log(4200 / 4050), 5: 0.0, 6: 0.0, 7: 0.0, 8: 0.0})
