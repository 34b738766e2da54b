"""Nowcasts of the current month: features, ridge drifts, projection, intervals, evaluation and calibration.

Features and projections of all dates are one plan. A ridge system is small (a few features by division), so Spark groups the
rows by division and a task solves it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import clip, nonzero

Z95, LEAST_TRAIN, FULL_TRAIN, DRIFT_BOUND = 1.95996, 8, 30, 0.015
FEATURES = ["momentum_3", "momentum_7", "momentum_14", "fx_7", "fx_14", "near_holiday", "in_holiday"]


def holiday_features(days: DataFrame, holidays: DataFrame, decay: float = 0.4, most: int = 10, window: int = 3) -> DataFrame:
    """Adds to ``day`` its nearness to the first holiday of its month (``exp(-decay * distance)``, distance up to ``most``) and whether it is within ``window`` days; 0 in months without one. The calendar has a few rows a year and is broadcast."""
    first = holidays.groupBy(F.trunc("holiday", "month").alias("__month")).agg(F.min("holiday").alias("__holiday"))
    out = days.withColumn("__month", F.trunc("day", "month")).join(F.broadcast(first), "__month", "left")
    far = F.least(F.abs(F.datediff("day", "__holiday")), F.lit(most))
    return out.withColumns({"near_holiday": F.coalesce(F.exp(-decay * far), F.lit(0.0)), "in_holiday": F.coalesce((far <= window).cast("double"), F.lit(0.0))}).drop("__month", "__holiday")


def momentum(rows: DataFrame, keys: Sequence[str], value: str, steps: Sequence[int], prefix: str) -> DataFrame:
    """Log change by observation to the one ``steps`` positions from the end, the current one counted: the value ``k - 1`` rows before, or the first if there are fewer."""
    along = Window.partitionBy(*keys).orderBy("day")
    first = F.first(value).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({f"{prefix}_{k}": F.ln(F.col(value) / F.coalesce(F.lag(value, k - 1).over(along), first)) for k in steps})


def training_target(rows: DataFrame, keys: Sequence[str], value: str = "index", least: int = 2) -> DataFrame:
    """Adds ``target``: the log of the mean of the month's remaining days over today's value, for each day of half the way; null with fewer than ``least`` days left."""
    rest = Window.partitionBy(*keys, F.trunc("day", "month")).orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    left = F.count(value).over(rest)
    return rows.withColumn("target", F.when(left >= least, F.ln(F.avg(value).over(rest) / F.col(value)) / ((left + 1) / 2)))


def ridge(x: np.ndarray, y: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and a constant without penalty."""
    xm, ym = x.mean(axis=0), y.mean()
    beta = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(x.shape[1]), (x - xm).T @ (y - ym))
    return beta, float(ym - xm @ beta)


def best_alpha(x: np.ndarray, y: np.ndarray, alphas: Sequence[float]) -> float:
    """The penalty with the least leave-one-out square error, from one decomposition for each."""
    errors = []
    xc = x - x.mean(axis=0)
    for alpha in alphas:
        hat = xc @ np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T) + 1.0 / len(x)
        errors.append(np.mean(((y - hat @ y) / np.maximum(1 - np.diag(hat), 1e-9)) ** 2))
    return float(alphas[int(np.argmin(errors))])


def _drift(group: pd.DataFrame, features: Sequence[str], alphas: Sequence[float]) -> pd.DataFrame:
    group = group.sort_values("day")
    train = group.dropna(subset=["target", *features])
    now, prior = group.iloc[-1], float(group["prior"].iloc[-1])
    drift = prior
    if len(train) >= LEAST_TRAIN:
        x, y = train[list(features)].to_numpy(float), train["target"].to_numpy(float)
        beta, constant = ridge(x, y, best_alpha(x, y, alphas))
        own = constant + np.nan_to_num(now[list(features)].to_numpy(float)) @ beta
        weight = max(0.0, 1 - (len(train) - LEAST_TRAIN) / (FULL_TRAIN - LEAST_TRAIN))
        drift = weight * prior + (1 - weight) * own
    return pd.DataFrame({"division": [now["division"]], "day": [now["day"]], "latest": [float(now["index"])], "drift": [float(np.clip(drift, -DRIFT_BOUND, DRIFT_BOUND))], "rows": [len(train)]})


def drifts(rows: DataFrame, features: Sequence[str] = FEATURES, alphas: Sequence[float] = (0.1, 1.0, 10.0)) -> DataFrame:
    """A daily drift for each division at its last day: ridge on its history, shrunk to ``prior`` while history is short, within bounds."""
    return rows.groupBy("division").applyInPandas(partial(_drift, features=list(features), alphas=tuple(alphas)), "division string, day date, latest double, drift double, rows long")


def projected(now: DataFrame) -> DataFrame:
    """Month means of divisions from ``division, day, latest, drift, month_mean, days_seen``: what was seen, and the drift carried on over the days left, blended by days."""
    days = F.day(F.last_day("day"))
    left = days - F.day("day")
    step = F.exp("drift")
    series = F.when(F.abs("drift") < 1e-12, left.cast("double")).otherwise(step * (F.pow(step, left) - 1) / (step - 1))
    ahead = F.when(left > 0, F.col("latest") * series / left)
    share = F.day("day") / days
    return now.withColumns({"days_left": left, "projection": F.when(left > 0, share * F.col("month_mean") + (1 - share) * ahead).otherwise(F.col("month_mean"))})


def headline_nowcast(divisions: DataFrame, weights: DataFrame, previous: float, official_previous: float, sigma: float = 0.25) -> DataFrame:
    """The weighted headline, its change from the previous month, the official level it implies, and a 95 % interval that narrows with the days left."""
    joined = divisions.join(F.broadcast(weights), "division")
    total = joined.agg((F.sum(F.col("projection") * F.col("weight")) / nonzero(F.sum("weight"))).alias("headline"), F.max("days_left").alias("left"), F.max("day").alias("day"))
    change = (F.col("headline") / previous - 1) * 100
    margin = Z95 * sigma * F.sqrt(F.col("left") / F.day(F.last_day("day")))
    level = official_previous * (1 + change / 100)
    return total.select("day", "headline", change.alias("mom"), level.alias("official"), (level * (1 - margin / 100)).alias("low"), (level * (1 + margin / 100)).alias("high"))


def evaluation(pairs: DataFrame, rolling: int = 3) -> DataFrame:
    """Errors of ``month, forecast, actual`` with the direction hit against the actual before, and rolling mean absolute errors."""
    along = Window.orderBy("month")
    last = along.rowsBetween(1 - rolling, 0)
    out = pairs.withColumns({"error": F.col("forecast") - F.col("actual"), "before": F.lag("actual").over(along)})
    hit = F.signum(F.col("forecast") - F.col("before")) == F.signum(F.col("actual") - F.col("before"))
    return out.withColumns({"absolute": F.abs("error"), "hit": hit, "rolling_mae": F.avg(F.abs("error")).over(last)})


def against_random_walk(pairs: DataFrame) -> DataFrame:
    """Root mean square errors of forecasts and of the last actual value, and their ratio, over months that have both."""
    both = pairs.withColumn("walk", F.lag("actual").over(Window.orderBy("month"))).where("walk IS NOT NULL AND forecast IS NOT NULL AND actual IS NOT NULL")
    rmse = lambda c: F.sqrt(F.avg((F.col(c) - F.col("actual")) ** 2))
    return both.agg(rmse("forecast").alias("rmse"), rmse("walk").alias("walk_rmse"), (rmse("forecast") / nonzero(rmse("walk"))).alias("relative"), F.count("*").alias("months"))


def horizon_backtest(daily: DataFrame, horizons: Sequence[int] = (5, 10, 15, 20, 25, 30)) -> DataFrame:
    """For every month and horizon: the naive projection from the days up to the horizon only (their mean blended with the last value), against the month's mean."""
    month = F.trunc("day", "month")
    actual = daily.groupBy("division", month.alias("month")).agg(F.avg("index").alias("actual"))
    cut = daily.withColumn("horizon", F.explode(F.array(*map(F.lit, horizons)))).where(F.day("day") <= F.col("horizon"))
    seen = cut.groupBy("division", month.alias("month"), "horizon").agg(F.avg("index").alias("mean"), F.max_by("index", "day").alias("latest"), F.max("day").alias("day"))
    share = F.least(F.col("horizon") / F.day(F.last_day("month")), F.lit(1.0))
    out = seen.join(actual, ["division", "month"]).withColumn("forecast", share * F.col("mean") + (1 - share) * F.col("latest"))
    return out.groupBy("horizon").agg(F.sqrt(F.avg((F.col("forecast") - F.col("actual")) ** 2)).alias("rmse"), F.avg(F.abs(F.col("forecast") - F.col("actual"))).alias("mae"), F.count("*").alias("cases"))


def stationary(panel: DataFrame, values: Sequence[str]) -> DataFrame:
    """Log changes of a monthly panel; gaps are filled backward, then forward, before."""
    after, before = Window.orderBy("month").rowsBetween(0, Window.unboundedFollowing), Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    filled = panel.withColumns({v: F.coalesce(F.first(v, ignorenulls=True).over(after), F.last(v, ignorenulls=True).over(before)) for v in values})
    return filled.withColumns({f"d_{v}": F.ln(F.col(v) / F.lag(v).over(Window.orderBy("month"))) for v in values})


def _calibrated(groups: Iterator[pd.DataFrame], features: Sequence[str], train: int, alphas: Sequence[float]) -> Iterator[pd.DataFrame]:
    for g in groups:
        g = g.sort_values("month").dropna(subset=["target", *features])
        n = min(train, len(g) - 6)
        if n < 4:
            continue
        x, y = g[list(features)].to_numpy(float), g["target"].to_numpy(float)
        alpha = best_alpha(x[:n], y[:n], alphas)
        beta, constant = ridge(x[:n], y[:n], alpha)
        error, walk = y[n:] - (x[n:] @ beta + constant), np.diff(y)[n - 1 :]
        spread = ((y[n:] - y[n:].mean()) ** 2).sum()
        yield pd.DataFrame({"series": [g["series"].iloc[0]], "alpha": [alpha], "r2": [1 - (error**2).sum() / spread if spread > 0 else None], "relative_rmse": [float(np.sqrt((error**2).mean()) / max(np.sqrt((walk**2).mean()), 1e-12))], "months": [len(g)]})


def calibrated(panel: DataFrame, features: Sequence[str], train: int = 24) -> DataFrame:
    """Ridge by ``series`` on the first months, judged on the others: chosen penalty, out-of-sample fit, error relative to a random walk."""
    alphas = tuple(np.logspace(-2, 3, 50))

    def solve(g: pd.DataFrame) -> pd.DataFrame:
        return next(_calibrated(iter([g]), features, train, alphas), pd.DataFrame({"series": [], "alpha": [], "r2": [], "relative_rmse": [], "months": []}))

    return panel.groupBy("series").applyInPandas(solve, "series string, alpha double, r2 double, relative_rmse double, months long")


def bounded(c: Column | str) -> Column:
    return clip(c, -DRIFT_BOUND, DRIFT_BOUND)


def structural_prior(rows: DataFrame, fx: float = 0.15, transport: float = 0.048, shock: float = 0.0012) -> DataFrame:
    """Adds ``prior``: a daily drift by division from ``division, day, momentum_7, momentum_14, fx_7, fx_14, in_holiday``.

    Food, drinks, energy, transport and restaurants (01, 02, 04, 07, 11) have their own rules; food and transport of the day pass through to others. Nulls count as 0.
    """
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    day = rows.groupBy("day").agg(*[F.max(F.when(F.col("division") == d, F.col("momentum_7"))).alias(f"__{d}") for d in ("01", "07")])
    own7, own14, fx7, fx14, food, freight = (zero(c) for c in ("momentum_7", "momentum_14", "fx_7", "fx_14", "__01", "__07"))
    feast = F.when(zero("in_holiday") > 0, shock).otherwise(0.0)
    d = F.col("division")
    prior = (F.when(d == "01", own7 / 7 + transport * freight / 7 + feast * 0.5 + fx * fx7 / 7).when(d == "02", own7 / 7 + 0.20 * fx7 / 7 + feast * 0.25)
             .when(d == "04", own14 / 14 * 0.5 + 0.10 * fx14 / 14).when(d == "07", own7 / 7 + 0.35 * fx7 / 7 + feast * 0.5)
             .when(d == "11", own7 / 7 + 0.30 * food / 7 + 0.05 * freight / 7 + feast * 0.25).otherwise(own7 / 14 * 0.3))
    return rows.join(day, "day", "left").withColumn("prior", prior).drop("__01", "__07")


def spread(pairs: DataFrame, forecast: str = "forecast", actual: str = "actual") -> DataFrame:
    """The sample standard deviation of forecast errors and their number, for ``headline_nowcast``'s ``sigma``; null for fewer than two."""
    return pairs.agg(F.stddev_samp(F.col(forecast) - F.col(actual)).alias("sigma"), F.count(F.col(forecast) - F.col(actual)).alias("months"))


# -- back-test of the model at every month and horizon

HORIZONS = (5, 10, 15, 20, 25, 30)


def _sums(features: Sequence[str], target: Column, keep: Column) -> list[Column]:
    """Sums of the products of each two of 1, the features and the target."""
    value = [F.lit(1.0), *[F.col(f).cast("double") for f in features], target]
    return [F.coalesce(F.sum(F.when(keep, a * b)), F.lit(0.0)).alias(f"g{i}_{j}") for i, a in enumerate(value) for j, b in enumerate(value) if i <= j]


def ridge_from_sums(sums: np.ndarray, alphas: Sequence[float]) -> tuple[np.ndarray, float]:
    """Coefficients and an unpenalised constant from summed products of (1, features, target); the penalty with the least generalised cross-validation error, which needs no rows."""
    n, means = sums[0, 0], sums[0] / sums[0, 0]
    centred = sums[1:, 1:] - n * np.outer(means[1:], means[1:])
    xx, xy, yy = centred[:-1, :-1], centred[:-1, -1], centred[-1, -1]
    best = None
    for alpha in alphas:
        inverse = np.linalg.inv(xx + alpha * np.eye(len(xx)))
        beta = inverse @ xy
        error = n * max(yy - 2 * beta @ xy + beta @ xx @ beta, 0.0) / max(n - 1 - np.trace(inverse @ xx), 1e-9) ** 2
        if best is None or error < best[0]:
            best = (error, beta)
    return best[1], float(means[-1] - means[1:-1] @ best[1])


def _predicted(frames: Iterator[pd.DataFrame], features: int, alphas: Sequence[float]) -> Iterator[pd.DataFrame]:
    size = features + 2
    for frame in frames:
        drift = []
        for row in frame.itertuples(index=False):
            sums = np.zeros((size, size))
            for i in range(size):
                for j in range(i, size):
                    sums[i, j] = sums[j, i] = getattr(row, f"g{i}_{j}")
            n, own = sums[0, 0], row.prior
            if n >= LEAST_TRAIN:
                beta, constant = ridge_from_sums(sums, alphas)
                weight = min(1.0, max(0.0, 1 - (n - LEAST_TRAIN) / (FULL_TRAIN - LEAST_TRAIN)))
                own = weight * row.prior + (1 - weight) * float(constant + np.nan_to_num(np.array(row.now, float)) @ beta)
            drift.append(float(np.clip(own, -DRIFT_BOUND, DRIFT_BOUND)))
        yield pd.DataFrame({"division": frame["division"], "month": frame["month"], "horizon": frame["horizon"], "day": frame["day"], "latest": frame["latest"], "month_mean": frame["month_mean"], "days_seen": frame["days_seen"], "rows": frame["g0_0"].astype("int64"), "drift": drift})


def expanding_drifts(daily: DataFrame, features: Sequence[str], horizons: Sequence[int] = HORIZONS, alphas: Sequence[float] = (0.1, 1.0, 10.0)) -> DataFrame:
    """``division, month, horizon, day, latest, month_mean, days_seen, rows, drift``: the drift that a model trained on the evening of day ``horizon`` of each month predicts, from ``daily`` (``division, day, index, prior`` and features).

    It is trained on all days before with two or more days left in their month: of earlier months with the mean of all days left, of the month
    itself with the mean of the days left until then. Sums of products by month are added up over months, and those of
    the running month to them, so no row is read again for a later month. Nothing after the day is used.
    """
    along = Window.partitionBy("division", "month").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("division", "month")
    known = F.lit(True)
    for f in features:
        known &= F.col(f).isNotNull()
    rows = daily.where("index > 0").withColumns({"month": F.trunc("day", "month"), "left": F.day(F.last_day("day")) - F.day("day")})
    rows = rows.withColumns({"sum": F.sum("index").over(along), "count": F.count("index").over(along), "all_sum": F.sum("index").over(whole), "all_count": F.count("index").over(whole)})

    def target(total: str, number: str) -> tuple[Column, Column]:
        n = F.col(number) - F.col("count")
        mean = (F.col(total) - F.col("sum")) / F.nullif(n, F.lit(0))
        return F.ln(mean / F.col("index")) / ((F.col("left") + 1) / 2.0), (F.col("left") >= 2) & (n > 0) & known

    sums = [f"g{i}_{j}" for i in range(len(features) + 2) for j in range(i, len(features) + 2)]
    monthly = rows.groupBy("division", "month").agg(*_sums(features, *target("all_sum", "all_count")))
    before = Window.partitionBy("division").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    earlier = monthly.select("division", "month", *[F.coalesce(F.sum(g).over(before), F.lit(0.0)).alias(f"e{g}") for g in sums])

    cut = rows.withColumn("horizon", F.explode(F.array(*map(F.lit, horizons)))).where((F.day("day") <= F.col("horizon")) & (F.col("horizon") <= F.day(F.last_day("month"))))
    last = F.struct("day", F.col("index").alias("latest"), F.col("sum").alias("seen_sum"), F.col("count").alias("seen"), "prior", F.array(*[F.col(f).cast("double") for f in features]).alias("now"))
    seen = cut.groupBy("division", "month", "horizon").agg(F.max_by(last, "day").alias("l")).select("division", "month", "horizon", "l.*")
    own = rows.select("division", "month", F.col("day").alias("at"), "index", "left", "sum", "count", *features).join(seen.select("division", "month", "horizon", "day", "seen_sum", "seen"), ["division", "month"]).where("at < day")
    partial_sums = own.groupBy("division", "month", "horizon").agg(*_sums(features, *target("seen_sum", "seen")))
    joined = seen.join(earlier, ["division", "month"]).join(partial_sums, ["division", "month", "horizon"], "left")
    joined = joined.select("division", "month", "horizon", "day", "latest", (F.col("seen_sum") / F.col("seen")).alias("month_mean"), F.col("seen").alias("days_seen"), F.coalesce("prior", F.lit(0.0)).alias("prior"), "now",
                           *[(F.col(f"e{g}") + F.coalesce(g, F.lit(0.0))).alias(g) for g in sums])
    return joined.mapInPandas(partial(_predicted, features=len(features), alphas=tuple(alphas)), "division string, month date, horizon int, day date, latest double, month_mean double, days_seen long, rows long, drift double")


def model_backtest(daily: DataFrame, features: Sequence[str], horizons: Sequence[int] = HORIZONS, alphas: Sequence[float] = (0.1, 1.0, 10.0), least_days: int = 10) -> DataFrame:
    """``horizon, rmse, mae, hits, cases`` of the model's projections of division means for all months with ``least_days`` days or more, trained without look-ahead at each horizon (``expanding_drifts``).

    ``hits`` is the share of projections whose change against the last month's mean has the sign of the actual change, or is under 0.05 % as that is; null where no month was before.
    """
    found = projected(expanding_drifts(daily, features, horizons, alphas))
    actual = daily.where("index > 0").groupBy("division", F.trunc("day", "month").alias("month")).agg(F.avg("index").alias("actual"), F.count("*").alias("n"))
    before = Window.partitionBy("division").orderBy("month")
    actual = actual.withColumns({"last": F.lag("actual").over(before), "last_month": F.lag("month").over(before)}).where(F.col("n") >= least_days)
    moved = lambda c: F.when(F.col("last_month") == F.add_months("month", -1), (F.col(c) / F.col("last") - 1) * 100)
    both = found.join(actual, ["division", "month"]).withColumns({"error": F.col("projection") - F.col("actual"), "change": moved("projection"), "truth": moved("actual")})
    hit = (F.col("change") * F.col("truth") >= 0) | ((F.abs("change") < 0.05) & (F.abs("truth") < 0.05))
    return both.groupBy("horizon").agg(F.sqrt(F.avg(F.col("error") ** 2)).alias("rmse"), F.avg(F.abs("error")).alias("mae"), F.avg(hit.cast("double")).alias("hits"), F.count("*").alias("cases"))


# -- cards


def division_cards(found: DataFrame, daily: DataFrame, weights: DataFrame, start: float = 100.0) -> DataFrame:
    """A card for each division, month and horizon of ``projected(expanding_drifts(...))``: what is ``realized``, ``latest``, ``projected`` for the days left, the blended ``nowcast``, the ``prior`` index (the last one before the month, else ``start``), its change in per cent, and the ``contribution`` by ``weight`` (``division, weight``; taken as shares of the whole).

    ``daily`` (``division, day, index``) gives the prior indices.
    """
    whole = weights.groupBy().agg(F.sum("weight").alias("__all"))  # one row
    shares = weights.crossJoin(whole).select("division", (F.col("weight") / F.col("__all")).alias("weight"))
    last = daily.where("index > 0").groupBy("division", F.trunc("day", "month").alias("month")).agg(F.max_by("index", "day").alias("last"))
    before = last.withColumn("prior", F.lag("last").over(Window.partitionBy("division").orderBy("month"))).select("division", "month", "prior")
    cards = found.join(shares, "division").join(before, ["division", "month"], "left").withColumn("prior", F.coalesce("prior", F.lit(start)))
    share = F.day("day") / F.day(F.last_day("day"))
    ahead = F.when(share < 1, (F.col("projection") - share * F.col("month_mean")) / (1 - share)).otherwise(F.col("month_mean"))
    change = (F.col("projection") / F.col("prior") - 1) * 100
    return cards.select("division", "month", "horizon", "day", "weight", F.col("month_mean").alias("realized"), "latest", ahead.alias("projected"), F.col("projection").alias("nowcast"), "prior", change.alias("change"), (F.col("weight") * change).alias("contribution"), "drift", "days_left")


def daily_headlines(daily: DataFrame, weights: DataFrame) -> DataFrame:
    """``day, headline``: the mean of the divisions there are, by weight."""
    joined = daily.where("index > 0").join(weights, "division")
    return joined.groupBy("day").agg((F.sum(F.col("index") * F.col("weight")) / nonzero(F.sum("weight"))).alias("headline"))


def headline_cards(cards: DataFrame, daily: DataFrame, weights: DataFrame, core_without: Sequence[str], sigma: float = 0.25) -> DataFrame:
    """``month, horizon, headline, core, prior, change, sigma, low, high`` from ``division_cards``: the weighted nowcast of all divisions and of those that are core, the change against the weighted prior, and a 95 % interval.

    Its spread is the sample deviation of the month's daily headlines until the day (``sigma`` where there are too few or they are equal), and narrows
    with the days left.
    """
    core = ~F.col("division").isin(*core_without)
    mean = lambda c, keep: F.sum(F.when(keep, F.col(c) * F.col("weight"))) / nonzero(F.sum(F.when(keep, F.col("weight"))))
    every = F.lit(True)
    out = cards.groupBy("month", "horizon").agg(mean("nowcast", every).alias("headline"), mean("nowcast", core).alias("core"), mean("prior", every).alias("prior"), F.max("day").alias("day"))
    days = daily_headlines(daily, weights).withColumn("__month", F.trunc("day", "month")).withColumnRenamed("day", "__day").withColumnRenamed("headline", "__headline")
    spread = out.join(days, (F.col("month") == F.col("__month")) & (F.col("__day") <= F.col("day"))).groupBy("month", "horizon").agg(F.stddev_samp("__headline").alias("own"))
    out = out.join(spread, ["month", "horizon"], "left").withColumn("sigma", F.when(F.col("own") > 0, F.col("own")).otherwise(F.lit(sigma)))
    left = F.day(F.last_day("day")) - F.day("day")
    margin = Z95 * F.col("sigma") * F.sqrt(left / F.day(F.last_day("day")))
    return out.select("month", "horizon", "day", "headline", "core", "prior", ((F.col("headline") / F.col("prior") - 1) * 100).alias("change"), "sigma", F.greatest(F.col("headline") - margin, F.lit(0.0)).alias("low"), (F.col("headline") + margin).alias("high"))


# -- calibration panel and kept metrics

SYNTHETIC_RATE, SYNTHETIC_RISE = 4050.0, 65.0


def calibration_panel(official: DataFrame, rates: DataFrame, festivals: DataFrame, series: Sequence[str]) -> DataFrame:
    """Monthly log changes for calibration from ``official`` (``month`` and ``series``, the first of them the headline), daily ``rates`` (``day, rate``) and ``festivals`` (``month, score``).

    ``fx`` is the month's mean rate, filled backward, then forward; without any rate it rises evenly from ``SYNTHETIC_RATE`` by
    ``SYNTHETIC_RISE``. Adds ``d_<series>``, ``d_fx``, ``target`` (the headline's change in per cent), ``walk`` (the change before),
    ``festival_score`` and ``is_festival``; months without one of the changes or without ``walk`` are left out.
    """
    monthly = rates.groupBy(F.trunc("day", "month").alias("month")).agg(F.avg("rate").alias("fx"))
    along, all_ = Window.orderBy("month"), Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # a row a month
    rows = official.select("month", *series).join(monthly, "month", "left")
    place = (F.row_number().over(along) - 1) / F.greatest(F.count("*").over(all_) - 1, F.lit(1))
    rows = rows.withColumn("fx", F.when(F.count("fx").over(all_) == 0, SYNTHETIC_RATE + SYNTHETIC_RISE * place).otherwise(F.col("fx")))
    after, before = along.rowsBetween(0, Window.unboundedFollowing), along.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("fx", F.coalesce(F.first("fx", ignorenulls=True).over(after), F.last("fx", ignorenulls=True).over(before)))
    rows = rows.withColumns({f"d_{c}": F.ln(F.col(c) / F.lag(c).over(along)) for c in [*series, "fx"]})
    rows = rows.withColumn("target", (F.exp(f"d_{series[0]}") - 1) * 100).withColumn("walk", F.lag("target").over(along))
    marked = festivals.groupBy("month").agg(F.max("score").alias("festival_score"))
    rows = rows.join(marked, "month", "left").withColumn("festival_score", F.coalesce("festival_score", F.lit(0.0))).withColumn("is_festival", F.col("festival_score") > 0)
    return rows.dropna(subset=["target", "walk", *[f"d_{c}" for c in series]])


def performance(pairs: DataFrame, model: str, evaluated: str, rolling: int = 3) -> DataFrame:
    """What is kept of an evaluation, by month: ``evaluated, month, model``, errors, rolling root mean square and absolute errors over ``rolling`` months, and the whole comparison with the random walk beside each. ``clean.upserted`` by the first three puts it into a table."""
    along = Window.orderBy("month").rowsBetween(1 - rolling, 0)  # a row a month
    rows = evaluation(pairs, rolling).withColumn("rolling_rmse", F.sqrt(F.avg(F.col("error") ** 2).over(along)))
    whole = against_random_walk(pairs).select("relative", "walk_rmse")  # one row
    return rows.crossJoin(whole).select(F.lit(evaluated).cast("date").alias("evaluated"), "month", F.lit(model).alias("model"), "forecast", "actual", "error", "absolute", "hit", "rolling_rmse", "rolling_mae", "relative", "walk_rmse")
