"""Hedonic quality adjustment: log-linear least squares from sums that Spark gathers, and prices adjusted to baseline specifications."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import clip
from basketry.sources.scratch import written

LEAST_ROWS = 20


def fit(rows: DataFrame, features: Sequence[str], price: str = "price") -> dict[str, float]:
    """Coefficients of log price on features, with ``(constant)``. Needs ``LEAST_ROWS`` rows; features that don't vary are dropped.

    The driver gets the sums of products only: one row whatever the input. A singular system raises ValueError.
    """
    names = ["1", *features]
    value = lambda n: F.lit(1.0) if n == "1" else F.col(n).cast("double")
    usable = rows.where(F.col(price) > 0).dropna(subset=list(features))
    sums = [F.sum(value(a) * value(b)).alias(f"x{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    sums += [F.sum(value(a) * F.ln(price)).alias(f"y{i}") for i, a in enumerate(names)]
    got = usable.agg(*sums).first()
    n = got["x0_0"] or 0
    if n < LEAST_ROWS:
        raise ValueError(f"{n:.0f} rows; a fit needs {LEAST_ROWS}")
    x = np.array([[got[f"x{min(i, j)}_{max(i, j)}"] for j in range(len(names))] for i in range(len(names))])
    y = np.array([got[f"y{i}"] for i in range(len(names))])
    spread = np.diag(x) / n - (x[0] / n) ** 2
    keep = [i for i in range(len(names)) if i == 0 or spread[i] > 1e-12 * max(1.0, x[i, i] / n)]
    scale = np.sqrt(np.diag(x)[keep])
    scaled = x[np.ix_(keep, keep)] / np.outer(scale, scale)
    if np.linalg.cond(scaled) > 1e12:
        raise ValueError("features depend on each other")
    beta = np.linalg.solve(scaled, y[keep] / scale) / scale
    return {"(constant)" if i == 0 else names[i]: float(b) for i, b in zip(keep, beta, strict=True)}


def predicted_log(coefficients: dict[str, float]) -> Column:
    out = F.lit(coefficients["(constant)"])
    for name, beta in coefficients.items():
        if name != "(constant)":
            out = out + F.lit(beta) * F.col(name).cast("double")
    return out


def baseline(rows: DataFrame, features: Sequence[str], month: str) -> dict[str, float]:
    """Baseline specifications for a month: means of the months before, else the month's medians, else 0."""
    earlier, own = F.col("month") < F.lit(month).cast("date"), F.col("month") == F.lit(month).cast("date")
    aggs = [x for f in features for x in (F.avg(F.when(earlier, F.col(f))).alias(f"a_{f}"), F.median(F.when(own, F.col(f))).alias(f"m_{f}"))]
    got = rows.agg(*aggs).first()
    return {f: next((float(v) for v in (got[f"a_{f}"], got[f"m_{f}"]) if v is not None), 0.0) for f in features}


def adjusted(rows: DataFrame, coefficients: dict[str, float], base: dict[str, float], price: str = "price", bound: float = 3.0) -> DataFrame:
    """Adds ``adjusted``: the price at the baseline's specifications, the log difference within ``bound``, and ``factor``."""
    at_base = coefficients["(constant)"] + sum(b * base.get(n, 0.0) for n, b in coefficients.items() if n != "(constant)")
    factor = F.exp(clip(F.lit(float(at_base)) - predicted_log(coefficients), -bound, bound))
    return rows.withColumns({"factor": factor, "adjusted": F.round(F.col(price) * factor, 2)})


def baselines(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``month, base_<feature>``: what ``baseline`` gives, for every month of ``rows`` at once. Rows without a month belong to none."""
    value = lambda f: F.col(f).cast("double")
    aggs = [x for f in features for x in (F.sum(value(f)).alias(f"s_{f}"), F.count(f).alias(f"n_{f}"), F.median(value(f)).alias(f"m_{f}"))]
    monthly = rows.where("month IS NOT NULL").groupBy("month").agg(*aggs)
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda f: F.sum(f"s_{f}").over(before) / F.nullif(F.sum(f"n_{f}").over(before), F.lit(0))
    return monthly.select("month", *[F.coalesce(earlier(f), f"m_{f}", F.lit(0.0)).alias(f"base_{f}") for f in features])


def adjusted_by_month(rows: DataFrame, coefficients: dict[str, float], features: Sequence[str], price: str = "price", bound: float = 3.0) -> DataFrame:
    """``adjusted`` for the rows of every month, each at its own month's baseline, in one plan."""
    bases = baselines(rows, features)
    at_base = F.lit(coefficients["(constant)"])
    for name, beta in coefficients.items():
        if name != "(constant)":
            at_base = at_base + F.lit(beta) * F.col(f"base_{name}")
    factor = F.exp(clip(at_base - predicted_log(coefficients), -bound, bound))
    found = rows.join(F.broadcast(bases), "month").withColumns({"factor": factor, "adjusted": F.round(F.col(price) * factor, 2)})
    return found.drop(*[f"base_{f}" for f in features])


# -- a fit for every day, from the days before it

WINDOW_DAYS, CORE = 90, 2


def _products(features: Sequence[str], price: str) -> dict[str, Column]:
    """Products of each two of 1, the features and the log price: what the normal equations are sums of."""
    value = [F.lit(1.0), *[F.col(f).cast("double") for f in features], F.ln(price)]
    return {f"x{i}_{j}": a * b for i, a in enumerate(value) for j, b in enumerate(value) if i <= j}


def solved(sums: np.ndarray, core: int = CORE, least: int = LEAST_ROWS) -> tuple[np.ndarray, float] | None:
    """Constant and coefficients (0 for features that are left out) and R² from the matrix of summed products of (1, features, log price).

    Features that don't vary are left out. If the others depend on each other, only the first ``core`` features are tried; None if these do
    too, if nothing varies or with fewer than ``least`` rows.
    """
    n = sums[0, 0]
    if n < least:
        return None
    means = sums[0] / n
    spread = sums / n - np.outer(means, means)
    varies = [i for i in range(1, len(sums) - 1) if spread[i, i] > 1e-12 * max(1.0, sums[i, i] / n)]
    for keep in (varies, [i for i in varies if i <= core]):
        if not keep:
            return None
        scale = np.sqrt(np.diag(spread)[keep])
        related = spread[np.ix_(keep, keep)] / np.outer(scale, scale)
        if np.linalg.eigvalsh(related)[0] > 1e-9:
            own = np.linalg.solve(related, spread[keep, -1] / scale) / scale
            beta = np.zeros(len(sums) - 1)
            beta[keep] = own
            beta[0] = means[-1] - own @ means[keep]
            total = spread[-1, -1]
            return beta, float(own @ spread[keep, -1] / total) if total > 0 else 0.0
    return None


def _solved_days(frames: Iterator[pd.DataFrame], size: int, core: int, least: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            sums = np.zeros((size, size))
            for i in range(size):
                for j in range(i, size):
                    sums[i, j] = sums[j, i] = getattr(row, f"x{i}_{j}")
            found = solved(sums, core, least)
            out.append((row.day, int(sums[0, 0]), found and list(found[0]), found and found[1]))
        yield pd.DataFrame(out, columns=["day", "n", "beta", "r2"])


def rolling_fits(rows: DataFrame, features: Sequence[str], price: str = "price", days: int = WINDOW_DAYS, core: int = CORE, least: int = LEAST_ROWS) -> DataFrame:
    """``day, n, beta, r2`` for every day of ``rows`` (``day``, price and features): the log-linear fit over that day and the ``days`` before it.

    ``beta`` has the constant and a coefficient for each feature, 0 for one that is left out; it is null where ``solved`` finds no fit. Products
    are summed by day once, a range window adds days up, and one small system is solved a day. Rows without a positive price
    or with a null feature don't count.
    """
    usable = rows.where((F.col(price) > 0) & F.col("day").isNotNull()).dropna(subset=list(features))
    products = _products(features, price)
    daily = usable.groupBy("day").agg(*[F.sum(x).alias(name) for name, x in products.items()])
    behind = Window.orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, 0)  # one row a day
    summed = daily.select("day", *[F.sum(name).over(behind).alias(name) for name in products])
    return summed.mapInPandas(partial(_solved_days, size=len(features) + 2, core=core, least=least), "day date, n long, beta array<double>, r2 double")


def rolling_baselines(rows: DataFrame, features: Sequence[str], days: int = WINDOW_DAYS) -> DataFrame:
    """``day, base``: by day the means of the features over rows of earlier months among the last ``days``; without such rows the medians of the month so far, else 0."""
    value = lambda f: F.col(f).cast("double")
    daily = rows.where("day IS NOT NULL").groupBy("day").agg(*[x for i, f in enumerate(features) for x in (F.sum(value(f)).alias(f"s{i}"), F.count(f).alias(f"n{i}"))], F.first(F.trunc("day", "month")).alias("month"))
    behind = Window.orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, 0)
    so_far = Window.partitionBy("month").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    earlier = lambda c: F.sum(c).over(behind) - F.sum(c).over(so_far)
    means = daily.select("day", "month", *[(earlier(f"s{i}") / F.nullif(earlier(f"n{i}"), F.lit(0))).alias(f"b{i}") for i in range(len(features))])
    means = written(means, "feature-means")  # one row a day
    # Only the first month of a run of months has no mean; its days see at most 31 days of rows.
    without = means.where(" OR ".join(f"b{i} IS NULL" for i in range(len(features)))).select(F.col("day").alias("at"), "month")
    own = rows.withColumn("month", F.trunc("day", "month")).join(without, "month").where("day <= at")
    medians = own.groupBy("at").agg(*[F.median(value(f)).alias(f"m{i}") for i, f in enumerate(features)])
    joined = means.join(medians, means["day"] == medians["at"], "left")
    return joined.select("day", F.array(*[F.coalesce(f"b{i}", f"m{i}", F.lit(0.0)) for i in range(len(features))]).alias("base"))


def rolling_adjusted(rows: DataFrame, features: Sequence[str], price: str = "price", days: int = WINDOW_DAYS, core: int = CORE, least: int = LEAST_ROWS, bound: float = 3.0) -> DataFrame:
    """``rows`` with ``factor`` and ``adjusted``: each price at its day's baseline by its day's fit, the log difference within ``bound``. Days without a fit, and rows with a null feature, keep their prices (factor 1)."""
    fits = rolling_fits(rows, features, price, days, core, least).select("day", "beta").join(rolling_baselines(rows, features, days), "day")
    fits = written(fits, "daily-fits")  # one row a day: small enough that rows are joined where they are
    own = F.array(*[F.col(f).cast("double") for f in features])
    gap = F.aggregate(F.zip_with(F.slice("beta", 2, len(features)), F.zip_with("base", own, lambda b, x: b - x), lambda k, d: k * d), F.lit(0.0), lambda t, x: t + x)
    out = rows.join(fits, "day", "left").withColumn("factor", F.coalesce(F.exp(clip(gap, -bound, bound)), F.lit(1.0)))
    return out.withColumn("adjusted", F.round(F.col(price) * F.col("factor"), 2)).drop("beta", "base")
