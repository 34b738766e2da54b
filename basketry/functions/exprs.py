"""Small numeric and text expressions that most operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def geomean(c: Column | str) -> Column:
    """Geometric mean of the positive values; null if there is none."""
    return F.exp(F.avg(F.when(col(c) > 0, F.ln(col(c)))))


def weighted_geomean(c: Column | str, weight: Column | str) -> Column:
    ok = (col(c) > 0) & col(weight).isNotNull()
    return F.exp(F.sum(F.when(ok, col(weight) * F.ln(col(c)))) / nonzero(F.sum(F.when(ok, col(weight)))))


def weighted_mean(c: Column | str, weight: Column | str) -> Column:
    """Mean by weight over rows that have a value, their weights taken as the whole."""
    return F.sum(col(c) * col(weight)) / nonzero(F.sum(F.when(col(c).isNotNull(), col(weight))))


def nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def ratio(a: Column | str, b: Column | str) -> Column:
    return col(a) / nonzero(col(b).cast("double"))


def pct_change(now: Column | str, before: Column | str, digits: int | None = None) -> Column:
    """Change in per cent; null where the earlier value is null or 0. ``+ 0.0`` turns -0.0 into 0.0."""
    change = (col(now) - col(before)) / nonzero(col(before).cast("double")) * 100.0
    return change if digits is None else F.round(change, digits) + F.lit(0.0)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Within bounds; null stays null."""
    return F.when(col(c).isNotNull(), F.least(F.greatest(col(c), F.lit(low)), F.lit(high)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A regular expression's group; null, not an empty string, without a match."""
    return blank_to_null(F.regexp_extract(col(c), pattern, group))


def truthy(c: Column | str, default: bool = False) -> Column:
    """Text flags: true, t, 1, yes; anything else is false; null is the default."""
    return F.lower(F.coalesce(col(c).cast("string"), F.lit(str(default).lower()))).isin("true", "t", "1", "yes")


def falsy(c: Column | str) -> Column:
    return F.lower(F.coalesce(col(c).cast("string"), F.lit("true"))).isin("false", "f", "0", "no")


def month(c: Column | str) -> Column:
    return F.trunc(col(c).cast("date"), "month")


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def counted_share(condition: Column, digits: int) -> Column:
    """Rows with a condition, in per cent of all rows of the group."""
    return F.round(F.count_if(condition) * 100.0 / nonzero(F.count("*").cast("double")), digits)
