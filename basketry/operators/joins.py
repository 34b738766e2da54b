"""Join shapes that Spark has no operator for, as compositions of those it has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import pct_change
from basketry.operators.rules import FLAGS, first_rule


def as_of(left: DataFrame, right: DataFrame, on: str, value: str, by: Sequence[str] = (), buckets: str | None = None) -> DataFrame:
    """Adds to each row of ``left`` the ``value`` of ``right``'s last row with the same ``by`` and ``on`` not after its own.

    The distinct ``by`` and ``on`` of both sides go through one window, and rows take the value of their own by an equi-join, so there is no
    theta join and no task sorts the rows of a day or a year. Without ``by`` a day (or the given ``buckets`` column) deals the
    distinct ones: each bucket starts with the last value before it, found from one row for each bucket.
    """
    keys = list(by)
    rows, left = left, left.select(*keys, on, *([buckets] if buckets else [])).where(F.col(on).isNotNull()).distinct()
    bucket = F.col(buckets) if buckets else F.to_date(on)
    r = right.where(F.col(value).isNotNull()).groupBy(*keys, on).agg(F.max(value).alias(value)).withColumn("__bucket", bucket)
    ends = r.groupBy(*keys, "__bucket").agg(F.max_by(value, on).alias("__end"))
    carry = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    lefts = left.withColumn("__bucket", bucket)
    all_buckets = lefts.select(*keys, "__bucket").union(r.select(*keys, "__bucket")).distinct().join(ends, [*keys, "__bucket"], "left")
    starts = all_buckets.withColumn("__start", F.last("__end", ignorenulls=True).over(carry)).drop("__end")
    l = lefts.withColumns({value: F.lit(None).cast(r.schema[value].dataType), "__left": F.lit(1)})  # noqa: E741
    both = l.unionByName(r.withColumn("__left", F.lit(0)), allowMissingColumns=True)
    along = Window.partitionBy(*keys, "__bucket").orderBy(on, "__left").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn(value, F.last(value, ignorenulls=True).over(along)).where("__left = 1")
    found = filled.join(starts, [*keys, "__bucket"], "left").withColumn(value, F.coalesce(value, "__start")).select(*[F.col(c).alias(f"__{c}") for c in left.columns], F.col(value).alias("__value"))
    return rows.join(found, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in left.columns], "left").select(*rows.columns, F.col("__value").alias(value))


def exact_or(left: DataFrame, rates: DataFrame, on: str, value: str, default: float) -> DataFrame:
    """An equality lookup with a default where it misses."""
    return left.join(rates.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def first_by_any_key(left: DataFrame, rules: DataFrame, row: str, keys: Sequence[Column], rule_key: str, take: Sequence[str], same: Sequence[str] = ()) -> DataFrame:
    """A join on ``key1 OR key2 OR ...`` as one equi-join: keys are exploded with their rank, and the best rank wins for each row (of several rules, the least)."""
    exploded = left.select(row, *same, F.posexplode(F.array(*keys)).alias("__rank", "__key")).where("__key IS NOT NULL")
    found = exploded.join(rules, [exploded["__key"] == rules[rule_key], *[exploded[s].eqNullSafe(rules[s]) for s in same]])
    best = found.groupBy(row).agg(F.min_by(F.struct(*[rules[t] for t in take]), F.struct("__rank", *[rules[t] for t in take])).alias("__best"))
    return left.join(best, row, "left").select(*left.columns, *[F.col(f"__best.{t}").alias(t) for t in take])


def rule_chain(name: str, rules: Sequence[tuple[str, str | None, str]], default: str | None = None) -> Column:
    """Prioritised regular-expression rules (pattern, pattern that forbids, label) as one expression: a projection instead of a theta join."""
    out = F.lit(default).cast("string")
    for pattern, forbidden, label in reversed(rules):
        hit = F.col(name).rlike(f"{FLAGS}{pattern}")
        hit = hit & ~F.col(name).rlike(f"{FLAGS}{forbidden}") if forbidden else hit
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def rule_join(items: DataFrame, rules: DataFrame, row: str, name: str) -> DataFrame:
    """The same from a table of rules (``pattern, negative_pattern, priority, label``), for rule sets that change at run time: see ``rules.first_rule``."""
    number = F.row_number().over(Window.orderBy("priority", "label", "pattern", "negative_pattern"))  # a row a rule
    return first_rule(items, rules.withColumn("rule", number), row, name)


def calendar_changes(monthly: DataFrame, keys: Sequence[str], values: Sequence[str], period: str = "month", digits: int | None = 4) -> DataFrame:
    """Month-on-month and year-on-year changes in per cent, by calendar months, so gaps give nulls: adds ``<value>_mom`` and ``<value>_yoy``."""
    out = monthly
    for months, suffix in ((1, "mom"), (12, "yoy")):
        before = monthly.select(*[F.col(k).alias(f"__{k}") for k in keys], F.add_months(period, months).alias("__at"), *[F.col(v).alias(f"__{v}") for v in values])
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        out = out.join(before, [F.col(period) == F.col("__at"), *same], "left")
        out = out.withColumns({f"{v}_{suffix}": pct_change(v, f"__{v}", digits) for v in values}).drop("__at", *[f"__{k}" for k in keys], *[f"__{v}" for v in values])
    return out


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row by keys in an order. The row number limits groups before the shuffle."""
    return rows.withColumn("__no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__no = 1").drop("__no")
