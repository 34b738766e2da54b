"""Partitioned Parquet tables that batches correct: rows are replaced by key, in the partitions concerned only, and a run can be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.joins import latest
from basketry.sources.scratch import dropped, written


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _path(spark, path)
    return system.exists(target)


def table_at(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """The table at ``root``; empty before the first batch."""
    return spark.read.schema(like.schema).parquet(root) if exists(spark, root) else like.limit(0)


def replaced(spark: SparkSession, root: str, batch: DataFrame, keys: Sequence[str], partition: str, order: Sequence[Column] = ()) -> int:
    """Puts a batch into the table at ``root``, partitioned by ``partition``: rows with a key of the batch go, those of the batch come; of several with one key the first by ``order``. The number of partitions written.

    Only partitions that the batch's rows belong to or that hold rows of its keys are read and written; a correction may move a row to
    another partition. What the partitions will hold is written beside the table first, so a run that is broken off leaves either old or new
    partitions, and the same batch run again gives the same table. Rows with a null in their key are left out.
    """
    new = latest(batch.dropna(subset=list(keys)), keys, order or [F.lit(0)])
    new = written(new, "batch")
    old = table_at(spark, root, batch)
    theirs = old.join(new.select(*keys), list(keys), "left_semi")
    touched = written(theirs.select(partition).union(new.select(partition)).distinct(), "touched-partitions")
    values = [r[0] for r in touched.collect()]  # partitions, not rows: months or days of a batch
    rest = old.where(F.col(partition).isin(values) | F.col(partition).isNull() if None in values else F.col(partition).isin(values)).join(new.select(*keys), list(keys), "left_anti")
    staged = written(rest.unionByName(new), "staged-partitions")
    if values:
        staged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(root)
        left = {r[0] for r in staged.select(partition).distinct().collect()}
        for value in set(values) - left:  # all its rows went elsewhere
            _emptied(spark, root, partition, value)
    for table in (new, touched, staged):
        dropped(table)
    return len(values)


def _emptied(spark: SparkSession, root: str, partition: str, value: object) -> None:
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    system, target = _path(spark, f"{root.rstrip('/')}/{partition}={name}")
    system.delete(target, True)


def upserted_seed(seed: DataFrame, records: DataFrame, key: str, digits: int = 4) -> DataFrame:
    """A seed table with records put in by ``key``: numbers rounded, columns that a record leaves open taken from the row before, in order of the key. Rows without a key go; of several records the last in the order of their values counts."""
    numbers = {f.name for f in seed.schema.fields if f.dataType.simpleString() in ("double", "float")}
    others = [c for c in seed.columns if c != key]
    one = records.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*others)).alias("r")).select(F.col(key).alias("__key"), *[F.col(f"r.{c}").alias(f"__{c}") for c in others])
    both = seed.where(F.col(key).isNotNull()).join(one, F.col(key) == F.col("__key"), "full_outer")

    def cell(c: str) -> Column:
        new = F.round(F.col(f"__{c}"), digits) if c in numbers else F.col(f"__{c}")
        return F.coalesce(new, F.col(c)).alias(c)

    return both.select(*[F.coalesce("__key", key).alias(key) if c == key else cell(c) for c in seed.columns]).orderBy(key)


def write_seed(seed: DataFrame, path: str) -> None:
    """A seed as one CSV file with a header, in its order; seeds are small by nature."""
    seed.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
