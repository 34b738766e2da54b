"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.decontaminate import decontaminate
from basketry.llm.jaccard_join import one_of_each_group
from basketry.llm.mixing import mixed
from basketry.llm.store import kept
from basketry.llm.substring_dedup import cut_repeats
from basketry.llm.toxicity import drop_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network predicts to be toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays, the one with the smallest id; texts that share an id count by themselves. Of rows with the same id and text one stays; documents with a null id stay."""
    return one_of_each_group(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that stand in a document with a smaller id are cut; ``n_chars`` follows the text."""
    return cut_repeats(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of their ``copies`` (rows are not repeated; a column of that name is replaced)."""
    return mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near copies", one_of_near_copies),
    ("repeated passages", cut_repeated_passages),
    ("benchmark contamination", drop_contaminated),
    ("source mix", mix_sources),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
